"""Readers and writers: landed JSON, curated tables, checkpoint, catalog."""
