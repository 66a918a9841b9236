"""Plans over the driver's test tables: the adapter that turns them into
landed records, the layered build, and the registry of named queries."""
