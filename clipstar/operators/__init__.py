"""DataFrame -> DataFrame operators, usable from batch jobs and foreachBatch."""
