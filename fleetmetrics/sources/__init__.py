"""Reading and incremental writing of tables."""
