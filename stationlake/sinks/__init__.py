"""Table definition and writers (catalog tables and partitioned Parquet)."""
