"""Table declarations, readers, and the ride views over the given parquet tables."""
