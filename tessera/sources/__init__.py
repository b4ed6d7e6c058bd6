"""Sources: text lines, numbers, documents, dense vectors and the driver's Parquet tables."""
