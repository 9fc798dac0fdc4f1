"""Sources (parquet scans, test-table mapping) and sinks."""
