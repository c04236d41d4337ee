"""Sources and sinks: landed bronze Parquet, test-data fixtures, stitching
of split recordings."""
