"""Tables kept as folders of parquet that are published whole."""
