"""Sources and sinks: landed payloads, Parquet tables, control tables."""
