"""Sources and sinks: driver parquet tables, raw entity views, CSV landing,
CSV export with manifest, file-change snapshots."""
