"""Sources and sinks: Parquet tables, bronze history, operational snapshots, the landing zone."""
