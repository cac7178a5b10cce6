"""Sources and sinks: Parquet tables, CSV files, staging loads."""
