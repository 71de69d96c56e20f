"""Sources and sinks: driver tables, CSV/Parquet scans, fixture views."""
