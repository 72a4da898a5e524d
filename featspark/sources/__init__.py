"""Sources and sinks: CSV/Parquet with explicit missing-value rules."""
