"""Sources and sinks: fixture mapping, Parquet, catalog, run ledger."""
