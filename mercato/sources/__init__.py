"""Sources and sinks: raw CSV/JSON readers, Parquet layers, test stand-ins."""
