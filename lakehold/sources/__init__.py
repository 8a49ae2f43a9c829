"""Sources and sinks: test-table adapters, the layered lake on Parquet/CSV/JSON."""
