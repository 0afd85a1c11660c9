"""Sources and sinks: Parquet zones, relational source, object store
settings, serving-table publication, fixtures and test-data adapters."""
