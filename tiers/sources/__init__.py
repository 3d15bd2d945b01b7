"""Sources and sinks: raw file listing and CSV ingest, the table catalog, driver-table extracts."""
