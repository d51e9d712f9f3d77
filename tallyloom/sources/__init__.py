"""Table schemas, scans and sinks."""
