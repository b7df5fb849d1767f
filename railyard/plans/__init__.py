"""Jobs: thin driver functions that chain scans, operators and sinks."""
