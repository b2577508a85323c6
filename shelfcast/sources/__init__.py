"""Sources and sinks: typed scans, fixture views over the driver tables, writers."""
