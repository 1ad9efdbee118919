"""Report tables, key/value snapshots and file exports."""
