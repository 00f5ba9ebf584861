"""Loading, change tracking and incremental refresh."""
