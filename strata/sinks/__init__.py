"""Sinks: partitioned catalog tables, JSON lines, and row counts observed
during the write."""
