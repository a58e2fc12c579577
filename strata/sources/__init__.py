"""Sources: the transport topic (batch and stream), catalog tables, JSON lines."""
