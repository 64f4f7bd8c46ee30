"""Reading and writing change logs, progress snapshots and tables."""
