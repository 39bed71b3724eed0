"""Column-level helpers (keys, dates, labels, measures)."""
