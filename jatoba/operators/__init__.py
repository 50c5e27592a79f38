"""DataFrame operators: nested records, pivots, skew-safe joins, sinks."""
