"""Writers: keyed tables and per-unit extracts."""
