"""Column functions: guarded coercions and JSON value helpers."""
