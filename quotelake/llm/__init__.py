"""Operators for preparing training text: dedup, filters, mixing, extraction, archives and token shards."""
