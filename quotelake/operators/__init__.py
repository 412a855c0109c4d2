"""Set-wise operators: validation, unification, upsert, drift, paging, metrics."""
