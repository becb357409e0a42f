"""DataFrame operators (schema, cleaning, preparation, profiling, splits,
evaluation, comparison)."""
