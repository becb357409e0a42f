"""Column-expression helpers: everything here returns ``Column`` objects
that stay inside whole-stage codegen."""

from ventana.functions.exprs import (
    is_numeric, numeric_columns, nan_to_null, uniform_hash,
    row_mean_skip_nulls, round_all,
)

__all__ = ["is_numeric", "numeric_columns", "nan_to_null",
           "uniform_hash", "row_mean_skip_nulls", "round_all"]
