"""K1 -- demand matrix: long sales rows -> one row per key, one column per month.

One shuffle on the key with map-side partial aggregation: every month is a
conditional sum evaluated in the same codegen'd aggregate, so a hot key is
collapsed to one row per map partition before it leaves the task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_list(start: tuple[int, int], n_months: int) -> list[tuple[int, int]]:
    y, m = start
    out = []
    for _ in range(n_months):
        out.append((y, m))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


def month_name(y: int, m: int, style: str = "padded") -> str:
    """``padded``: m2000_01 (sorts correctly); ``raw``: 2000-1 (the source workbook's style)."""
    if style == "raw":
        return f"{y}-{m}"
    return f"m{y}_{m:02d}"


def month_names(start: tuple[int, int], n_months: int, style: str = "padded") -> list[str]:
    return [month_name(y, m, style) for y, m in month_list(start, n_months)]


def demand_matrix(sales: DataFrame, keys: list[Column | str], date_col: str, value: Column | str,
                  start: tuple[int, int], n_months: int, fill: float | None = 0.0,
                  style: str = "padded", window_only: bool = False) -> DataFrame:
    """Pivot ``sales`` into ``keys + month columns`` holding the sum of ``value``.

    ``fill`` is the value of a month without sales (None keeps NULL).
    ``window_only`` keeps only keys with at least one sale inside the window;
    the date predicate is then pushed into the scan.
    """
    months = month_list(start, n_months)
    y0, m0 = start
    (y1, m1) = month_list(months[-1], 2)[1]
    v = F.col(value) if isinstance(value, str) else value
    d = F.col(date_col)
    if window_only:
        lo = _dt.datetime(y0, m0, 1)
        hi = _dt.datetime(y1, m1, 1)
        sales = sales.filter((d >= F.lit(lo)) & (d < F.lit(hi)))
    idx = (F.year(d) - y0) * 12 + (F.month(d) - m0)
    aggs = []
    for i, (y, m) in enumerate(months):
        s = F.sum(F.when(idx == i, v))
        if fill is not None:
            s = F.coalesce(s, F.lit(float(fill)))
        aggs.append(s.cast("double").alias(month_name(y, m, style)))
    return sales.groupBy(*keys).agg(*aggs)
