"""Exact quantiles of every group at once, without gathering a group's values.

Spark's ``percentile`` merges a map of all distinct values of a group in one
task. Here the input is computed once and kept, and two aggregates do on usual
data. The first gives what a caller wants of each group, its count and range,
and a sketch's guess of a little below and above every quantile: its bracket.
The second counts what lies below each bracket and in each of its BINS
sub-ranges, with their smallest and largest values; counts are exact, so they
tell whether a rank lies in its bracket, and in which sub-range. A sub-range
of one distinct value is the answer. Whatever is left (more distinct values
than sub-ranges, a guess that missed) is narrowed further in the same way: a
pass always splits a bracket's ends from the rest, and values spread over many
magnitudes take more passes, each a sub-range of the one before. Counts are
added up before the shuffle; what comes back is groups x ranks x BINS rows at
most, and groups are columns or models: more than MOST of them raise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 256
#: The sketch's accuracy, and how far around a quantile its bracket reaches (a share of the rows).
ACCURACY, REACH = 1000, 0.003
MOST = 20_000


@dataclass
class _Target:
    group: int
    rank: int
    low: float
    high: float
    below: int | None  # values of the group under the bracket; None: not counted yet

    @property
    def found(self) -> bool:
        return self.low == self.high and self.below is not None


def grouped_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], aggregates: list[Column] = ()) -> DataFrame:
    """A small DataFrame ``by..., <aggregates>, _q``: per group the named
    aggregates and the quantiles of ``value`` with linear interpolation
    (position ``p * (n - 1)``). NULL and NaN are left out of the quantiles; a
    group without values has NULL there. Runs Spark jobs; pass narrow frames."""
    v = F.col(f"`{value}`").cast("double")
    keys = [f"_b{i}" for i in range(len(by))]
    base = df.select("*", *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], F.when(~F.isnan(v), v).alias("_v")).persist()
    try:
        around = [min(1.0, max(0.0, x)) for p in probs for x in (p - REACH, p + REACH)]
        first = base.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                        F.percentile_approx("_v", F.array(*[F.lit(x) for x in around]), ACCURACY).alias("_around"), *aggregates)
        got = first.limit(MOST + 1).collect()
        if len(got) > MOST:
            raise ValueError(f"more than {MOST} groups: pass accuracy= for approximate quantiles of many groups")
        kinds = {f.name: f.dataType for f in base.schema.fields}
        qs = _narrow(base, keys, [kinds[k] for k in keys], got, probs)
    finally:
        base.unpersist()
    fields = [f for f in first.schema.fields if f.name not in (*keys, "_n", "_lo", "_hi", "_around")]
    schema = T.StructType([*[T.StructField(c, kinds[k], True) for c, k in zip(by, keys)], *[T.StructField(f.name, f.dataType, True) for f in fields],
                           T.StructField("_q", T.ArrayType(T.DoubleType()), True)])
    rows = [(*[r[k] for k in keys], *[r[f.name] for f in fields], q) for r, q in zip(got, qs)]
    return df.sparkSession.createDataFrame(rows, schema)


def _narrow(base: DataFrame, keys: list[str], kinds: list[T.DataType], got: list, probs: list[float]) -> list[list[float] | None]:
    targets: dict[tuple[int, int], _Target] = {}
    for g, r in enumerate(got):
        for i, p in enumerate(probs if r["_n"] else ()):
            for rank in (math.floor(p * (r["_n"] - 1)), math.ceil(p * (r["_n"] - 1))):
                low, high = r["_around"][2 * i], r["_around"][2 * i + 1]
                targets.setdefault((g, rank), _Target(g, rank, low, high, None))
    schema = T.StructType([*[T.StructField(f"_k{i}", k, True) for i, k in enumerate(kinds)], T.StructField("bracket", T.IntegerType()),
                           T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()), T.StructField("whole", T.BooleanType())])
    own = F.lit(True)
    for i, k in enumerate(keys):
        own = own & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    while True:
        open_ = [t for t in targets.values() if not t.found]
        if not open_:
            break
        # a bracket whose lower values are not counted yet looks at its whole group
        brackets = sorted({(t.group, t.low, t.high, t.below is None) for t in open_})
        table = base.sparkSession.createDataFrame([(*[got[g][k] for k in keys], i, lo, hi, whole) for i, (g, lo, hi, whole) in enumerate(brackets)], schema)
        within = (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
        here = base.where("_v is not null").join(F.broadcast(table), own & (F.col("whole") | within)).select("_v", "bracket", "lo", "hi")
        part = F.floor((F.col("_v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / BINS))
        # the ends are told apart whatever rounding (or an infinite end) does between them
        slot = (F.when(F.col("_v") < F.col("lo"), F.lit(-2)).when(F.col("_v") > F.col("hi"), F.lit(BINS + 1))
                .when(F.col("_v") == F.col("lo"), F.lit(-1)).when(F.col("_v") == F.col("hi"), F.lit(BINS))
                .otherwise(F.coalesce(F.when(~F.isnan(part.cast("double")), F.least(F.greatest(part, F.lit(0)), F.lit(BINS - 1))), F.lit(0)).cast("int")))
        counted = here.groupBy("bracket", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        bins: dict[int, list] = {}
        for r in sorted(counted.collect(), key=lambda r: (r.bracket, r.slot)):
            bins.setdefault(r.bracket, []).append(r)
        at = {b: i for i, b in enumerate(brackets)}
        for t in open_:
            below = t.below or 0
            for r in bins[at[t.group, t.low, t.high, t.below is None]]:
                if t.rank < below + r.n:  # also where that lies beside the bracket: its range is the next bracket
                    t.low, t.high, t.below = r.lo, r.hi, below
                    break
                below += r.n
    out: list[list[float] | None] = []
    for g, r in enumerate(got):
        if not r["_n"]:
            out.append(None)
            continue
        qs = []
        for p in probs:
            h = p * (r["_n"] - 1)
            a, b = targets[g, math.floor(h)].low, targets[g, math.ceil(h)].low
            qs.append(a if a == b else a + (b - a) * (h - math.floor(h)))
        out.append(qs)
    return out


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float]) -> list[tuple[tuple, list[float | None]]]:
    """``[(group key, [quantile per probability])]`` of :func:`grouped_quantiles`; Nones for a group without values."""
    rows = grouped_quantiles(df.select(*[F.col(f"`{c}`") for c in by], F.col(f"`{value}`")), by, value, probs).collect()
    return [(tuple(r[c] for c in by), r["_q"] or [None] * len(probs)) for r in rows]
