"""Registered queries: one per operator of the inventory, each reading the
driver tables (or frames Spark derives from them) over their whole extent,
paired with an independent DuckDB oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ventana.functions.exprs import round_all

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, digits: int = 6):
    """Register ``fn(spark, sf_dir) -> DataFrame``; doubles are rounded to
    ``digits`` so both sides hash equal values identically."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_all(fn(spark, sf_dir), digits)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ventana.plans import queries, queries_models, queries_more, queries_ops  # noqa: F401
