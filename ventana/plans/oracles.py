"""Independent DuckDB SQL for each registered query (the correctness gate).

The strings are built from the same fixed window as the bindings; they use
only ANSI SQL plus DuckDB's ``quantile_cont``/``unpivot``.
"""

from __future__ import annotations

from ventana.sources.bindings import (FEATURES, MONTHS, PAIR_ATTRIBUTES, RAW_MONTHS,
                                      TARGET, WINDOW_START)

Y0, M0 = WINDOW_START


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r6(expr: str, name: str, digits: int = 6) -> str:
    return f"round(({expr})::DOUBLE, {digits}) AS {qi(name)}"


def _idx(date_col: str = "l_shipdate") -> str:
    return f"((year({date_col}) - {Y0}) * 12 + month({date_col}) - {M0})"


def dm_sql(fill: bool = True, signed: bool = False, names=None) -> str:
    names = names or MONTHS
    val = "case when l_returnflag = 'R' then -l_quantity else l_quantity end" if signed else "l_quantity"
    cols = []
    for i, n in enumerate(names):
        s = f"sum(case when {_idx()} = {i} then {val} end)"
        if fill:
            s = f"coalesce({s}, 0.0)"
        cols.append(f"({s})::DOUBLE AS {qi(n)}")
    return f"SELECT l_partkey AS product_id, {', '.join(cols)} FROM lineitem GROUP BY l_partkey"


def dm_pair_sql() -> str:
    cols = [f"coalesce(sum(case when {_idx()} = {i} then l_quantity end), 0.0)::DOUBLE AS {qi(n)}"
            for i, n in enumerate(RAW_MONTHS)]
    y1, m1 = (Y0 + (M0 - 1 + len(RAW_MONTHS)) // 12, (M0 - 1 + len(RAW_MONTHS)) % 12 + 1)
    inner = (f"SELECT l_suppkey AS codigo_almacen, l_partkey AS codigo_producto, {', '.join(cols)} "
             f"FROM lineitem WHERE l_shipdate >= TIMESTAMP '{Y0}-{M0:02d}-01' "
             f"AND l_shipdate < TIMESTAMP '{y1}-{m1:02d}-01' GROUP BY 1, 2")
    months = ", ".join(f"p.{qi(n)}" for n in RAW_MONTHS)
    return (f"SELECT p.codigo_almacen, s.s_name AS almacen, p.codigo_producto, "
            f"pt.p_name AS descripcion_producto, pt.p_type AS tipo_producto, "
            f"pt.p_brand AS descripcion_padre, pt.p_retailprice AS valor_promedio, {months} "
            f"FROM ({inner}) p LEFT JOIN supplier s ON s.s_suppkey = p.codigo_almacen "
            f"LEFT JOIN part pt ON pt.p_partkey = p.codigo_producto")


def preds_sql() -> str:
    last3 = f"({qi(FEATURES[-1])} + {qi(FEATURES[-2])} + {qi(FEATURES[-3])}) / 3.0"
    allm = "(" + " + ".join(qi(c) for c in FEATURES) + f") / {float(len(FEATURES))}"
    d = dm_sql()
    return (f"SELECT product_id, 'last_month' AS model, {qi(TARGET)} AS y, {qi(FEATURES[-1])} AS p FROM ({d}) "
            f"UNION ALL SELECT product_id, 'mean_last_3', {qi(TARGET)}, {last3} FROM ({d}) "
            f"UNION ALL SELECT product_id, 'feature_mean', {qi(TARGET)}, {allm} FROM ({d})")


def long_sql(table: str, cols: list[str], ids: list[str] | None = None) -> str:
    """Long form ``(ids, column_name, value)`` of a CTE, keeping NULLs."""
    idl = "".join(f"{qi(i)}, " for i in ids or [])
    parts = [f"SELECT {idl}'{c}' AS column_name, ({qi(c)})::DOUBLE AS value FROM {table}" for c in cols]
    return " UNION ALL ".join(parts)


def with_dm(body: str, fill: bool = True, signed: bool = False, names=None, cols=None) -> str:
    """``WITH d AS (DM), u AS (long form of d) <body>``."""
    cols = cols or (names or MONTHS)
    return (f"WITH d AS MATERIALIZED ({dm_sql(fill, signed, names)}), "
            f"u AS MATERIALIZED ({long_sql('d', cols)}) {body}")


__all__ = ["qi", "r6", "dm_sql", "dm_pair_sql", "preds_sql", "long_sql", "with_dm", "PAIR_ATTRIBUTES"]
