"""Registry of named queries: a Spark plan and, where SQL can state it, the
equivalent DuckDB SQL used as correctness oracle.

Every query reads the full driver tables (or what Spark derives from them).
Doubles are rounded to 4 digits on both sides so that engines that add in a
different order agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _decimal_rounding(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` of an oracle SQL text into the
    snapped half-up form used on the Spark side (``round_half_up``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = _decimal_rounding(sql[j + 6 : comma])
        digits = sql[comma + 1 : k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST({inner} AS DECIMAL(38,8)), {digits}) AS DOUBLE)")
        i = k


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _decimal_rounding(sql.strip())
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from panelsmith.plans import q_flow, q_panel, q_quality, q_reshape, q_scalar, q_sources, q_stats  # noqa: F401
