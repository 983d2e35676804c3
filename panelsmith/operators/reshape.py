"""Pivot, melt, one-hot encoding and aligned concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_wide(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    values: Sequence,
    value: str,
    agg: str = "max",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``index``, one column per listed ``values`` of ``column``.

    The value list is explicit (no extra job to discover it) and the
    aggregate is deterministic (``max``/``min``/``sum``/``avg`` or
    ``first`` with ignorenulls over a fixed value set).
    """
    names = list(names or [str(v) for v in values])
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg}.get(agg)
    if fn is None and agg != "first":
        raise ValueError(f"unsupported agg {agg!r}")
    exprs = []
    for v, n in zip(values, names):
        cell = F.when(F.col(column) == F.lit(v), F.col(value))
        exprs.append((F.first(cell, ignorenulls=True) if agg == "first" else fn(cell)).alias(n))
    # conditional aggregates: one hash aggregate with partial aggregation,
    # the same plan Spark's pivot() produces for an explicit value list
    return df.groupBy(*index).agg(*exprs)


def melt(
    df: DataFrame, ids: Sequence[str], value_cols: Sequence[str], var_name: str = "variable", value_name: str = "value"
) -> DataFrame:
    """Wide -> long; NULL values are kept (one output row per input cell)."""
    return df.unpivot(list(ids), list(value_cols), var_name, value_name)


def one_hot(df: DataFrame, col: str, values: Sequence, prefix: str) -> DataFrame:
    """``prefix_v`` = 1 if col == v else 0 (NULL input gives 0)."""
    return df.withColumns({f"{prefix}_{v}": F.col(col).eqNullSafe(F.lit(v)).cast("int") for v in values})


def calendar_one_hot(df: DataFrame, date_col: str, month_prefix: str = "month", dow_prefix: str = "dow") -> DataFrame:
    """Month 1..12 and day of week 1..7 (1 = Sunday) as 0/1 columns."""
    parts = {"__month": (F.month(date_col), month_prefix, 12), "__dow": (F.dayofweek(date_col), dow_prefix, 7)}
    for name, (part, prefix, last) in parts.items():
        df = one_hot(df.withColumn(name, part), name, range(1, last + 1), prefix).drop(name)
    return df


def one_hot_decode(df: DataFrame, prefix: str, values: Sequence, out: str, drop: bool = True) -> DataFrame:
    """Inverse of ``one_hot``: the first ``v`` whose column is 1, else NULL."""
    cols = [f"{prefix}_{v}" for v in values]
    expr = F.coalesce(*[F.when(F.col(c) == 1, F.lit(v)) for c, v in zip(cols, values)])
    df = df.withColumn(out, expr)
    return df.drop(*cols) if drop else df


def concat_align(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns absent from a frame become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
