"""Joins of a panel with its sources.

Right sides are period tables (groups x months) or fixed dimensions. Fixed
dimensions (a list of countries, months, regions) have a size bound by
construction and are broadcast explicitly; period tables grow with history,
so the choice is left to AQE, which broadcasts them only after measuring
their real size against ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.functions.columns import drop_missing


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str], dimension: bool = False) -> DataFrame:
    """Left equi-join; ``dimension=True`` marks a right side of bounded size."""
    r = F.broadcast(right) if dimension else right
    return left.join(r, on=list(on), how="left")


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, on=list(on), how="inner")


def semi_join(left: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key appears in ``members`` (no fan-out)."""
    return left.join(members, on=list(on), how="left_semi")


def outer_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer equi-join; key columns are merged."""
    return left.join(right, on=list(on), how="full_outer")


def outer_join_complete(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join followed by dropping rows with any missing value."""
    return drop_missing(outer_join(left, right, on))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), so a NULL group
    joins its own per-group results the way a window partition treats it.
    Key columns are taken from ``left``; the result has no duplicate keys."""
    keys = list(keys)
    r = right.select(
        *[F.col(k).alias(f"__rk_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys]
    )
    cond = reduce(and_, [left[k].eqNullSafe(r[f"__rk_{i}"]) for i, k in enumerate(keys)])
    return left.join(r, cond, how).drop(*[f"__rk_{i}" for i in range(len(keys))])


def merge_periods(sources: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One wide row per key from several tables keyed alike: all value columns
    of all ``sources`` (name -> table), null where a source has no row.

    A union and one aggregate, pre-aggregated on the map side, so that a base
    table is joined once instead of once per source. A source that repeats a
    key would multiply the base's rows; it fails the job by name."""
    keys = list(keys)
    parts, values = [], []
    for name, df in sources.items():
        own = [c for c in df.columns if c not in keys]
        clash = set(own) & set(values)
        if clash:
            raise ValueError(f"{name}: columns {', '.join(sorted(clash))} are in another source, too")
        values += own
        # a null key meets no row of the base
        parts.append(df.dropna(subset=keys).select(*keys, *own, F.lit(1).alias(f"__n_{name}")))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    counts = [F.count(f"__n_{name}").alias(f"__n_{name}") for name in sources]
    wide = merged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values], *counts)
    twice = F.concat_ws(", ", *[F.when(F.col(f"__n_{name}") > 1, F.lit(name)) for name in sources])
    said = F.concat(F.lit("period key repeated in "), twice, F.lit(" at "), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    # part of every value, so that no optimisation drops the test
    checked = lambda c: F.when(F.greatest(*[F.col(f"__n_{n}") for n in sources], F.lit(0)) > 1, F.raise_error(said)).otherwise(F.col(c))
    return wide.select(*keys, *[checked(c).alias(c) for c in values])
