"""Forward fill (last observation carried forward) per group.

Semantics: the filled value of a row is the last non-null value among all rows
of its group whose ORDER BY key is <= the row's key. The frame is Spark's
default RANGE frame, so rows that tie on the ORDER BY key (peers, e.g. all days
of a month when ordering by (year, month)) see each other's values.

Two physical strategies give the same result:

``window``
    ``last(c, ignorenulls) OVER (PARTITION BY group ORDER BY key)``. One task
    holds a whole group, so a hot group is a straggler.

``bucketed`` (default)
    The ORDER BY range is cut into buckets (a coarsening of the key, such as the
    month of a date) and the fill runs per (group, bucket) in parallel. Each
    bucket's last non-null value is aggregated from the filled rows, carried
    across buckets with a window over that small summary (groups x buckets
    rows), and joined back. Peers of the ORDER BY key must fall into one bucket, which any
    coarsening of the key guarantees. The rows are shuffled once (by group and
    bucket); the summary and the seeds are one row per (group, bucket).

``ranged``
    A prefix scan for any order key and any skew. The peers of a key are first
    one row (a pre-aggregated group), so that ties cannot gather; the keys go to
    range partitions of (group, key), are filled inside a partition, and the
    partitions' last values are carried over their bounds by a window over one
    row per group and partition. A group, and any stretch of it, is spread over
    as many tasks as it has rows for. Of peers with different values the
    greatest counts (the other strategies take any).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelsmith.session import cut_lineage

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str],
    order: Sequence[str],
    strategy: str = "bucketed",
    bucket: Column | str | None = None,
    null_groups: bool = True,
) -> DataFrame:
    """Fill ``cols`` in place. ``bucket`` must be monotone in ``order`` and
    constant across ties of ``order``: an expression (e.g.
    ``F.trunc('d', 'month')``) or the name of an existing coarser column
    (e.g. ``'year'``). Without one, a date/timestamp first order key is
    bucketed by month; any other key needs one, or ``strategy='window'``.
    ``null_groups=False`` states that no group key is NULL and so keeps the
    keys' own partitioning; NULL keys would then be filled within buckets only."""
    cols, by, order = list(cols), list(by), list(order)
    if strategy == "window":
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    if strategy not in ("bucketed", "ranged"):
        raise ValueError(f"unknown strategy {strategy!r}")

    if bucket is None and strategy == "bucketed":
        # default bucket: the month of a date / timestamp order key; other
        # keys have no natural coarsening
        kind = dict(df.dtypes).get(order[0], "")
        if kind.startswith("date") or kind.startswith("timestamp"):
            bucket = F.trunc(F.col(order[0]).cast("date"), "month")
        else:
            raise ValueError(f"order key {order[0]!r} is no date: give a bucket, or strategy='window' (one task per group)")
    names = df.columns
    if null_groups:
        # NULL is a group like any other: keys that are never NULL stand in
        types = dict(df.dtypes)
        stand_in = {}
        for i, c in enumerate(by):
            zero = F.lit("") if types[c] == "string" else F.lit(0).cast(types[c]) if types[c] in _NUMBERS else None
            stand_in[f"__ff_null_{i}"] = F.col(c).isNull()
            stand_in[f"__ff_key_{i}"] = F.coalesce(F.col(c), zero) if zero is not None else F.coalesce(F.col(c).cast("string"), F.lit(""))
        df, by = df.withColumns(stand_in), list(stand_in)
    if strategy == "ranged":
        return _ranged_fill(df, cols, by, order).select(*names)
    if isinstance(bucket, str):
        # an existing column: windows and joins keyed on it can reuse a
        # partitioning by (group, bucket) that earlier steps already made
        b, base = bucket, df
    else:
        b = "__ff_bucket"
        base = df.withColumn(b, bucket)

    # 1) fill inside each (group, bucket); these windows run in parallel
    w_in = Window.partitionBy(*by, b).orderBy(*order)
    inner = base.withColumns({c: F.last(c, ignorenulls=True).over(w_in) for c in cols})

    # 2) each bucket's last value, read off the filled rows: the filled value
    #    at the bucket's greatest key is its last non-null value, and peers of
    #    that key share it. ``inner`` is already hash-partitioned by
    #    (group, bucket), so this aggregate adds no shuffle of the rows.
    okey = F.struct(*_cols(order))
    summary = inner.groupBy(*by, b).agg(*[F.max_by(F.col(c), okey).alias(c) for c in cols])

    # 3) carry across buckets on the small summary (groups x buckets rows)
    w_carry = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    seeds = summary.select(
        *by, b, *[F.last(c, ignorenulls=True).over(w_carry).alias(f"__seed_{c}") for c in cols]
    )

    # 4) join the seeds back; the seed table is groups x buckets, AQE turns the
    #    join into a broadcast when its measured size allows
    #    A plain equi-join: ``inner`` is already hash-partitioned by
    #    (group, bucket), so a sort-merge join reuses that partitioning and
    #    only the small seed table moves. (A null-safe join would rewrite the
    #    keys and reshuffle every row.) NULL order keys form the first bucket.
    # a NULL bucket is the first one: nothing is carried into it
    out = inner.join(seeds, on=[*by, b], how="left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__seed_{c}")) for c in cols})
    return out.select(*names)


def _ranged_fill(df: DataFrame, cols: list[str], by: list[str], order: list[str]) -> DataFrame:
    """Fill by a prefix scan over range partitions of (by, order)."""
    keys = [*by, *order]
    # one row per key: its greatest value, combined on the map side
    peers = df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])
    dealt = peers.repartitionByRange(*keys).withColumn("__ff_part", F.spark_partition_id())
    # the summary and the fill must see the same partitions
    dealt = cut_lineage(dealt, "fill-ranges")
    okey = F.struct(*_cols(order))
    lasts = dealt.groupBy(*by, "__ff_part").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(c) for c in cols])
    before = Window.partitionBy(*by).orderBy("__ff_part").rowsBetween(Window.unboundedPreceding, -1)
    seeds = lasts.select(*by, "__ff_part", *[F.last(c, ignorenulls=True).over(before).alias(f"__seed_{c}") for c in cols])
    inside = Window.partitionBy(*by, "__ff_part").orderBy(*order)
    scanned = dealt.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols}).join(seeds, [*by, "__ff_part"], "left")
    filled = scanned.select(
        *[F.col(k).alias(f"__ff_k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.col(c), F.col(f"__seed_{c}")).alias(f"__ff_v{i}") for i, c in enumerate(cols)],
    )
    # order keys may be null: they are their own first peers, met null-safely
    same = [F.col(k) == F.col(f"__ff_k{i}") for i, k in enumerate(by)]
    same += [F.col(k).eqNullSafe(F.col(f"__ff_k{len(by) + i}")) for i, k in enumerate(order)]
    met = df.join(filled, reduce(and_, same), "left")
    return met.select(*[F.col(f"__ff_v{cols.index(c)}").alias(c) if c in cols else F.col(c) for c in df.columns])
