"""Placement of a periodic value on one row of its period, and latest-revision
selection. Both are keyed top-1 problems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_end_place(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    period: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
    other=0,
) -> DataFrame:
    """Keep ``value`` on the last observed row (max ``order``) of each
    (group, period) and put ``other`` on the remaining rows of that period.

    The window is partitioned by group *and* period, so a hot group is spread
    over as many tasks as it has periods.
    """
    w = Window.partitionBy(*by, *period).orderBy(F.desc(order), *[F.desc(t) for t in tiebreak])
    rn = F.row_number().over(w)
    return df.withColumn(value, F.when(rn == 1, F.col(value)).otherwise(F.lit(other)))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest (order..., tiebreak...) per key, all columns kept.

    Written as ``max_by`` over a struct: a sort aggregate on both sides of the
    exchange (struct buffers do not fit a hash aggregate) whose map side sends
    one row per key and task, so no single task gets a hot key.
    Ties on ``order`` are broken by the largest ``tiebreak``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in [*order, *tiebreak]])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
