"""Grouped quantiles that never hold a whole group in one buffer.

``approx``: ``percentile_approx`` as a grouped aggregate. Its sketch merges
partial results from every map task, so a group holding a third of all rows is
aggregated by all tasks, and memory per group is bounded by the accuracy.

``exact``: discrete percentile (the smallest value whose cumulative share is
>= p, i.e. the ceil(p*n)-th value, as ``percentile_disc``). Two passes over
the data: the sketch brackets each quantile by a value band [lo, hi] whose
rank distance is a few n/accuracy rows; a second pass counts, in one partial
aggregate for all probabilities, the rows below ``lo`` and the rows per value
inside the band, and the quantile is read off the band's running count. The
band, not the group, is what gets sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelsmith.operators.joins import join_null_safe
from panelsmith.session import cut_lineage


def quantiles(
    df: DataFrame,
    col: str,
    by: Sequence[str],
    probs: Sequence[float],
    method: str = "approx",
    accuracy: int = 10000,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per group: ``by`` columns + one column per probability."""
    by = list(by)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    v = F.col(col)
    if method == "approx":
        arr = F.percentile_approx(v, list(probs), accuracy)
        return df.groupBy(*by).agg(arr.alias("__q")).select(
            *by, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)]
        )
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    # pass 1: count + bracketing sketch quantiles per group
    margin = 3.0 / accuracy
    lo_p = [max(0.0, p - margin) for p in probs]
    hi_p = [min(1.0, p + margin) for p in probs]
    vals = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull())
    bounds = vals.groupBy(*by).agg(
        F.count("*").alias("__n"),
        F.percentile_approx("__v", lo_p + hi_p, accuracy).alias("__b"),
    )
    # written, so that its size is known and the raw rows are not exchanged to
    # meet it while it is small
    bounds = cut_lineage(bounds, "quantile-bounds")
    k = len(probs)

    # pass 2: one aggregate for every probability. Each row is emitted once per
    # probability whose band it is below or inside; rows below the band carry
    # a NULL key, so map-side combine folds them into one count per group.
    tagged = join_null_safe(vals, bounds, by, "inner").select(
        *by,
        "__n",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("__i"),
                        F.when(F.col("__v") >= F.col("__b")[i], F.col("__v")).alias("__key"),
                        (F.col("__v") <= F.col("__b")[k + i]).alias("__keep"),
                    )
                    for i in range(k)
                ]
            )
        ),
    ).where("__keep")
    counts = tagged.groupBy(*by, "__n", "__i", "__key").agg(F.count("*").alias("__c"))

    # running count per (group, probability) over the small count table;
    # NULL keys sort first, so the running count includes the rows below
    w = Window.partitionBy(*by, "__i").orderBy(F.col("__key").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1)
    target = F.greatest(F.lit(1), F.ceil(F.col("__n") * prob - F.lit(1e-9)))
    # the sketch promises that the band holds the rank; both edges are checked
    hits = (
        counts.withColumn("__cum", F.sum("__c").over(w))
        .groupBy(*by, "__i")
        .agg(
            F.min(F.when(F.col("__key").isNotNull() & (F.col("__cum") >= target), F.col("__key"))).alias("__q"),
            F.coalesce(F.max(F.when(F.col("__key").isNull(), F.col("__c"))), F.lit(0)).alias("__below"),
            F.max(target).alias("__rank"),
        )
    )
    missed = F.col("__q").isNull() | (F.col("__below") >= F.col("__rank"))
    hits = hits.withColumn("__q", F.when(missed, F.raise_error(F.lit("quantile outside its band: use a larger accuracy"))).otherwise(F.col("__q")))
    return hits.groupBy(*by).agg(
        *[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(name) for i, name in enumerate(names)]
    )

