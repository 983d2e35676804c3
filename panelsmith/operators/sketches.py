"""Outlier fences from stored, mergeable quantile sketches.

One KLL sketch per (partition, column) is kept. New rows make sketches of their
own, which are merged with the stored ones; old rows are not read again. A
sketch that has seen fewer values than ``k`` holds them all and its quantiles
are the discrete percentiles; beyond, a rank is off by about 2.3 / k^0.9 of the
rows with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch parameter: rank error about 0.1 %, some 100 KB at most.
K = 4096


def rank_error(k: int = K) -> float:
    """The share of rows by which a quantile's rank may be off."""
    return 2.3 / k**0.9


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], k: int = K) -> DataFrame:
    """(by, column, sketch, n): one sketch per group and column, nulls left
    out; partial sketches are made on the map side."""
    by = list(by)
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])))
    return long.where("value IS NOT NULL").groupBy(*by, "column").agg(
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")
    )


def merge_sketches(stored: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored and new sketches as one per (by, column): two rows at most meet."""
    by = [*by, "column"]
    mine, other = stored.withColumnsRenamed({"sketch": "s1", "n": "n1"}), new.withColumnsRenamed({"sketch": "s2", "n": "n2"})
    met = mine.join(other, by, "full_outer")
    both = F.when(F.col("s1").isNotNull() & F.col("s2").isNotNull(), F.kll_sketch_merge_double("s1", "s2"))
    n = F.coalesce("n1", F.lit(0)) + F.coalesce("n2", F.lit(0))
    return met.select(*by, F.coalesce(both, "s1", "s2").alias("sketch"), n.alias("n"))


def fences(sketches: DataFrame, by: Sequence[str], factor: float = 1.5) -> DataFrame:
    """(by, column, q1, q3, lower, upper) from the sketches alone."""
    q1, q3 = (F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in (0.25, 0.75))
    q = sketches.select(*by, "column", q1.alias("q1"), q3.alias("q3"))
    spread = (F.col("q3") - F.col("q1")) * factor
    return q.withColumns({"lower": F.col("q1") - spread, "upper": F.col("q3") + spread})
