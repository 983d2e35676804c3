"""Coverage of a series by its landed pages: gaps, overlaps and cut pages.

An API that returns at most so many rows is asked for in batches of dates. What
was landed is checked as gaps and islands over the batches, not taken for whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_coverage(pages: DataFrame, expected: DataFrame | None = None, max_rows: int | None = None) -> DataFrame:
    """(series, finding, first_day, last_day) of ``pages`` (series, start, end
    as dates, n_rows, last_day: the last date in the page).

    ``gap``: days of ``expected`` (series, lo, hi), or between two batches,
    that no batch covers. ``overlap``: days that a later batch covers again.
    ``cut``: a page of ``max_rows`` rows that ends before its batch; the days
    after its last row. One row per batch is windowed, by series."""
    by_start = Window.partitionBy("series").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    seen = pages.select("series", "start", "end", "n_rows", "last_day", reach.alias("reach"))
    one = lambda kind, lo, hi: F.struct(F.lit(kind).alias("finding"), lo.alias("first_day"), hi.alias("last_day"))
    start, end, reach = F.col("start"), F.col("end"), F.col("reach")
    found = [
        F.when(start > F.date_add(reach, 1), one("gap", F.date_add(reach, 1), F.date_sub(start, 1))),
        F.when(start <= reach, one("overlap", start, F.least(end, reach))),
    ]
    if max_rows is not None:
        cut = (F.col("n_rows") >= max_rows) & (F.col("last_day") < end)
        found.append(F.when(cut, one("cut", F.date_add("last_day", 1), end)))
    out = seen.select("series", F.explode(F.array(*found)).alias("f")).where("f IS NOT NULL").select("series", "f.*")
    if expected is None:
        return out
    bounds = pages.groupBy("series").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    ends = expected.join(bounds, "series", "left")
    lo, hi, first, last = F.col("lo"), F.col("hi"), F.col("first"), F.col("last")
    outside = [
        F.when(first.isNull(), one("gap", lo, hi)),
        F.when(first > lo, one("gap", lo, F.date_sub(first, 1))),
        F.when(last < hi, one("gap", F.date_add(last, 1), hi)),
    ]
    return out.unionByName(ends.select("series", F.explode(F.array(*outside)).alias("f")).where("f IS NOT NULL").select("series", "f.*"))
