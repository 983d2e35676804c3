"""Data-quality reports, each a single aggregate pass over the data.

The checks of a notebook workflow (one job per column, one count per check)
become one grouped or global aggregate per report; only the tiny report tables
reach the driver, and only when the caller collects them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.functions.columns import any_null
from panelsmith.functions.dates import yyyymm


def key_duplicates(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` is not unique (stops at the first duplicate found)."""
    bad = key_duplicates(df, keys).take(1)
    if bad:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {bad[0].asDict()}")


def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of distinct rows (over ``cols``, default all) occurring more than
    once; NULLs group together. One row: ``n_duplicate_groups``."""
    cols = list(cols or df.columns)
    dup = df.groupBy(*cols).agg(F.count("*").alias("__n")).where(F.col("__n") > 1)
    return dup.agg(F.count("*").cast("bigint").alias("n_duplicate_groups"))


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long table (column_name, n_missing) from one aggregate pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing")) for c in cols]))
    )


def rows_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows where any of ``cols`` (default all) is NULL."""
    return df.where(any_null(list(cols or df.columns)))


def null_rows_by_group(df: DataFrame, by: Sequence[str], cols: Sequence[str], name: str = "n_null_rows") -> DataFrame:
    """Rows with a NULL in any of ``cols`` per group; groups without any are
    left out (as a filter-then-group would)."""
    return df.groupBy(*by).agg(F.count_if(any_null(cols)).cast("bigint").alias(name)).where(F.col(name) > 0)


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) of a DataFrame as a one-row DataFrame."""
    return df.agg(F.count("*").cast("bigint").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def null_row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, n_rows, n_null_rows) for several versions of a table, e.g.
    before and after imputation; each stage is one aggregate pass."""
    parts = [
        d.agg(
            F.lit(name).alias("stage"),
            F.count("*").cast("bigint").alias("n_rows"),
            F.count_if(any_null(d.columns)).cast("bigint").alias("n_null_rows"),
        )
        for name, d in stages.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coverage(df: DataFrame, by: Sequence[str], year: str = "year", month: str = "month") -> DataFrame:
    """min/max year and yyyymm per group. The periods are compared as integers
    (a hash aggregate) and formatted afterwards."""
    ym = F.col(year).cast("int") * 100 + F.col(month).cast("int")
    ends = df.groupBy(*by).agg(
        F.min(year).alias("min_year"), F.max(year).alias("max_year"), F.min(ym).alias("__first"), F.max(ym).alias("__last")
    )
    text = {f"{side}_yyyymm": yyyymm(F.floor(F.col(c) / 100), F.col(c) % 100) for side, c in (("min", "__first"), ("max", "__last"))}
    return ends.withColumns(text).drop("__first", "__last")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
