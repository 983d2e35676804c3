"""IQR outliers per partition of the data.

For every value column: q1, q3 and iqr = q3 - q1 per partition (e.g. country x
year); a value is an outlier iff it is strictly below q1 - 1.5*iqr or strictly
above q3 + 1.5*iqr. NULL is never an outlier; iqr = 0 flags any value that
differs from q1.

Plan: the checked columns are unpivoted to (keys, column, value); quartiles
per (partition, column) are grouped aggregates (partial + final, skew-safe);
they are written and joined back on (partition, column), by a broadcast while
their size allows. No window buffers a whole partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.functions.columns import round_half_up

from panelsmith.operators.joins import join_null_safe
from panelsmith.operators.quantiles import quantiles
from panelsmith.session import cut_lineage

OUTLIER_COLUMNS = ["outlier_column", "outlier_value", "q1", "q3", "iqr"]


def with_year(df: DataFrame, partition_cols: Sequence[str], date_col: str, date_format: str | None) -> DataFrame:
    """Add ``year`` from ``date_col`` when partitioning by year and it is absent."""
    if "year" in partition_cols and "year" not in df.columns:
        d = F.col(date_col)
        d = F.to_date(d.cast("string"), date_format) if date_format else F.to_date(d)
        df = df.withColumn("year", F.year(d))
    return df


def flag_outliers(
    df: DataFrame,
    value_cols: Sequence[str],
    partition_cols: Sequence[str],
    key_cols: Sequence[str],
    method: str = "approx",
    accuracy: int = 10000,
    whisker: float = 1.5,
    date_col: str | None = None,
    date_format: str | None = None,
) -> DataFrame:
    """Every (row, checked column) with its quartiles and an ``is_outlier`` flag.

    The checked columns are unpivoted first, so the quartiles of all columns
    come from one grouped quantile computation keyed by (partition, column)
    instead of one pass per column.
    """
    value_cols, partition_cols, key_cols = list(value_cols), list(partition_cols), list(key_cols)
    if date_col is not None:
        df = with_year(df, partition_cols, date_col, date_format)
    keep = list(dict.fromkeys([*key_cols, *partition_cols]))
    long = df.select(
        *keep,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("outlier_column"), F.col(c).cast("double").alias("outlier_value"))
                    for c in value_cols
                ]
            )
        ),
    )
    by = [*partition_cols, "outlier_column"]
    q = quantiles(long, "outlier_value", by, [0.25, 0.75], method=method, accuracy=accuracy, names=["q1", "q3"])
    # written, so that it is planned by its real size: while that is small, the
    # checked rows are not exchanged
    q = cut_lineage(q, "quartiles")
    # groups without any value have no quartiles: their rows get NULL bounds
    # and are never flagged
    joined = join_null_safe(long, q, by, "left").withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - F.lit(whisker) * F.col("iqr")
    hi = F.col("q3") + F.lit(whisker) * F.col("iqr")
    flag = F.coalesce((F.col("outlier_value") < lo) | (F.col("outlier_value") > hi), F.lit(False))
    return joined.withColumn("is_outlier", flag).select(*keep, *OUTLIER_COLUMNS, "is_outlier")


def iqr_outliers(df: DataFrame, value_cols, partition_cols, key_cols, **kw) -> DataFrame:
    """Long table: key_cols..., outlier_column, outlier_value, q1, q3, iqr."""
    flagged = flag_outliers(df, value_cols, partition_cols, key_cols, **kw)
    return flagged.where("is_outlier").select(*key_cols, *OUTLIER_COLUMNS)


def outlier_counts(outliers: DataFrame, by: Sequence[str], name: str = "n_outliers") -> DataFrame:
    """Outlier rows per group, most first (ties by the group keys)."""
    return outliers.groupBy(*by).agg(F.count("*").alias(name)).orderBy(F.desc(name), *by)


def outlier_summary(flagged: DataFrame) -> DataFrame:
    """Per checked column: outliers found, rows checked and their percent,
    from one aggregate over the flagged rows (0 outliers is reported as 0)."""
    return flagged.groupBy("outlier_column").agg(
        F.count_if("is_outlier").cast("bigint").alias("n_outliers"),
        F.count("*").cast("bigint").alias("n_rows"),
        round_half_up(F.try_divide(F.count_if("is_outlier") * F.lit(100.0), F.count("*")), 4).alias("pct_outliers"),
    )
