import pytest
from pyspark.sql import functions as F

from panel_cases import MEDIUM, rows
from panelsmith.operators.outliers import flag_outliers, iqr_outliers, outlier_summary
from panelsmith.operators.quantiles import quantiles
from panelsmith.session import Tables


def _vals(spark, values):
    return spark.createDataFrame([(i, "g", v) for i, v in enumerate(values)], "id int, g string, v double")


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_iqr_fixture(spark, method):
    out = iqr_outliers(_vals(spark, [1.0, 2.0, 3.0, 4.0, 100.0]), ["v"], ["g"], ["id"], method=method)
    r = out.collect()
    assert [(x.outlier_value, x.q1, x.q3, x.iqr) for x in r] == [(100.0, 2.0, 4.0, 2.0)]


def test_iqr_on_fence_not_flagged(spark):
    assert iqr_outliers(_vals(spark, [1.0, 2.0, 3.0, 4.0, 7.0]), ["v"], ["g"], ["id"], method="exact").count() == 0


def test_iqr_zero_spread(spark):
    out = iqr_outliers(_vals(spark, [5.0, 5.0, 5.0, 5.0, 6.0]), ["v"], ["g"], ["id"], method="exact")
    assert [(r.outlier_value, r.iqr) for r in out.collect()] == [(6.0, 0.0)]


def test_iqr_null_never_flagged(spark):
    f = flag_outliers(_vals(spark, [1.0, None, 2.0]), ["v"], ["g"], ["id"], method="exact")
    assert f.where("is_outlier").count() == 0
    s = outlier_summary(f).collect()[0]
    assert (s.n_outliers, s.n_rows) == (0, 3)


def test_exact_quantiles_match_percentile_disc(spark):
    e = Tables(spark, MEDIUM).events
    ours = quantiles(e, "value", ["event_type"], [0.25, 0.5, 0.75], method="exact", names=["a", "b", "c"])
    ref = e.groupBy("event_type").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY value)").alias("a"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)").alias("b"),
        F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY value)").alias("c"),
    )
    assert rows(ours, "event_type", "a", "b", "c") == rows(ref, "event_type", "a", "b", "c")


def test_exact_quantiles_small_accuracy_still_exact(spark):
    # a coarse sketch only widens the band; the answer stays exact
    e = Tables(spark, MEDIUM).events
    ours = quantiles(e, "value", ["event_type"], [0.25, 0.75], method="exact", accuracy=50, names=["a", "c"])
    ref = e.groupBy("event_type").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY value)").alias("a"),
        F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY value)").alias("c"),
    )
    assert rows(ours, "event_type", "a", "c") == rows(ref, "event_type", "a", "c")


def test_hot_group_quantiles(spark):
    # one group holds most rows and many ties; exact answer unchanged
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"),
        (F.col("id") % 97).cast("double").alias("v"),
    )
    ours = quantiles(df, "v", ["g"], [0.25, 0.75], method="exact", accuracy=100, names=["a", "c"])
    ref = df.groupBy("g").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY v)").alias("a"),
        F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY v)").alias("c"),
    )
    assert rows(ours, "g", "a", "c") == rows(ref, "g", "a", "c")


def test_null_partition_is_one_partition(spark):
    df = spark.createDataFrame(
        [(i, None, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0])] + [(9, "g", 1.0)], "id int, g string, v double"
    )
    out = iqr_outliers(df, ["v"], ["g"], ["id"], method="exact").collect()
    assert [(r.id, r.outlier_value, r.q1, r.q3) for r in out] == [(4, 100.0, 2.0, 4.0)]


def test_year_added_from_int_dates(spark):
    from panelsmith.operators.outliers import with_year

    df = spark.createDataFrame([("a", 20060430, 1.0), ("a", 20071231, 2.0)], "country string, date int, v double")
    out = with_year(df, ["country", "year"], "date", "yyyyMMdd")
    assert [r.year for r in out.orderBy("date").collect()] == [2006, 2007]
    # present year column is kept as is
    assert with_year(out, ["country", "year"], "date", "yyyyMMdd").columns == out.columns
