import datetime as dt

from pyspark.sql import functions as F

from panelsmith.operators import quality as Q
from panelsmith.operators.impute import write_back
from panelsmith.operators.joins import outer_join_complete
from panelsmith.operators.placement import latest_per_key, period_end_place

D = dt.date


def test_duplicate_groups_fixture(spark):
    df = spark.createDataFrame([("x",), ("x",), ("x",), ("y",), (None,), (None,)], "v string")
    assert Q.duplicate_groups(df).first().n_duplicate_groups == 2


def test_key_duplicates_and_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert [tuple(r) for r in Q.key_duplicates(df, ["k"]).collect()] == [(1, 2)]
    import pytest

    with pytest.raises(ValueError):
        Q.assert_unique(df, ["k"])
    Q.assert_unique(df, ["k", "v"])


def test_period_end_fixture(spark):
    df = spark.createDataFrame(
        [("a", 2006, 5, D(2006, 5, d), 7) for d in (1, 2, 30)] + [("a", 2006, 6, D(2006, 6, 1), 3)],
        "g string, year int, month int, d date, events int",
    )
    out = period_end_place(df, "events", ["g"], ["year", "month"], "d")
    assert [r.events for r in out.orderBy("d").collect()] == [0, 0, 7, 3]


def test_latest_revision_no_fallback(spark):
    df = spark.createDataFrame(
        [("s", D(2006, 1, 1), D(2006, 2, 1), "1.0"), ("s", D(2006, 1, 1), D(2006, 3, 1), ".")],
        "sid string, date date, rt date, value string",
    )
    out = latest_per_key(df, ["sid", "date"], ["rt"]).withColumn("value", F.col("value").try_cast("double"))
    r = out.collect()
    assert len(r) == 1 and r[0].rt == D(2006, 3, 1) and r[0].value is None
    assert out.dropna().count() == 0


def test_outer_period_join_then_drop(spark):
    rate = spark.createDataFrame([("a", "200604", 1.5)], "g string, ym string, rate double")
    fx = spark.createDataFrame([("a", "200604", D(2006, 4, 3), 2.0), ("a", "200605", D(2006, 5, 1), 2.1)],
                               "g string, ym string, d date, fx double")
    out = outer_join_complete(fx, rate, ["g", "ym"]).collect()
    assert [(r.d, r.fx, r.rate) for r in out] == [(D(2006, 4, 3), 2.0, 1.5)]


def test_write_back_fixture(spark):
    base = spark.createDataFrame([(1, 10.0), (2, None), (3, None)], "k int, y double")
    preds = spark.createDataFrame([(1, 99.0), (2, 99.0)], "k int, prediction double")
    out = write_back(base, preds, ["k"], "y")
    got = sorted((r.k, r.y, r.is_imputed) for r in out.collect())
    assert got == [(1, 10.0, False), (2, 99.0, True), (3, None, False)]
    assert out.count() == base.count()


def test_missing_profile_and_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert {r.column_name: r.n_missing for r in Q.missing_profile(df).collect()} == {"a": 1, "b": 1}
    assert Q.rows_with_nulls(df).count() == 2
    c = Q.null_row_counts({"before": df, "after": df.fillna(0)}).collect()
    assert sorted((r.stage, r.n_null_rows) for r in c) == [("after", 0), ("before", 2)]


def test_coverage(spark):
    df = spark.createDataFrame([("a", 2006, 4), ("a", 2010, 12), ("b", 2020, 1)], "g string, year int, month int")
    got = {r.g: (r.min_yyyymm, r.max_yyyymm) for r in Q.coverage(df, ["g"]).collect()}
    assert got == {"a": ("200604", "201012"), "b": ("202001", "202001")}
