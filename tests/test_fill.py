import datetime as dt

import pytest
from pyspark.sql import functions as F

from panel_cases import MEDIUM, rows
from panelsmith.operators.fill import forward_fill
from panelsmith.plans.inputs import spine
from panelsmith.session import Tables

D = dt.date


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_daily_fill_fixture(spark, strategy):
    df = spark.createDataFrame(
        [("a", D(2006, 5, 1), None), ("a", D(2006, 5, 2), 5.0), ("a", D(2006, 5, 3), None), ("b", D(2006, 5, 1), None)],
        "g string, d date, v double",
    )
    out = forward_fill(df, ["v"], ["g"], ["d"], strategy=strategy, bucket=F.trunc("d", "month"))
    assert rows(out, "g", "d", "v") == [
        ("a", D(2006, 5, 1), None), ("a", D(2006, 5, 2), 5.0), ("a", D(2006, 5, 3), 5.0), ("b", D(2006, 5, 1), None)
    ]


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_period_fill_takes_value_from_later_peer(spark, strategy):
    # ordered by (year, month): days of a month are peers (RANGE frame)
    df = spark.createDataFrame(
        [("a", 2006, 1, 1, None), ("a", 2006, 1, 2, 5.0), ("a", 2006, 2, 3, None)],
        "g string, year int, month int, day int, v double",
    )
    out = forward_fill(df, ["v"], ["g"], ["year", "month"], strategy=strategy, bucket="year")
    assert [r.v for r in out.orderBy("day").collect()] == [5.0, 5.0, 5.0]


def test_fill_crosses_buckets(spark):
    df = spark.createDataFrame(
        [("a", D(2006, 1, 31), 1.0), ("a", D(2006, 2, 1), None), ("a", D(2006, 4, 2), None), ("a", D(2006, 4, 3), 2.0)],
        "g string, d date, v double",
    )
    out = forward_fill(df, ["v"], ["g"], ["d"], bucket=F.trunc("d", "month"))
    assert [r.v for r in out.orderBy("d").collect()] == [1.0, 1.0, 1.0, 2.0]


def test_bucketed_equals_window_on_spine(spark):
    s = spine(Tables(spark, MEDIUM))
    a = forward_fill(s, ["price"], ["nation"], ["day"], strategy="window")
    b = forward_fill(s, ["price"], ["nation"], ["day"], strategy="bucketed", bucket=F.trunc("day", "month"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fill_is_idempotent_and_keeps_observed(spark):
    s = spine(Tables(spark, MEDIUM)).withColumn("obs", F.col("price"))
    once = forward_fill(s, ["price"], ["nation"], ["day"], bucket="year")
    twice = forward_fill(once, ["price"], ["nation"], ["day"], bucket="year")
    assert once.exceptAll(twice).count() == 0
    assert once.where(F.col("obs").isNotNull() & (F.col("obs") != F.col("price"))).count() == 0
    assert once.count() == s.count()


def test_hot_group_is_spread_over_tasks(spark):
    """A group holding 90% of the rows is filled by many tasks under the
    bucketed strategy (one per (group, bucket) hash), by one under 'window'."""
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20000).select(
            F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
            F.col("id").cast("int").alias("t"),
            F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("v"),
        )
        def tasks(strategy, bucket=None):
            out = forward_fill(df, ["v"], ["g"], ["t"], strategy=strategy, bucket=bucket)
            # the filled column is consumed (else pruning drops the window);
            # the partition id is taken before the filter on g
            tagged = out.select("g", "v", F.spark_partition_id().alias("p"))
            return len(tagged.where("g = 'hot'").groupBy("p").agg(F.sum("v")).collect())
        assert tasks("window") == 1
        assert tasks("bucketed", F.floor(F.col("t") / 500)) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_default_bucket(spark):
    rows = [("a", D(2006, 1, 31), 1.0), ("a", D(2006, 2, 1), None), ("a", D(2006, 4, 2), None)]
    df = spark.createDataFrame(rows, "g string, d date, v double")
    assert [r.v for r in forward_fill(df, ["v"], ["g"], ["d"]).orderBy("d").collect()] == [1.0, 1.0, 1.0]
    ints = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None)], "g string, t int, v double")
    with pytest.raises(ValueError, match="bucket"):
        forward_fill(ints, ["v"], ["g"], ["t"])


def test_null_groups_are_filled_across_buckets(spark):
    rows = [(None, 2005, D(2005, 1, 1), 1.0), (None, 2006, D(2006, 1, 1), None), ("", 2006, D(2006, 1, 2), None), ("a", 2007, D(2007, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "g string, k int, d date, v double")
    for by in (["g"], ["g", "k"], ["k"]):
        a = forward_fill(df, ["v"], by, ["d"], strategy="window")
        b = forward_fill(df, ["v"], by, ["d"])
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_ranged_fill_spreads_any_stretch(spark):
    """One group, one month of seconds, half of the rows peers of one key: the
    fill equals the window's and its keys lie in many partitions."""
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20000).select(
            F.lit("hot").alias("g"),
            F.when(F.col("id") % 2 == 0, 7000).otherwise(F.col("id")).alias("t"),
            F.when(F.col("id") % 1001 == 1, F.col("id").cast("double")).alias("v"),
            F.col("id").alias("v2"),
        ).withColumn("v", F.when(F.col("t") == 7000, 5.0).otherwise(F.col("v")))
        a = forward_fill(df, ["v"], ["g"], ["t"], strategy="window")
        b = forward_fill(df, ["v"], ["g"], ["t"], strategy="ranged")
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.count() == 20000
        dealt = df.groupBy("g", "t").count().repartitionByRange("g", "t").select(F.spark_partition_id().alias("p"))
        assert dealt.distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_ranged_fill_of_nulls_and_nothing(spark):
    rows = [(None, None, 1.0, "x"), (None, 2, None, None), ("", 1, None, "y"), ("a", 3, None, None), ("a", None, 4.0, None)]
    df = spark.createDataFrame(rows, "g string, t int, v double, s string")
    for cols in (["v"], ["v", "s"]):
        a = forward_fill(df, cols, ["g"], ["t"], strategy="window")
        b = forward_fill(df, cols, ["g"], ["t"], strategy="ranged")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert forward_fill(df.limit(0), ["v"], ["g"], ["t"], strategy="ranged").collect() == []
