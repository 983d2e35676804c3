import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelsmith.functions import columns as C
from panelsmith.functions import dates as D
from panelsmith.functions.hashing import fold_of, md5_bucket, split_label
from panelsmith.operators.reshape import calendar_one_hot, concat_align, melt, one_hot_decode, pivot_wide


def test_rate_invert_fixture(spark):
    df = spark.createDataFrame(
        [("DEXJPUS", 100.0), ("DEXUSAL", 0.7), ("CCUSSP01DEM650N", 1.1), ("DEXJPUS", 0.0)], "sid string, v double"
    )
    got = [r.x for r in df.select(C.quote_suffix_invert("sid", "v").alias("x")).collect()]
    assert got == [0.01, 0.7, 1.1, None]


def test_month_label_parse(spark):
    df = spark.createDataFrame([("feb. 2006",), ("may 2006",), ("September 2010",), ("xyz 2006",)], "s string")
    m, y = D.month_label_parts("s")
    assert [tuple(r) for r in df.select(m, y).collect()] == [(2, 2006), (5, 2006), (9, 2010), (None, 2006)]


def test_period_split_three_forms(spark):
    df = spark.createDataFrame([("2006-04",), ("2006-M04",), ("20060401",)], "s string")
    y, m = D.period_from_label("s")
    assert [tuple(r) for r in df.select(y, m).collect()] == [(2006, 4)] * 3


def test_month_name_strict(spark):
    ok = spark.createDataFrame([("March",), (" december ",)], "m string")
    assert [r[0] for r in ok.select(D.month_from_name("m")).collect()] == [3, 12]
    bad = spark.createDataFrame([("Marchy",)], "m string")
    with pytest.raises(Exception):
        bad.select(D.month_from_name("m")).collect()


def test_quarter_month(spark):
    df = spark.createDataFrame([("Mar",), ("Jun",), ("Sep",), ("Dec",), ("Feb",)], "q string")
    assert [r[0] for r in df.select(D.quarter_month("q")).collect()] == [3, 6, 9, 12, None]


def test_date_bounds_and_int_dates(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 15),)], "d date")
    r = df.select(D.prev_month_end("d"), D.day_before("d"), D.yyyymmdd("d"), D.from_yyyymmdd(D.yyyymmdd("d"))).first()
    assert tuple(r) == (dt.date(2026, 2, 28), dt.date(2026, 3, 14), 20260315, dt.date(2026, 3, 15))


def test_casts(spark):
    df = spark.createDataFrame([("1.5",), (".",)], "s string")
    assert [r[0] for r in df.select(C.lenient_cast("s", "double")).collect()] == [1.5, None]
    with pytest.raises(Exception):
        df.select(C.strict_cast("s", "double")).collect()


def test_nan_becomes_null_then_counts_once(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1.0, None], "b": [float("nan"), 2.0]})
    df = C.nan_to_null(spark.createDataFrame(pdf))
    from panelsmith.operators.quality import missing_profile

    assert {r.column_name: r.n_missing for r in missing_profile(df).collect()} == {"a": 1, "b": 1}


def test_override_chain_first_match_wins(spark):
    df = spark.createDataFrame(
        [("australia", 2006, 4, 90.0, None), ("australia", 2010, 3, None, 95.0), ("canada", 2010, 3, None, 95.0)],
        "country string, year int, month int, cpi double, patch double",
    )
    g = F.col("country") == "australia"
    expr = C.override_chain(
        "cpi",
        [(g & (F.col("year") == 2006) & F.col("month").isin(3, 4, 5), F.lit(84.5)), (g & F.col("cpi").isNull(), F.col("patch"))],
    )
    assert [r[0] for r in df.select(expr).collect()] == [84.5, 95.0, None]


def test_norm_helpers(spark):
    df = spark.createDataFrame([(" South Africa ",)], "Name string")
    out = C.norm_columns(df.toDF(" Name "))
    assert out.columns == ["name"]
    assert out.select(C.norm_string("name")).first()[0] == "south_africa"
    wide = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert C.select_slice(wide, "b", "c").columns == ["b", "c"]


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(0, 5000)
    a = df.select("id", split_label("id").alias("s"), fold_of("id", 5).alias("f"))
    b = df.repartition(7).select("id", split_label("id").alias("s"), fold_of("id", 5).alias("f"))
    assert a.exceptAll(b).count() == 0
    shares = {r.s: r["count"] for r in a.groupBy("s").count().collect()}
    assert 0.75 < shares["train"] / 5000 < 0.85
    assert df.select(md5_bucket("id", 10).alias("b")).agg(F.min("b"), F.max("b")).first() == (0, 9)


def test_one_hot_sunday_and_decode(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (None,)], "d date")
    enc = calendar_one_hot(df, "d")
    r = enc.first()
    assert r.dow_1 == 1 and r.month_1 == 1 and sum(r[f"dow_{i}"] for i in range(1, 8)) == 1
    nul = enc.collect()[1]
    assert sum(nul[f"month_{i}"] for i in range(1, 13)) == 0
    dec = one_hot_decode(enc, "month", list(range(1, 13)), "month")
    assert [r.month for r in dec.collect()] == [1, None]


def test_melt_keeps_nulls_and_pivot_roundtrip(spark):
    wide = spark.createDataFrame([(200601, None, 2.0)], "p int, x double, y double")
    long = melt(wide, ["p"], ["x", "y"], "k", "v")
    assert sorted((r.k, r.v) for r in long.collect()) == [("x", None), ("y", 2.0)]
    back = pivot_wide(long, ["p"], "k", ["x", "y"], "v", "max")
    assert back.first().asDict() == {"p": 200601, "x": None, "y": 2.0}


def test_concat_align(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "a int, c int")
    out = concat_align([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, None), (3, None, 4)]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.12345,), (-0.12345,), (1.00005,)], "x double")
    assert [r[0] for r in df.select(C.round_half_up("x", 4)).collect()] == [0.1235, -0.1235, 1.0001]
