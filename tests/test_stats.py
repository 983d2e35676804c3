import math

import pytest
from pyspark.sql import functions as F

from panelsmith.functions.hashing import md5_bucket
from panelsmith.operators import impute as IM
from panelsmith.operators import stats as S


def f_tail(f, dof):
    """P(F(1, dof) > f) by integrating the density of Student's t over (0, sqrt f)."""
    log_c = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    t, n = math.sqrt(f), 20_000
    at = [math.exp(log_c - (dof + 1) / 2 * math.log1p((t * i / n) ** 2 / dof)) for i in range(n + 1)]
    simpson = at[0] + at[-1] + 4 * sum(at[1:-1:2]) + 2 * sum(at[2:-1:2])
    return 1 - 2 * simpson * t / n / 3


def test_p_values_by_integration(spark):
    cases = [(f, d) for f in (1e-6, 0.01, 0.5, 1.0, 3.84, 4.9646, 12.0, 60.0) for d in (1, 2, 3, 10, 57, 1000, 10**6)]
    df = spark.createDataFrame([(float(f), d) for f, d in cases], "f double, dof long")
    for r in df.withColumn("p", S.f_pvalue(F.col("f"), F.col("dof"))).collect():
        assert abs(r.p - f_tail(r.f, r.dof)) < 1e-8, r


def test_p_values_at_the_edges(spark):
    rows = [(0.0, 10), (None, 10), (float("nan"), 10), (4.0, 0), (4.0, -1), (1e9, 50), (3.8415, 10**10), (0.3, 10**10)]
    df = spark.createDataFrame(rows, "f double, dof long")
    p = [r.p for r in df.select(S.f_pvalue(F.col("f"), F.col("dof")).alias("p")).collect()]
    assert p[:5] == [1.0, None, None, None, None] and 0 < p[5] < 1e-100
    # for large dof F(1, d) -> chi2(1): p = erfc(sqrt(F/2))
    assert abs(p[6] - math.erfc(math.sqrt(3.8415 / 2))) < 1e-7 and abs(p[7] - math.erfc(math.sqrt(0.15))) < 1e-7


def test_p_values_need_no_python_worker(spark):
    scores = spark.createDataFrame([("g", "x", 100, 0.5, 4.0)], "g string, feature string, n long, r double, f_stat double")
    plan = S.with_pvalues(scores)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_f_regression_constant_feature(spark):
    df = spark.range(0, 200).select(
        F.lit("g").alias("g"),
        F.col("id").cast("double").alias("x"),
        F.lit(1.0).alias("c"),
        (F.col("id") * 2.0 + (F.col("id") % 7)).alias("y"),
    )
    sc = S.with_pvalues(S.f_regression(df, "y", ["x", "c"], ["g"]))
    got = {r.feature: r for r in sc.collect()}
    assert got["c"].r is None and got["c"].f_stat is None and got["c"].p_value is None
    assert got["x"].r > 0.99 and got["x"].p_value < 1e-10
    sel = [r.feature for r in S.select_features(sc).collect()]
    assert sel == ["x"]


def test_regression_metrics(spark):
    df = spark.createDataFrame([("g", 1.0, 1.0), ("g", 2.0, 2.0), ("g", 3.0, 4.0)], "g string, y double, p double")
    r = S.regression_metrics(df, "y", "p", ["g"]).first()
    assert abs(r.rmse - math.sqrt(1 / 3)) < 1e-12
    assert abs(r.r2 - (1 - 1 / 2)) < 1e-12


def test_group_forests_learn_signal_and_impute(spark):
    n = 3000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("g"),
        "id",
        ((F.col("id") * 7919) % 1000 / 10.0).alias("x1"),
        ((F.col("id") * 104729) % 1000 / 10.0).alias("x2"),
    ).withColumn("y", F.col("x1") * 3.0 + F.when(F.col("x2") > 50, 20.0).otherwise(0.0))
    df = df.withColumn("y", F.when(md5_bucket("id", 10) != 0, F.col("y")))
    prep = IM.prepare(df, "y", ["id"], folds=2)
    grid = {"numTrees": [10], "maxDepth": [3, 5], "featureSubsetStrategy": ["all"]}
    fitted = IM.fit_group_forests(prep, "g", ["x1", "x2"], "y", grid=grid, folds=2, parallelism=2, group_threads=2)
    assert set(fitted.models) == {"a", "b"}
    ev = {(r.g, r.split): r for r in IM.evaluation(prep, fitted).collect()}
    assert ev[("a", "test")].r2 > 0.9 and ev[("b", "test")].r2 > 0.9
    imp = {(r.g, r.feature): r.importance for r in IM.feature_importances(spark, fitted).collect()}
    assert imp[("a", "x1")] > imp[("a", "x2")]
    preds = IM.predict(prep, fitted, keep=["g", "id"])
    assert preds.count() == prep.where(F.col("y").isNull()).count()
    out = IM.write_back(prep, preds, ["id"], "y")
    assert out.count() == n and out.where(F.col("y").isNull()).count() == 0
    # observed values untouched
    joined = out.alias("o").join(df.alias("d"), "id").where(F.col("d.y").isNotNull() & (F.col("o.y") != F.col("d.y")))
    assert joined.count() == 0
    # same seed, same scores
    again = IM.fit_group_forests(prep, "g", ["x1", "x2"], "y", grid=grid, folds=2, parallelism=2, group_threads=2)
    assert sorted(again.scores) == sorted(fitted.scores)


def test_selection_agrees_with_mllib_selector(spark):
    """Per group, the features kept at p < 0.05 equal MLlib's
    UnivariateFeatureSelector (F-test, fpr 0.05) on the same rows."""
    from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler

    from panel_cases import MEDIUM
    from panelsmith.session import Tables

    li = Tables(spark, MEDIUM).lineitem.select(
        "l_returnflag", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
    )
    feats = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    ours = {}
    for r in S.select_features(S.f_regression(li, "net", feats, ["l_returnflag"])).collect():
        ours.setdefault(r.l_returnflag, set()).add(r.feature)
    for flag in ["A", "N", "R"]:
        part = VectorAssembler(inputCols=feats, outputCol="x").transform(li.where(F.col("l_returnflag") == flag))
        sel = UnivariateFeatureSelector(featuresCol="x", labelCol="net", outputCol="sel", selectionMode="fpr")
        sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(0.05)
        model = sel.fit(part)
        assert {feats[i] for i in model.selectedFeatures} == ours.get(flag, set())


def test_period_split_removes_monthly_target_leakage(spark):
    """A monthly target repeated on daily rows: a row split lets the forest
    see every month in training and scores high on test rows; a period split
    keeps whole months out and scores far lower (no leakage)."""
    import datetime as dt

    from panelsmith.plans.imputation import impute_groups

    days = spark.range(0, 48 * 20).select(
        F.lit("g").alias("country"),
        F.date_add(F.lit(dt.date(2006, 1, 1)), (F.floor(F.col("id") / 20) * 31 + F.col("id") % 20).cast("int")).alias("date"),
        ((F.col("id") * 7919) % 101 / 10.0).alias("noise"),
    ).withColumns({"year": F.year("date"), "month": F.month("date")})
    ym = F.concat_ws("-", F.col("year").cast("string"), F.col("month").cast("string"))
    panel = days.withColumn("target", md5_bucket(ym, 1000).cast("double"))
    grid = {"numTrees": [30], "maxDepth": [8], "featureSubsetStrategy": ["all"]}

    def test_r2(split_keys):
        res = impute_groups(panel, "country", ["country", "date"], "date", "target", ["noise", "year"],
                            split_keys=split_keys, select_on="all", alpha=1.0, grid=grid, folds=2)
        return {r.split: r.r2 for r in res.evaluation.collect()}["test"]

    leaky = test_r2(["country", "date"])
    clean = test_r2(["year", "month"])
    assert leaky > 0.8 and clean < leaky - 0.4


def test_every_group_that_can_be_is_fitted(spark):
    df = spark.range(0, 400).select(
        F.when(F.col("id") < 396, F.lit("big")).when(F.col("id") < 398, F.lit("tiny")).when(F.col("id") == 398, F.lit("one")).otherwise(F.lit("gap")).alias("g"),
        "id", F.when(F.col("id") < 399, (F.col("id") % 13).cast("double")).alias("x"),
    ).withColumn("y", F.coalesce(F.col("x"), F.lit(1.0)) * 2.0)
    prep = IM.prepare(df, "y", ["id"], folds=2).withColumn("split", F.lit("train"))
    grid = {"numTrees": [5], "maxDepth": [3], "featureSubsetStrategy": ["all"]}
    fitted = IM.fit_group_forests(prep, "g", ["x"], "y", grid=grid, folds=2, parallelism=1, group_threads=2)
    assert set(fitted.models) == {"big", "tiny", "one"}
    assert fitted.skipped == ["gap"] and fitted.reasons == {"gap": "missing values in x"}
    assert fitted.best["one"][3] is None


def test_depth_beyond_the_limit_is_an_error(spark):
    df = spark.range(0, 40).selectExpr("'g' AS g", "id", "cast(id AS double) AS x", "cast(id AS double) AS y")
    prep = IM.prepare(df, "y", ["id"], folds=2)
    with pytest.raises(ValueError, match="30"):
        IM.fit_group_forests(prep, "g", ["x"], "y", grid=IM.REFERENCE_GRID, folds=2)
    assert len(IM.grid_settings(IM.RUNNABLE_GRID)) == 24
