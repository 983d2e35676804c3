"""Forests as tables: growing, nested scores and the join that scores."""

import numpy as np
import pytest
from panel_cases import MEDIUM
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from panelsmith.operators import forest as FO
from panelsmith.operators import impute as IM
from panelsmith.plans import q_flow, q_stats


@pytest.fixture(scope="module")
def signal(spark):
    """Three groups, four features (the last without meaning), five folds."""
    df = spark.range(0, 900).select(
        (F.col("id") % 3).cast("int").alias("g"),
        (F.col("id") % 5).cast("int").alias("fold"),
        F.array(*[(F.xxhash64("id", F.lit(i)) % 500 / 100.0).alias(f"x{i}") for i in range(4)]).alias("x"),
    )
    y = F.get("x", F.lit(0)) * 3 + F.when(F.get("x", F.lit(1)) > 1, 4.0).otherwise(0.0) + F.get("x", F.lit(2)) * F.get("x", F.lit(2))
    return df.select("g", "fold", (y * (F.col("g") + 1)).alias("y"), "x").cache()


def reached(tree, x, depth):
    """Value of the node that x reaches in ``depth`` steps."""
    at = 0
    for _ in range(depth):
        if tree["feature"][at] < 0:
            break
        at = tree["child"][2 * at + (x[tree["feature"][at]] > tree["threshold"][at])]
    return tree["value"][at]


def test_nested_scores_are_those_of_cut_forests(spark, signal):
    """Every (trees, depth) of one large forest equals the mean over its first
    trees, each stopped at that depth, walked one row at a time."""
    plans = [(g, [0, 1, 2, 3], "sqrt", 30, 12, True) for g in range(3)]
    forests = FO.packed(FO.merge_blocks(FO.grow_groups(signal, plans, "int", 7, 32)), "t")
    held = {(r.g, r.fold): [t.asDict() for t in r.trees] for r in forests.collect()}
    assert len(held) == 15 and all([t["tree"] for t in v] == list(range(30)) for v in held.values())
    want = {}
    for r in signal.where("fold = 2").collect():
        for n in (4, 30):
            for d in (1, 5, 12):
                p = float(np.mean([reached(t, r.x, d) for t in held[r.g, r.fold][:n]]))
                want.setdefault((r.g, n, d), []).append((r.y, p))
    got = {}
    for r in FO.nested_scores(signal.where("fold = 2"), forests, [4, 30], [1, 5, 12]).collect():
        got.setdefault((r.g, r.n_trees, r.depth), []).append((r.y, r.prediction))
    assert got.keys() == want.keys()
    for k in want:
        assert np.allclose(sorted(got[k]), sorted(want[k]))


def test_split_is_the_best_of_all(spark):
    draw = np.random.default_rng(1)
    binned = draw.integers(0, 9, (200, 3)).astype(np.int16)
    y = binned[:, 1] * 2.0 + draw.normal(size=200)
    w = draw.poisson(1.0, (1, 200))
    tree = FO.grow(binned, y, w, 1, 3, draw)[0]
    w = w[0]

    def gain(j, c):
        low = binned[:, j] <= c
        if not w[low].sum() or not w[~low].sum():
            return -1.0
        part = lambda m: (w[m] * y[m]).sum() ** 2 / w[m].sum()
        return part(low) + part(~low) - part(np.ones(200, bool))

    best = max((gain(j, c), j, c) for j in range(3) for c in range(9))
    assert (tree["feature"][0], tree["bin"][0]) == best[1:] and np.isclose(tree["gain"][0], best[0])
    sides = [binned[:, best[1]] <= best[2], binned[:, best[1]] > best[2]]
    assert np.allclose(tree["value"][1:], [np.average(y[m], weights=w[m]) for m in sides])


def test_bin_edges_hold_few_and_many_values():
    assert FO.bin_edges(np.array([3.0, 1.0, 3.0]), 32).tolist() == [2.0]
    assert FO.bin_edges(np.array([5.0, 5.0]), 32).tolist() == []
    many = FO.bin_edges(np.arange(10_000.0), 32)
    assert 30 <= len(many) <= 33 and (np.diff(many) > 0).all()
    tied = FO.bin_edges(np.array([0.0] * 9000 + list(range(1000))), 32)
    assert len(tied) and tied[0] > 0


def test_large_groups_equal_mllib(spark, signal):
    """The stored nodes of an MLlib forest, scored by the join, give what
    model.transform gives, and its importances."""
    rows = signal.where("g = 1")
    plans = [(1, [0, 2, 3], "sqrt", 8, 6, False)]
    forest = FO.packed(FO.merge_blocks(FO.fit_large(rows, plans, "int", 5, 32, 2)), "t")
    features = VectorAssembler(inputCols=["x0", "x2", "x3"], outputCol="features")
    flat = features.transform(rows.select("y", "x", *[F.get("x", F.lit(c)).alias(f"x{c}") for c in (0, 2, 3)]))
    model = RandomForestRegressor(labelCol="y", numTrees=8, maxDepth=6, featureSubsetStrategy="sqrt", seed=5).fit(flat)
    want = sorted((r.y, r.prediction) for r in model.transform(flat).collect())
    got = sorted(tuple(r) for r in FO.forest_scores(rows, forest, ["y"], 6).collect())
    assert np.allclose(got, want)
    shares = {r.feature: r.importance for r in FO.importances(forest).collect()}
    assert np.allclose([shares.get(c, 0.0) for c in (0, 2, 3)], model.featureImportances.toArray())


def test_both_ways_of_fitting_learn(spark, signal):
    df = signal.select("g", "fold", "y", F.lit("train").alias("split"), *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(4)])
    df = df.withColumn("id", F.monotonically_increasing_id())
    grid = {"numTrees": [5, 15], "maxDepth": [2, 6], "featureSubsetStrategy": ["all"]}
    for local_rows in (FO.LOCAL_ROWS, 0):
        fitted = IM.fit_group_forests(df, "g", [f"x{i}" for i in range(4)], "y", grid=grid, local_rows=local_rows)
        assert set(fitted.models) == {0, 1, 2} and len(fitted.scores) == 12
        assert all(b[1] == 6 for b in fitted.best.values())  # the deeper setting fits this signal better
        assert all(r.r2 > 0.9 for r in IM.evaluation(df, fitted).collect())
        imp = {(r.g, r.feature): r.importance for r in IM.feature_importances(spark, fitted).collect()}
        assert all(imp[g, "x0"] > imp[g, "x3"] for g in range(3))


def test_scoring_plan_does_not_grow_with_the_groups(spark):
    def plan(n):
        df = spark.range(0, 4 * n).select((F.col("id") % n).cast("int").alias("g"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
        df = df.withColumns({"split": F.lit("train"), "fold": (F.col("x") % 2).cast("int")})
        fitted = IM.fit_group_forests(df, "g", ["x"], "y", grid={"numTrees": [2], "maxDepth": [2], "featureSubsetStrategy": ["all"]})
        scored = IM.predict(df, fitted, ["g", "x"], only_missing=False)
        assert len(fitted.models) == n and scored.count() == 4 * n
        return scored._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(3) == plan(195)


def test_registered_searches_try_the_whole_grid(spark):
    res = q_flow.run_imputation(spark, MEDIUM)
    per_group = {g: [s for s in res.fitted.scores if s[0] == g] for g in res.fitted.models}
    assert q_flow.IMPUTE_GRID == IM.RUNNABLE_GRID and per_group
    assert all(len(v) == 24 and all(s[4] is not None for s in v) for v in per_group.values())
    assert len(IM.grid_settings(q_stats.LINE_GRID)) == 8


def test_large_groups_are_grown_like_small_ones(spark, monkeypatch):
    """With every row drawn once and every feature tried, a group spread over
    partitions and chunks gets the tree that one task grows, fold by fold."""
    monkeypatch.setattr(FO, "_poisson", lambda: np.ones(1 << 16, dtype=np.uint8))
    monkeypatch.setattr(FO, "BIN_ROWS", 64)
    ids = spark.range(0, 9000)
    rows = ids.select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") % 5).cast("int").alias("fold"), F.array(*[(F.xxhash64("id", F.lit(i)) % 9973 / 100.0) for i in range(3)]).alias("x"))
    rows = rows.withColumn("y", F.get("x", F.lit(0)) * 3 + F.get("x", F.lit(1)) * F.get("x", F.lit(2)) / 50 + F.col("g"))
    binned = FO.bin_large(rows.repartition(5), {g: [0, 1, 2] for g in range(3)}, "int", 16)
    got = {(r.g, r.fold): r.trees for r in FO.grow_large(binned, [(g, [0, 1, 2], "all", 2, 3, True) for g in range(3)], "int", 7).collect()}
    assert len(got) == 15
    held = rows.collect()
    for (g, fold), trees in got.items():
        x = np.array([r.x[:3] for r in held if r.g == g])
        edges = [FO.bin_edges(x[:, j], 16) for j in range(3)]
        bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int16)
        y, of = np.array([r.y for r in held if r.g == g]), np.array([r.fold for r in held if r.g == g])
        want = FO.grow(bins[of != fold], y[of != fold], np.ones((1, (of != fold).sum()), dtype=int), 3, 3, np.random.default_rng(0))[0]
        assert [t.tree for t in trees] == [0, 1]
        for t in trees:
            assert t.feature == want["feature"].tolist() and t.child == np.stack([want["left"], want["right"]], axis=1).ravel().tolist()
            assert t.threshold == [edges[j][b] if j >= 0 else None for j, b in zip(want["feature"], want["bin"])]
            assert np.allclose(t.value, want["value"]) and np.allclose(t.gain, want["gain"], atol=1e-6)


def test_bootstrap_draws_are_poisson():
    drawn = FO._poisson()
    assert abs(drawn.mean() - 1) < 1e-3 and abs(drawn.var() - 1) < 1e-3


def test_edges_from_summaries_are_those_of_all_values():
    draw = np.random.default_rng(3)
    for values in (draw.integers(0, 20, 5000) * 1.0, draw.integers(0, 500, 5000) / 7):
        parts = [FO._summary(v, np.ones(len(v)), 1024) for v in np.array_split(values, 7)]
        assert FO.summary_edges(*(np.concatenate(p) for p in zip(*parts)), 32).tolist() == FO.bin_edges(values, 32).tolist()
    values = draw.exponential(size=200_000)
    parts = [FO._summary(v, np.ones(len(v)), 1024) for v in np.array_split(values, 9)]
    edges = FO.summary_edges(*(np.concatenate(p) for p in zip(*parts)), 32)
    share = np.diff(np.searchsorted(np.sort(values), edges)) / len(values)
    assert len(edges) >= 31 and abs(share[1:-1] - 1 / 32).max() < 0.002


def test_a_large_search_needs_no_fit_per_fold(spark, signal, monkeypatch):
    """F1-F6: one job per level for all groups and folds, subsets that try
    equally many features share their forests, and scoring packs no rows."""
    for name in ("fit_large", "chunked"):
        monkeypatch.setattr(FO, name, lambda *a, **k: pytest.fail("one fit per fold, or rows packed for a join"))
    df = signal.select("g", "fold", "y", F.lit("train").alias("split"), *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(4)])
    grid = {"numTrees": [3, 9], "maxDepth": [2, 5], "featureSubsetStrategy": ["log2", "sqrt"]}
    fitted = IM.fit_group_forests(df, "g", [f"x{i}" for i in range(4)], "y", grid=grid, local_rows=0)
    scores = {s[:4]: s[4] for s in fitted.scores}
    assert len(scores) == 24 and all(scores[g, n, d, "log2"] == scores[g, n, d, "sqrt"] > 0 for g, n, d, _ in scores)
    assert all(r.r2 > 0.8 for r in IM.evaluation(df, fitted).collect())
    again = IM.fit_group_forests(df, "g", [f"x{i}" for i in range(4)], "y", grid=grid, local_rows=0)
    assert again.scores == fitted.scores


def test_scores_are_those_of_the_join(spark, signal, monkeypatch):
    """Missing features leave the prediction missing, NaN is larger than any
    threshold, groups without a forest give no row: as when rows are joined."""
    plans = lambda by_fold: [(g, [0, 1, 2, 3], "sqrt", 7, 6, by_fold) for g in range(2)]
    one, by_fold = (FO.packed(FO.merge_blocks(FO.grow_groups(signal, plans(b), "int", 7, 32)), "t") for b in (False, True))
    x = F.when(F.col("id") % 7 == 0, F.array(F.lit(None), *[F.get("x", F.lit(i)) for i in (1, 2, 3)]))
    x = x.when(F.col("id") % 5 == 0, F.array(F.get("x", F.lit(0)), F.lit(float("nan")), F.lit(2.0), F.get("x", F.lit(3)))).otherwise(F.col("x"))
    odd = signal.withColumn("id", F.xxhash64("y", "fold")).withColumn("x", x).withColumn("g", F.when(F.col("id") % 11 != 0, F.col("g"))).cache()

    def scored():
        nested = FO.nested_scores(odd, by_fold, [2, 9], [1, 4]).collect()
        return sorted(map(tuple, nested), key=repr), sorted(map(tuple, FO.forest_scores(odd, one, ["id"], 6).collect()), key=repr)

    now = scored()
    monkeypatch.setattr(FO, "BROADCAST_BYTES", 0)
    assert len(now[0]) > 1000 and any(r[1] is None for r in now[1])
    assert now == scored()


def test_forests_do_not_depend_on_the_order_of_arrival(spark, monkeypatch):
    """F2-F5: rows of equal bins are stored together and go down the trees as
    one, their draws the same however the rows were dealt before."""
    monkeypatch.setattr(FO, "BIN_ROWS", 512)
    ids = spark.range(0, 6000)
    x = F.array(*[(F.xxhash64("id", F.lit(i)) % 4).cast("double") for i in range(3)])
    rows = ids.select((F.col("id") % 2).cast("int").alias("g"), (F.col("id") % 3).cast("int").alias("fold"), x.alias("x"), (F.col("id") % 101).cast("double").alias("y"))
    plans = [(g, [0, 1, 2], "sqrt", 3, 3, True) for g in range(2)]
    grown = []
    for n in (3, 7):
        binned = FO.bin_large(rows.repartition(n, "id" if n == 3 else "y"), {g: [0, 1, 2] for g in range(2)}, "int", 16)
        grown.append({(r.g, r.fold): r.trees for r in FO.grow_large(binned, plans, "int", 7).collect()})
        chunks = [(r.g, len(r.y) // 8, np.frombuffer(r.bins, np.uint8).reshape(-1, 3)) for r in binned[-1].collect()]
        assert sum(c[1] for c in chunks) == 6000
        for _, size, bins in chunks:
            runs = 1 + int((bins[1:] != bins[:-1]).any(axis=1).sum())
            assert runs == len(np.unique(bins, axis=0)) < size / 2
    assert grown[0] == grown[1] and len(grown[0]) == 6


def test_errors_are_those_of_the_scores(spark, signal, monkeypatch):
    """F2-F5: errors summed in the tasks are the means over single rows, also
    where features, targets, folds or groups are missing."""
    plans = [(g, [0, 1, 2, 3], s, 7, 6, True) for g in range(2) for s in ("sqrt", "all")]
    forests = FO.packed(FO.merge_blocks(FO.grow_groups(signal, plans, "int", 7, 32)), "t")
    odd = signal.withColumn("id", F.xxhash64("y", "fold"))
    odd = odd.withColumn("x", F.when(F.col("id") % 7 == 0, F.array(F.lit(None), *[F.get("x", F.lit(i)) for i in (1, 2, 3)])).otherwise(F.col("x")))
    odd = odd.withColumns({c: F.when(F.pmod("id", F.lit(m)) != 0, F.col(c)) for c, m in (("g", 11), ("y", 13), ("fold", 17))}).cache()
    keys = ["g", "fold", "subset", "n_trees", "depth"]
    scores = FO.nested_scores(odd, forests, [2, 9], [1, 4])
    want = {tuple(r)[:5]: r.mse for r in scores.groupBy(*keys).agg(F.avg((F.col("y") - F.col("prediction")) ** 2).alias("mse")).collect()}
    for _ in range(2):
        got = {tuple(r)[:5]: r.mse for r in FO.nested_errors(odd, forests, [2, 9], [1, 4]).collect()}
        assert got.keys() == want.keys() and len(got) == 80
        assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
        monkeypatch.setattr(FO, "BROADCAST_BYTES", 0)


def test_errors_of_stored_bins_are_those_of_the_rows(spark, monkeypatch):
    """the search scores the stored bins, a cell at a time, and neither
    reads the rows again nor sends them one by one to be binned."""
    ids = spark.range(0, 4000)
    x = F.array(F.lit(None).cast("double"), *[(F.xxhash64("id", F.lit(i)) % 9).cast("double") for i in range(3)])
    rows = ids.select((F.col("id") % 2).cast("int").alias("g"), (F.col("id") % 3).cast("int").alias("fold"), x.alias("x"), (F.col("id") % 101).cast("double").alias("y"))
    cols = {0: [1, 2, 3], 1: [2, 3]}
    for held in (FO.SORTED_ROWS, 300):
        monkeypatch.setattr(FO, "SORTED_ROWS", held)
        binned = FO.bin_large(rows, cols, "int", 4, {0: [0, 1, 2], 1: [0, 1, 2]})
        assert sum(len(r.y) // 8 for r in binned[-1].collect()) == 4000
        plans = [(g, cols[g], s, 5, 4, True) for g in cols for s in ("sqrt", "all")]
        forests = FO.packed(FO.merge_blocks(FO.grow_large(binned, plans, "int", 7)), "t")
        want = {tuple(r)[:5]: r.mse for r in FO.nested_errors(rows, forests, [2, 9], [1, 4]).collect()}
        got = {tuple(r)[:5]: r.mse for r in FO.binned_errors(binned, forests, [2, 9], [1, 4]).collect()}
        assert got.keys() == want.keys() and len(got) == 48
        assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_search_of_large_groups_scores_stored_bins(spark, signal, monkeypatch):
    """the scores of a search are the same from bins and from rows."""
    df = signal.select("g", "fold", "y", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(4)]).withColumn("split", F.lit("train"))
    grid = {"numTrees": [3, 5], "maxDepth": [2, 4], "featureSubsetStrategy": ["sqrt"]}
    fit = lambda: IM.fit_group_forests(df, "g", [f"x{i}" for i in range(4)], "y", grid=grid, local_rows=0).scores
    with monkeypatch.context() as m:
        m.setattr(FO, "nested_errors", None)  # not used
        by_bins = fit()
    monkeypatch.setattr(FO, "binned_errors", lambda *a: None)
    assert [r[:4] for r in by_bins] == [r[:4] for r in fit()]
    assert [r[4] for r in by_bins] == pytest.approx([r[4] for r in fit()], rel=1e-9)
