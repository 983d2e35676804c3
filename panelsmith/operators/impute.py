"""Per-group random-forest imputation.

Each group gets its own model search over numbers of trees, depths and features
tried per split. The search is nested: per fold and feature subset one forest of
the most trees and the greatest depth is grown on the other folds, and the
fold's rows are scored for every smaller setting by taking its first trees and
stopping at the smaller depth, so that a grid costs one forest per fold and
subset. ``operators.forest`` grows the groups in one job (groups beyond one
task's rows level by level over the whole cluster, deep forests of those by
MLlib) and scores all groups at once.
Only group keys, the grid scores and the importances (one row per group x
setting / feature) come to the driver.

Write-back is a left join on the row key; observed values are never replaced
and the row count is unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsmith.functions.hashing import fold_of, split_label
from panelsmith.operators import forest as FO
from panelsmith.operators.stats import regression_metrics

# The reference's full search space (trees, depth, features per split).
REFERENCE_GRID = {
    "numTrees": [50, 75],
    "maxDepth": [5, 10, 15, 20, 25, 30, 35, 40, 45],
    "featureSubsetStrategy": ["log2", "sqrt"],
}

# The deepest tree MLlib accepts.
MAX_MLLIB_DEPTH = 30

# The part of that space MLlib can run; the default.
RUNNABLE_GRID = REFERENCE_GRID | {"maxDepth": [d for d in REFERENCE_GRID["maxDepth"] if d <= MAX_MLLIB_DEPTH]}


@dataclass
class GroupForests:
    group_col: str
    features: list[str]
    label: str
    models: dict = field(default_factory=dict)  # group -> (numTrees, maxDepth, strategy) of its forest
    forest: DataFrame | None = None  # (g, fold, subset, trees): the forest of every group
    scores: list = field(default_factory=list)  # (group, numTrees, maxDepth, strategy, cv_mse)
    best: dict = field(default_factory=dict)  # group -> (numTrees, maxDepth, strategy, cv_mse)
    features_of: dict = field(default_factory=dict)  # group -> features its model uses
    skipped: list = field(default_factory=list)  # groups that cannot be fitted
    reasons: dict = field(default_factory=dict)  # group -> why it was skipped
    group_type: str = "string"

    def group_features(self, g) -> list[str]:
        return self.features_of.get(g, self.features)

    def vector(self):
        """The features of a row as one array, in the order of ``features``."""
        return F.array(*[F.col(f).cast("double") for f in self.features])


def grid_settings(grid: dict) -> list[tuple]:
    """(numTrees, maxDepth, featureSubsetStrategy) of a grid, in its order."""
    too_deep = [d for d in grid["maxDepth"] if d > MAX_MLLIB_DEPTH]
    if too_deep:
        raise ValueError(f"maxDepth {too_deep}: MLlib trees are at most {MAX_MLLIB_DEPTH} deep")
    return [(n, d, s) for n in grid["numTrees"] for d in grid["maxDepth"] for s in grid["featureSubsetStrategy"]]


def prepare(
    df: DataFrame,
    label: str,
    split_keys: Sequence[str],
    train_pct: int = 80,
    folds: int = 5,
) -> DataFrame:
    """Add ``split`` ('train'/'test') and ``fold`` from a hash of ``split_keys``.

    Using the period (e.g. year, month) as split key keeps a monthly target
    that repeats on daily rows on one side of the split (no leakage); using
    the row key reproduces a random row split.
    """
    keys = list(split_keys)
    return df.withColumns({"split": split_label(keys, train_pct), "fold": fold_of(keys, folds)})


def _wide(plans: list[tuple], sizes: dict, local_rows: int, n_folds: int) -> set:
    """The large groups whose forests are grown level by level."""
    nodes: dict = {}
    for p in plans:
        if sizes[p[0]] > local_rows:
            nodes[p[0]] = nodes.get(p[0], 0) + FO.level_nodes(p, n_folds)
    return {g for g, n in nodes.items() if n <= FO.LEVEL_NODES}


def _grown(
    rows: DataFrame, plans: list[tuple], sizes: dict, cols: dict, out: GroupForests, seed: int, max_bins: int, local_rows: int, threads: int, n_folds: int, folds: dict, binned: list
) -> DataFrame:
    """The forests of ``plans``, of small groups in one job, of large ones by
    a job per level and of deep ones among those by MLlib, merged and stored."""
    small = [p for p in plans if sizes[p[0]] <= local_rows]
    large = [p for p in plans if sizes[p[0]] > local_rows]
    by_level = _wide(plans, sizes, local_rows, n_folds)
    deep = [p for p in large if p[0] not in by_level]
    wide = [p for p in large if p[0] in by_level]
    of = lambda some: rows.where(F.col("g").isin(list(some)))
    parts = []
    if small:
        parts.append(FO.grow_groups(rows, small, out.group_type, seed, max_bins))
    if wide:
        if not binned:  # once for the search and the chosen settings
            own = {g: cols[g] for g in sizes if sizes[g] > local_rows}
            binned.append(FO.bin_large(of(own), own, out.group_type, max_bins, {g: folds[g] for g in own}))
        parts.append(FO.grow_large(binned[0], wide, out.group_type, seed))
    if deep:
        parts.append(FO.fit_large(of(p[0] for p in deep), deep, out.group_type, seed, max_bins, threads))
    blocks = parts[0]
    for part in parts[1:]:
        blocks = blocks.unionByName(part)
    return FO.packed(FO.merge_blocks(blocks), "forests")


def _errors(rows: DataFrame, forests: DataFrame, grid: dict, plans: list[tuple], sizes: dict, local_rows: int, n_folds: int, binned: list) -> DataFrame:
    """``nested_errors`` of the search; of groups grown level by level, from
    their stored bins."""
    settings = grid["numTrees"], grid["maxDepth"]
    wide = sorted(_wide(plans, sizes, local_rows, n_folds))
    of_wide = FO.binned_errors(binned[0], forests.where(F.col("g").isin(wide)), *settings) if wide else None
    if of_wide is None:
        return FO.nested_errors(rows, forests, *settings)
    if {p[0] for p in plans} == {*wide}:
        return of_wide
    rest = ~F.col("g").isin(wide)
    return of_wide.unionByName(FO.nested_errors(rows.where(rest), forests.where(rest), *settings))


def fit_group_forests(
    df: DataFrame,
    group_col: str,
    features: Sequence[str],
    label: str,
    grid: dict | None = None,
    folds: int = 5,
    seed: int = 2026,
    parallelism: int = 2,
    group_threads: int = 4,
    max_bins: int = 32,
    features_by_group: dict | None = None,
    local_rows: int = FO.LOCAL_ROWS,
) -> GroupForests:
    """Cross-validated forest per group on the ``split == 'train'`` rows with a
    non-null label. ``df`` must carry ``split`` and ``fold`` (see ``prepare``).
    A setting's score is the mean over folds of its MSE (smaller is better).

    ``features_by_group`` gives each group its own feature list (e.g. the
    features its F-test selected). Every group is fitted, on the folds that
    have rows of it; one whose rows all lie in one fold takes the first
    parameters of the grid, its score missing. Only a group that cannot be
    fitted (no feature, or a feature with missing values) is listed in
    ``skipped``, with the reason in ``reasons``; its targets stay missing.

    Groups of at most ``local_rows`` training rows are grown in one job, larger
    ones by a job per level; forests too deep for that by MLlib,
    ``parallelism * group_threads`` fits at a time. For a larger group, subsets
    that try equally many of its features name one forest (its draws come from
    the seed), which is grown and scored once."""
    grid = grid or RUNNABLE_GRID
    settings = grid_settings(grid)
    features = list(features)
    trees, depth = max(grid["numTrees"]), max(grid["maxDepth"])
    out = GroupForests(group_col=group_col, features=features, label=label, group_type=dict(df.dtypes)[group_col])
    train = df.where((F.col("split") == "train") & F.col(label).isNotNull())
    # one small aggregate: the folds, the rows and the missing features of each group
    found = train.groupBy(group_col).agg(
        F.collect_set(F.col("fold").cast("int")).alias("folds"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f).isNull()).alias(f"null_{i}") for i, f in enumerate(features)],
    )
    found = {r[0]: r for r in found.collect()}
    if features_by_group is not None:
        out.features_of = {g: list(features_by_group.get(g, [])) for g in found}
    for g in sorted(found):
        missing = [f for i, f in enumerate(features) if f in out.group_features(g) and found[g][f"null_{i}"]]
        if not out.group_features(g) or missing:
            out.skipped.append(g)
            out.reasons[g] = f"missing values in {', '.join(missing)}" if missing else "no feature"
    groups = [g for g in sorted(found) if g not in out.reasons]
    if not groups:
        return out
    number = {f: i for i, f in enumerate(features)}
    cols = {g: [number[f] for f in out.group_features(g)] for g in groups}
    sizes = {g: found[g]["n"] for g in groups}
    rows = train.where(F.col(group_col).isin(groups)).select(
        F.col(group_col).alias("g"), F.col("fold").cast("int").alias("fold"), F.col(label).cast("double").alias("y"), out.vector().alias("x")
    )
    binned: list = []
    args = (sizes, cols, out, seed, max_bins, local_rows, parallelism * group_threads, folds, {g: sorted(found[g]["folds"]) for g in groups}, binned)

    judged = [g for g in groups if len(found[g]["folds"]) > 1]
    scored = {}
    if judged:
        alike = {(g, s): s for g in judged for s in grid["featureSubsetStrategy"]}
        for g in judged:
            if sizes[g] > local_rows:
                first: dict = {}
                for s in grid["featureSubsetStrategy"]:
                    alike[g, s] = first.setdefault(FO.subset_size(s, len(cols[g])), s)
        plans = [(g, cols[g], s, trees, depth, True) for (g, s), own in alike.items() if s == own]
        forests = _grown(rows, plans, *args)
        by_fold = _errors(rows, forests, grid, plans, sizes, local_rows, folds, binned)
        of_setting = by_fold.groupBy("g", "n_trees", "depth", "subset").agg(F.avg("mse").alias("mse"))
        # rounded, so that sums added in another order give the same scores
        scored = {tuple(r)[:4]: float(f"{r.mse:.12g}") for r in of_setting.collect()}
    for g in groups:
        mine = [(g, n, d, s, scored.get((g, n, d, alike[g, s])) if g in judged else None) for n, d, s in settings]
        if g not in judged:
            mine = mine[:1]
        out.scores.extend(mine)
        out.best[g] = min(mine, key=lambda r: (r[4] or 0.0, r[1], r[2], r[3]))[1:]
        out.models[g] = out.best[g][:3]
    out.forest = _grown(rows, [(g, cols[g], s, n, d, False) for g, (n, d, s) in out.models.items()], *args)
    return out


def cv_scores(spark: SparkSession, fitted: GroupForests) -> DataFrame:
    """(group, num_trees, max_depth, feature_subset, cv_mse, neg_mse, is_best);
    ``neg_mse`` is the score in the greater-is-better convention."""
    rows = [(*r, None if r[4] is None else -r[4], fitted.best[r[0]] == r[1:]) for r in fitted.scores]
    return spark.createDataFrame(
        rows,
        f"{fitted.group_col} {fitted.group_type}, num_trees int, max_depth int, feature_subset string, cv_mse double, "
        "neg_mse double, is_best boolean",
    )


def feature_importances(spark: SparkSession, fitted: GroupForests) -> DataFrame:
    """(group, feature, importance, rank) of each group's best forest: every
    feature the group's model may use, 0 for those it does not."""
    found = {} if fitted.forest is None else {(r.g, r.feature): r.importance for r in FO.importances(fitted.forest).collect()}
    rows = []
    for g in fitted.models:
        of = [(f, found.get((g, fitted.features.index(f)), 0.0)) for f in fitted.group_features(g)]
        rows += [(g, f, float(v), i + 1) for i, (f, v) in enumerate(sorted(of, key=lambda t: (-t[1], t[0])))]
    return spark.createDataFrame(
        rows, f"{fitted.group_col} {fitted.group_type}, feature string, importance double, rank int"
    )


def predict(df: DataFrame, fitted: GroupForests, keep: Sequence[str], only_missing: bool = True) -> DataFrame:
    """Predictions of each group's model on its rows (by default only the rows
    whose label is missing), by one join whatever the number of groups. Groups
    without a model contribute nothing; a row that lacks a feature its trees
    ask for has a null prediction."""
    keep = list(keep)
    if fitted.forest is None:
        # no group could be fitted: no predictions, targets stay missing
        return df.limit(0).select(*keep, F.lit(None).cast("double").alias("prediction"))
    rows = df.where(F.col(fitted.label).isNull()) if only_missing else df
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = rows.select(F.col(fitted.group_col).alias("g"), *kept, fitted.vector().alias("x"))
    deepest = max(d for _, d, _ in fitted.models.values())
    scored = FO.forest_scores(rows, fitted.forest, [f"k{i}" for i in range(len(keep))], deepest)
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "prediction")


def evaluation(df: DataFrame, fitted: GroupForests) -> DataFrame:
    """RMSE and R2 of each group's best model on its train and test rows."""
    labelled = df.where(F.col(fitted.label).isNotNull())
    if not fitted.models:
        return regression_metrics(
            labelled.select(fitted.group_col, "split", fitted.label, F.lit(None).cast("double").alias("prediction")),
            fitted.label, "prediction", [fitted.group_col, "split"],
        )
    scored = predict(labelled, fitted, keep=[fitted.group_col, "split", fitted.label], only_missing=False)
    return regression_metrics(scored, fitted.label, "prediction", [fitted.group_col, "split"])


def write_back(base: DataFrame, predictions: DataFrame, key: Sequence[str], target: str, prediction: str = "prediction") -> DataFrame:
    """Left join predictions on the row key: the target keeps every observed
    value, a missing one takes the prediction; ``is_imputed`` marks those rows."""
    key = list(key)
    p = predictions.select(*key, F.col(prediction).alias("__pred"))
    joined = base.join(p, on=key, how="left")
    return joined.withColumns(
        {
            "is_imputed": F.col(target).isNull() & F.col("__pred").isNotNull(),
            target: F.coalesce(F.col(target), F.col("__pred")),
        }
    ).drop("__pred")
