"""Imputation pipeline: calendar features, per-group F-test selection,
per-group forests with cross-validation, prediction of the missing target
and keyed write-back.

Steps (each a Spark job or an MLlib fit; only small tables reach the driver):

1. month (1..12) and day-of-week (1..7, 1 = Sunday) one-hot columns
2. split and fold columns from a hash of the split keys; by default whole
   periods go to one side (a monthly target repeated on daily rows would
   otherwise leak between train and test), ``split_keys=[key...]`` gives a
   row split
3. F-test of every candidate feature with the target per group, on the
   training rows (``select_on='all'`` uses every labelled row instead);
   features with p < alpha are kept per group, constant ones never are
4. one cross-validated forest per group on its selected features
5. predictions for the rows whose target is missing, written back through a
   left join on the row key; observed values are never changed
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.operators import impute as IM
from panelsmith.operators import stats as S
from panelsmith.operators.quality import null_row_counts
from panelsmith.operators.reshape import calendar_one_hot
from panelsmith.session import cut_lineage

CALENDAR_FEATURES = [f"month_{i}" for i in range(1, 13)] + [f"dow_{i}" for i in range(1, 8)]


@dataclass
class ImputationResult:
    panel: DataFrame  # input columns + is_imputed
    selection: DataFrame  # (group, feature, n, r, f_stat, p_value) of kept features
    fitted: IM.GroupForests
    evaluation: DataFrame  # (group, split, n, rmse, r2)
    null_counts: DataFrame  # (stage, n_rows, n_null_rows)
    complete_groups: DataFrame  # groups whose target has no missing value (nothing to impute)


def impute_groups(
    panel: DataFrame,
    group: str,
    key: Sequence[str],
    date_col: str,
    target: str,
    candidates: Sequence[str],
    split_keys: Sequence[str] = ("year", "month"),
    select_on: str = "train",
    alpha: float = 0.05,
    grid: dict | None = None,
    folds: int = 5,
    seed: int = 2026,
    group_threads: int = 4,
    parallelism: int = 2,
    materialize: bool = True,
) -> ImputationResult:
    key = list(key)
    feats = calendar_one_hot(panel, date_col)
    feats = IM.prepare(feats, target, list(split_keys), folds=folds)
    if materialize:
        # every fit, fold and prediction below re-reads this table: cut the
        # lineage once, laid out by group so each group's jobs read only its
        # own files
        feats = cut_lineage(feats, "features", partition_by=[group])
    candidates = [*candidates, *CALENDAR_FEATURES]

    labelled = feats.where(F.col(target).isNotNull())
    scored_rows = labelled if select_on == "all" else labelled.where(F.col("split") == "train")
    selection = S.select_features(S.f_regression(scored_rows, target, candidates, [group]), alpha)
    # (group, feature) pairs: at most groups x candidates rows
    chosen: dict = {}
    for r in selection.select(group, "feature", "p_value").orderBy(group, "p_value", "feature").collect():
        chosen.setdefault(r[0], []).append(r[1])

    fitted = IM.fit_group_forests(
        feats, group, candidates, target, grid=grid, folds=folds, seed=seed,
        group_threads=group_threads, parallelism=parallelism, features_by_group=chosen,
    )
    preds = IM.predict(feats, fitted, keep=key)
    out = IM.write_back(panel, preds, key, target)
    return ImputationResult(
        panel=out,
        selection=selection,
        fitted=fitted,
        evaluation=IM.evaluation(feats, fitted),
        null_counts=null_row_counts({"before": panel, "after": out.drop("is_imputed")}),
        complete_groups=feats.groupBy(group)
        .agg(F.count_if(F.col(target).isNull()).alias("n_missing"))
        .where(F.col("n_missing") == 0)
        .select(group),
    )
