"""End-to-end run over a landing zone: every source normalised, the panel
assembled with the default (reference) rules, checks reported, the missing
target imputed, results written as Parquet.

Landing layout under ``landing`` (see ``sources.normalise`` for each shape)::

    rates/series_id=<ID>/*.json      oil/series=<column>/*.json     reserves/*.json
    conflict_events.csv   price_index.csv   risk_index.csv   shipping_index.csv.gz   index_patch.csv

Outputs under ``out``: ``panel/``, ``outliers/``, ``outliers_events_zero_filled/``,
``outliers_events_placed/``, ``outlier_counts/``, ``missing/``, ``coverage/``,
``unmatched/``, ``final/``, ``scores/``, ``importances/``, ``evaluation/``,
``metric_gaps/``, ``selection/``, ``null_counts/``, ``complete_groups/``,
``skipped_groups/`` (all Parquet).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelsmith.operators import outliers as O
from panelsmith.operators import quality as Q
from panelsmith.operators import stats as S
from panelsmith.operators.impute import cv_scores, feature_importances
from panelsmith.operators.placement import period_end_place
from panelsmith.plans.imputation import ImputationResult, impute_groups
from panelsmith.plans.panel import PanelSpec, build_panel
from panelsmith.sources import dims
from panelsmith.sources import normalise as N
from panelsmith.sources.landed import write_csv, write_parquet

PANEL_FEATURES = [
    "interest_rate", "fx_rate", "brent_dollars_per_barrel", "wti_dollars_per_barrel",
    "events", "cpi", "gpr_index", "lsci", "year",
]
DAILY_CHECKED = ["interest_rate", "fx_rate", "brent_dollars_per_barrel", "wti_dollars_per_barrel", "events"]


@dataclass
class PipelineResult:
    panel: DataFrame
    outliers: DataFrame
    missing: DataFrame
    imputation: ImputationResult


def load_sources(spark: SparkSession, landing: str, gpr_schema: str) -> dict:
    """All normalised source tables of a landing zone, keyed as ``build_panel``
    expects them. Rows of names that no group matches are left out; see
    ``unmatched_names`` for their report."""
    j = lambda *p: os.path.join(landing, *p)
    base = N.rates_panel(spark, j("rates"))
    cpi = N.period_index(spark, j("price_index.csv")).withColumnRenamed("value", "cpi")
    patch = N.quarterly_patch(spark, j("index_patch.csv"), "australia")
    return dict(
        base=base,
        prices=N.price_panel(spark, j("oil")),
        events=N.event_counts(spark, j("conflict_events.csv")),
        index=cpi.where(F.col("country").isNotNull()),
        patch=patch,
        gpr=N.wide_index(spark, j("risk_index.csv"), gpr_schema),
        lsci=N.shipping_index(spark, j("shipping_index.csv.gz")),
        target=N.reserves(spark, j("reserves")).where(F.col("country").isNotNull()),
    )


def run_pipeline(
    spark: SparkSession,
    landing: str,
    out: str,
    gpr_schema: str,
    spec: PanelSpec | None = None,
    grid: dict | None = None,
    folds: int = 5,
    split_keys=("year", "month"),
    csv: bool = False,
    check_keys: bool = True,
    stage_outliers: bool = True,
) -> PipelineResult:
    """Normalise, assemble, check, impute and write. The panel is written once
    and every later step reads the written table (lineage cut, reusable).
    With ``csv`` the panel and the final table are also written as header CSV
    (``panel_csv/``, ``final_csv/``; distributed, no index column)."""
    spec = spec or PanelSpec()
    src = load_sources(spark, landing, gpr_schema)
    write_parquet(unmatched_names(spark, landing, gpr_schema), os.path.join(out, "unmatched"))
    if check_keys:
        # the joins assume each right side is unique on its key; fail fast
        # (one aggregate per source) instead of fanning rows out silently
        period_key = [spec.group, "year", "month"]
        Q.assert_unique(src["base"], [spec.group, spec.date])
        Q.assert_unique(src["prices"], [spec.date])
        for name in ("events", "index", "patch", "gpr", "lsci", "target"):
            Q.assert_unique(src[name], period_key)
    stages: dict = {}
    panel = build_panel(**src, spec=spec, stages=stages)
    write_parquet(panel, os.path.join(out, "panel"))
    panel = spark.read.parquet(os.path.join(out, "panel"))
    if stage_outliers:
        # the reference checks events for outliers before and after month-end
        # placement; both reports come from the intermediate plans
        keys = [spec.group, spec.date, "year"]
        cols = [spec.group, spec.date, "year", "month", spec.events_col]
        zf_path = os.path.join(out, "stage_events_zero_filled")
        write_parquet(stages["events_zero_filled"].select(*cols), zf_path)
        zf = spark.read.parquet(zf_path)
        placed = period_end_place(zf, spec.events_col, [spec.group], ["year", "month"], spec.date)
        for name, frame in (("events_zero_filled", zf), ("events_placed", placed)):
            rep = O.iqr_outliers(frame, [spec.events_col], [spec.group, "year"], keys)
            write_parquet(rep, os.path.join(out, f"outliers_{name}"))

    outliers = O.iqr_outliers(panel, DAILY_CHECKED, [spec.group, "year"], [spec.group, spec.date, "year"])
    write_parquet(outliers, os.path.join(out, "outliers"))
    missing = Q.missing_profile(panel)
    write_parquet(missing, os.path.join(out, "missing"))
    write_parquet(Q.coverage(panel, [spec.group]), os.path.join(out, "coverage"))
    write_parquet(O.outlier_counts(outliers, [spec.group]), os.path.join(out, "outlier_counts"))

    res = impute_groups(
        panel, spec.group, [spec.group, spec.date], spec.date, spec.target_col, PANEL_FEATURES,
        split_keys=split_keys, grid=grid, folds=folds,
    )
    write_parquet(res.panel, os.path.join(out, "final"))
    write_parquet(cv_scores(spark, res.fitted), os.path.join(out, "scores"))
    write_parquet(feature_importances(spark, res.fitted), os.path.join(out, "importances"))
    write_parquet(res.evaluation, os.path.join(out, "evaluation"))
    write_parquet(S.metric_gaps(spark.read.parquet(os.path.join(out, "evaluation")), [spec.group]), os.path.join(out, "metric_gaps"))
    write_parquet(res.selection, os.path.join(out, "selection"))
    write_parquet(res.null_counts, os.path.join(out, "null_counts"))
    write_parquet(res.complete_groups, os.path.join(out, "complete_groups"))
    skipped = [(str(g), why) for g, why in sorted(res.fitted.reasons.items())]
    write_parquet(spark.createDataFrame(skipped, f"{spec.group} string, reason string"), os.path.join(out, "skipped_groups"))
    if csv:
        write_csv(panel, os.path.join(out, "panel_csv"))
        write_csv(spark.read.parquet(os.path.join(out, "final")), os.path.join(out, "final_csv"))
    return PipelineResult(panel=panel, outliers=outliers, missing=missing, imputation=res)


def unmatched_groups(spark: SparkSession, landing: str) -> DataFrame:
    """Source names of the event sheet that map to no group (reported, not
    silently dropped)."""
    raw = spark.read.option("header", True).csv(os.path.join(landing, "conflict_events.csv"))
    names = raw.select(F.regexp_replace(F.lower(F.trim("Country")), r"\s+", "_").alias("alias")).distinct()
    return dims.unmatched(dims.map_alias(names, "alias"), "alias")


def unmatched_names(spark: SparkSession, landing: str, gpr_schema: str) -> DataFrame:
    """(source, name) of every name or code that maps to no group, of all
    sources that carry one."""
    j = lambda *p: os.path.join(landing, *p)
    events = unmatched_groups(spark, landing).select(F.lit("conflict_events").alias("source"), F.col("alias").alias("name"))
    label = N.norm_string("Economy_Label").alias("alias")
    lsci = spark.read.option("header", True).csv(j("shipping_index.csv.gz")).select(label).distinct()
    codes = spark.read.option("header", True).csv(j("price_index.csv")).select(F.col("COUNTRY").alias("iso3")).distinct()
    pages = N.read_json_pages(spark, j("reserves"), "value array<struct<REF_AREA:string>>")
    areas = pages.select(F.explode("value.REF_AREA").alias("iso3")).distinct()
    wide = [c.split("_", 1)[1].upper() for c in StructType.fromDDL(gpr_schema).names if c.lower().startswith("gprc_")]
    sheet = spark.createDataFrame([(c,) for c in wide], "iso3 string")
    out = events.unionByName(dims.unmatched(dims.map_alias(lsci, "alias"), "alias").select(F.lit("shipping_index").alias("source"), F.col("alias").alias("name")))
    for source, df in (("price_index", codes), ("reserves", areas), ("risk_index", sheet)):
        out = out.unionByName(dims.unmatched(dims.map_iso3(df, "iso3"), "iso3").select(F.lit(source).alias("source"), F.col("iso3").alias("name")))
    return out
