"""Registered queries over the assembled panel: the checks the reference runs
on its joined panel (outliers by group and year, missing profile, duplicate
rows, target pivot) and the imputation pipeline itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelsmith.functions.columns import round_doubles
from panelsmith.operators import impute as IM
from panelsmith.operators import outliers as O
from panelsmith.operators import quality as Q
from panelsmith.operators.reshape import pivot_wide
from panelsmith.plans import inputs as I
from panelsmith.plans.imputation import impute_groups
from panelsmith.plans.registry import query
from panelsmith.session import Tables

PANEL_COLUMNS = [
    "year", "month", "nation", "day", "interest_rate", "fx_rate", "brent", "wti",
    "events", "cpi", "gpr_index", "lsci", "reserves",
]
CHECKED = ["interest_rate", "fx_rate", "brent", "wti", "events"]
NATION_KEYS = list(range(25))


def _panel(spark, sf_dir, reread: bool = True):
    """The assembled panel. Queries that read it several times (outliers: 3
    passes; imputation: every fit) get it materialized once in the shared
    folder, as the reference caches it; single-pass reports read the plan."""
    t = Tables(spark, sf_dir)
    return I.materialized_panel(t) if reread else I.build_test_panel(t)


_LONG_SQL = (
    I.PANEL_SQL
    + ", pl AS ("
    + " UNION ALL ".join(
        f"SELECT nation, day, year, '{c}' AS outlier_column, CAST({c} AS DOUBLE) AS v FROM panel" for c in CHECKED
    )
    + """),
q AS (
  SELECT nation, year, outlier_column, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3
  FROM pl GROUP BY nation, year, outlier_column),
flagged AS (
  SELECT pl.nation, pl.day, pl.year, pl.outlier_column, pl.v AS outlier_value, q.q1, q.q3, q.q3 - q.q1 AS iqr
  FROM pl JOIN q ON pl.nation = q.nation AND pl.year = q.year AND pl.outlier_column = q.outlier_column
  WHERE pl.v < q.q1 - 1.5 * (q.q3 - q.q1) OR pl.v > q.q3 + 1.5 * (q.q3 - q.q1))
"""
)


def _panel_outliers(spark, sf_dir):
    return O.iqr_outliers(_panel(spark, sf_dir), CHECKED, ["nation", "year"], ["nation", "day", "year"], method="exact")


@query(
    "panel_outliers",
    _LONG_SQL
    + """
SELECT nation, day, year, outlier_column, round(outlier_value, 4) AS outlier_value,
       round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr
FROM flagged
""",
)
def panel_outliers(spark, sf_dir):
    """IQR outliers of the daily columns per (nation, year)."""
    return round_doubles(_panel_outliers(spark, sf_dir), I.R4)


@query(
    "panel_outlier_years",
    _LONG_SQL + "SELECT outlier_column, year, count(*) AS n_outliers FROM flagged GROUP BY outlier_column, year",
)
def panel_outlier_years(spark, sf_dir):
    """Outliers per checked column and year (shocks show up as clusters)."""
    return _panel_outliers(spark, sf_dir).groupBy("outlier_column", "year").agg(F.count("*").alias("n_outliers"))


@query(
    "panel_missing",
    I.PANEL_SQL
    + "SELECT column_name, n_missing FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing FROM panel"
        for c in PANEL_COLUMNS
    )
    + ")",
)
def panel_missing(spark, sf_dir):
    """Missing values per panel column, one aggregate pass."""
    return Q.missing_profile(_panel(spark, sf_dir, reread=False))


@query(
    "panel_duplicates",
    I.PANEL_SQL
    + "SELECT count(*) AS n_duplicate_groups FROM (SELECT "
    + ", ".join(PANEL_COLUMNS)
    + " FROM panel GROUP BY ALL HAVING count(*) > 1)",
)
def panel_duplicates(spark, sf_dir):
    """Distinct panel rows occurring more than once (all columns)."""
    return Q.duplicate_groups(_panel(spark, sf_dir, reread=False))


@query(
    "pivot_target",
    I.PANEL_SQL
    + "SELECT year, month, "
    + ", ".join(f"round(max(reserves) FILTER (WHERE nation = {k}), 4) AS n_{k}" for k in NATION_KEYS)
    + " FROM panel GROUP BY year, month",
)
def pivot_target(spark, sf_dir):
    """(year, month) x nation of the target, one column per nation key."""
    p = _panel(spark, sf_dir, reread=False)
    wide = pivot_wide(p, ["year", "month"], "nation", NATION_KEYS, "reserves", "max", names=[f"n_{k}" for k in NATION_KEYS])
    return round_doubles(wide, I.R4)


# every setting of the reference's search up to the deepest tree, five folds
IMPUTE_GRID = IM.RUNNABLE_GRID
CANDIDATES = ["interest_rate", "fx_rate", "brent", "wti", "events", "cpi", "gpr_index", "lsci", "year"]


def run_imputation(spark, sf_dir, **kw):
    params = dict(grid=IMPUTE_GRID, folds=5)
    params.update(kw)
    return impute_groups(_panel(spark, sf_dir), "nation", ["nation", "day"], "day", "reserves", CANDIDATES, **params)


@query("impute_panel")
def impute_panel(spark, sf_dir):
    """The panel with its missing target tail imputed per nation (period
    split, F-test selection on the training rows, cross-validated forests)."""
    return round_doubles(run_imputation(spark, sf_dir).panel, I.R4)


def _stage_sql(stage: str, cte: str, col: str) -> str:
    return f"""
{stage}_v AS (SELECT nation, day, year, CAST({col} AS DOUBLE) AS v FROM {cte}),
{stage}_q AS (SELECT nation, year, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3
              FROM {stage}_v GROUP BY nation, year),
{stage}_o AS (
  SELECT '{stage}' AS stage, x.nation, x.day, x.year, x.v AS outlier_value, q.q1, q.q3, q.q3 - q.q1 AS iqr
  FROM {stage}_v x JOIN {stage}_q q ON x.nation = q.nation AND x.year = q.year
  WHERE x.v < q.q1 - 1.5 * (q.q3 - q.q1) OR x.v > q.q3 + 1.5 * (q.q3 - q.q1))"""


@query(
    "events_outliers_stages",
    I.PANEL_SQL
    + ","
    + _stage_sql("zero_filled", "p3", "events0")
    + ","
    + _stage_sql("placed", "p4", "events")
    + """
SELECT stage, nation, day, year, round(outlier_value, 4) AS outlier_value, round(q1, 4) AS q1,
       round(q3, 4) AS q3, round(iqr, 4) AS iqr
FROM (SELECT * FROM zero_filled_o UNION ALL SELECT * FROM placed_o)
""",
)
def events_outliers_stages(spark, sf_dir):
    """Events outliers per (nation, year) after the zero fill and again after
    month-end placement, as the reference checks them twice."""
    from panelsmith.operators.placement import period_end_place
    from panelsmith.plans.panel import build_panel
    from panelsmith.session import cut_lineage

    stages: dict = {}
    build_panel(**I.panel_inputs(Tables(spark, sf_dir)), spec=I.panel_spec(), stages=stages)
    # the outlier passes read each stage 3 times: materialize the zero-filled
    # stage once (5 columns) and derive the placed stage from it
    zf = cut_lineage(stages["events_zero_filled"].select("nation", "day", "year", "month", "events"), "events_stage")
    placed = period_end_place(zf, "events", ["nation"], ["year", "month"], "day")
    parts = []
    for stage, frame in [("zero_filled", zf), ("placed", placed)]:
        o = O.iqr_outliers(frame, ["events"], ["nation", "year"], ["nation", "day", "year"], method="exact")
        parts.append(o.select(F.lit(stage).alias("stage"), "nation", "day", "year", "outlier_value", "q1", "q3", "iqr"))
    return round_doubles(parts[0].unionByName(parts[1]), I.R4)
