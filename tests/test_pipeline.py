"""End-to-end run over a small landing zone shaped like the reference's
sources (three countries, 2006-01..2007-12), checking the panel rules."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from panelsmith.plans.pipeline import run_pipeline, unmatched_groups, unmatched_names

D = dt.date
MONTHS = [(2006 + i // 12, i % 12 + 1) for i in range(24)]
COUNTRIES = {"australia": ("AUS", "IRSTCI01AUM156N", "DEXUSAL"),
             "germany": ("DEU", "IRSTCI01DEM156N", "CCUSSP01DEM650N"),
             "japan": ("JPN", "IRSTCI01JPM156N", "DEXJPUS")}
GPR_SCHEMA = "month date, GPR double, GPRC_AUS double, GPRC_DEU double, GPRC_JPN double"


def _json(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(obj))


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for ci, (name, (iso, rate_id, fx_id)) in enumerate(COUNTRIES.items()):
        rate = [{"date": f"{y}-{m:02d}-01", "realtime_start": "2008-01-01", "value": str(1 + i / 10 + ci)}
                for i, (y, m) in enumerate(MONTHS)]
        _json(root / "rates" / f"series_id={rate_id}" / "p.json", {"observations": rate})
        days = [1] if name == "germany" else [2, 9, 16, 23]
        fx = [{"date": f"{y}-{m:02d}-{d:02d}", "realtime_start": "2008-01-01", "value": str(100 + i + d / 100 + ci)}
              for i, (y, m) in enumerate(MONTHS) for d in days]
        _json(root / "rates" / f"series_id={fx_id}" / "p.json", {"observations": fx})
    for col, off in [("brent_dollars_per_barrel", 0), ("wti_dollars_per_barrel", 5)]:
        data = [{"period": f"{y}-{m:02d}-{d:02d}", "value": str(50 + i + d / 10 + off)}
                for i, (y, m) in enumerate(MONTHS) for d in range(1, 29) if not (col.startswith("brent") and d == 9)]
        _json(root / "oil" / f"series={col}" / "p.json", {"response": {"data": data}})
    names = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
             "November", "December"]
    lines = ["Country,Month,Year,Events"] + [
        f"{n.title()},{names[m - 1]},{y},{(i + 1) * 10 + ci}" for ci, n in enumerate(COUNTRIES) for i, (y, m) in enumerate(MONTHS)
    ] + ["Atlantis,May,2006,9"]
    (root / "conflict_events.csv").write_text("\n".join(lines) + "\n")
    imf = ["TIME_PERIOD,COUNTRY,value"] + [
        f"{y}-M{m:02d},{iso},{80 + i + ci}" for ci, (n, (iso, _, _)) in enumerate(COUNTRIES.items())
        for i, (y, m) in enumerate(MONTHS) if not (iso == "AUS" and (y, m) < (2006, 8))
    ]
    imf += ["2006-M04,XXA,1", "2006-M04,XXB,2"]
    (root / "price_index.csv").write_text("\n".join(imf) + "\n")
    (root / "index_patch.csv").write_text("date,cpi_index\nMar 2006,84.9\nJun 2006,85.9\nSep 2006,86.7\n")
    gpr = ["month,GPR,GPRC_AUS,GPRC_DEU,GPRC_JPN", "2005-12-01,1,1,1,1"] + [
        f"{y}-{m:02d}-01,1,{0.1 * i},{0.2 * i},{0.3 * i}" for i, (y, m) in enumerate(MONTHS)
    ]
    (root / "risk_index.csv").write_text("\n".join(gpr) + "\n")
    lsci = ["Economy_Label,Month_Label,Index_Average_M2_2023__100_Value"] + [
        f"{n.title()},{lab} {y},{10 + i + ci}" for ci, n in enumerate(COUNTRIES)
        for i, (y, lab) in enumerate([(2006, "feb."), (2006, "may"), (2006, "aug."), (2006, "nov."), (2007, "feb."), (2007, "may")])
    ]
    lsci += ["Mu,may 2006,1", "Lemuria,may 2006,2"]
    (root / "shipping_index.csv.gz").write_bytes(gzip.compress(("\n".join(lsci) + "\n").encode()))
    wb = [{"OBS_VALUE": str(1000 + 10 * i + 100 * ci), "REF_AREA": iso, "TIME_PERIOD": f"{y}-{m:02d}", "UNIT_MEASURE": u}
          for ci, (iso, _, _) in enumerate(COUNTRIES.values()) for i, (y, m) in enumerate(MONTHS) if (y, m) <= (2007, 6)
          for u in ("USD", "XDR")]
    wb += [{"OBS_VALUE": "1", "REF_AREA": c, "TIME_PERIOD": "2006-04", "UNIT_MEASURE": "USD"} for c in ("XXA", "XXC")]
    _json(root / "reserves" / "p.json", {"value": wb})
    return root


def test_pipeline_end_to_end(spark, landing, tmp_path):
    grid = {"numTrees": [10], "maxDepth": [3], "featureSubsetStrategy": ["sqrt"]}
    res = run_pipeline(spark, str(landing), str(tmp_path / "out"), GPR_SCHEMA, grid=grid, folds=2)
    p = res.panel
    rows = {(r.country, r.date): r for r in p.collect()}
    # cutoff after the fills
    assert min(d for _, d in rows) > D(2006, 4, 30)
    # daily grain for daily FX, one row per month for the monthly FX series
    assert p.where("country = 'germany'").count() == 20 and p.where("country = 'japan'").count() == 80
    # override beats the patch for australia in May 2006; June takes the patch;
    # July is filled from June; August has its own value
    assert rows[("australia", D(2006, 5, 2))].cpi == 84.5
    assert rows[("australia", D(2006, 6, 2))].cpi == 85.9
    assert rows[("australia", D(2006, 7, 23))].cpi == 85.9
    assert rows[("australia", D(2006, 8, 2))].cpi == 80 + 7
    # month-end placement: the month's events sit on the last observed day
    may = sorted((d, r.events) for (c, d), r in rows.items() if c == "japan" and d.month == 5 and d.year == 2006)
    assert [e for _, e in may] == [0, 0, 0, 5 * 10 + 2]
    # lsci: Feb 2006 moved to March (germany) / April (others), then filled;
    # May has its own value
    assert rows[("japan", D(2006, 5, 2))].lsci == 10 + 1 + 2
    # brent gaps (day 9) are filled from the last trading day
    assert rows[("japan", D(2006, 5, 9))].brent_dollars_per_barrel is not None
    # target tail after 2007-06 is missing before imputation
    assert rows[("japan", D(2007, 7, 2))].fx_reserves is None
    assert rows[("japan", D(2007, 6, 2))].fx_reserves == 1000 + 10 * 17 + 200
    # events outliers before / after placement: after placement every day
    # but the month's last is 0, so the month-end values stand out
    before = spark.read.parquet(str(tmp_path / "out" / "outliers_events_zero_filled")).count()
    after = spark.read.parquet(str(tmp_path / "out" / "outliers_events_placed")).count()
    assert after > before
    # missing report: one row per panel column
    assert res.missing.count() == len(p.columns)
    # imputation: observed targets kept, tail filled for fitted groups
    final = res.imputation.panel
    assert final.count() == p.count()
    fitted = set(res.imputation.fitted.models)
    j = final.alias("f").join(p.alias("p"), ["country", "date"])
    assert j.where(F.col("p.fx_reserves").isNotNull() & (F.col("f.fx_reserves") != F.col("p.fx_reserves"))).count() == 0
    left = final.where(F.col("fx_reserves").isNull()).select("country").distinct().collect()
    assert {r.country for r in left} <= set(COUNTRIES) - fitted
    assert fitted, "at least one country should have selected features and a model"


def test_unmatched_names_of_every_source(spark, landing):
    got = {(r.source, r.name) for r in unmatched_names(spark, str(landing), GPR_SCHEMA + ", GPRC_XXD double").collect()}
    assert got == {
        ("conflict_events", "atlantis"), ("shipping_index", "mu"), ("shipping_index", "lemuria"), ("price_index", "XXA"),
        ("price_index", "XXB"), ("reserves", "XXA"), ("reserves", "XXC"), ("risk_index", "XXD"),
    }


def test_unmatched_groups_reported(spark, landing):
    assert [r.alias for r in unmatched_groups(spark, str(landing)).collect()] == ["atlantis"]


def test_command_line_run(spark, landing, tmp_path, capsys):
    from panelsmith.__main__ import main

    grid = '{"numTrees": [5], "maxDepth": [3], "featureSubsetStrategy": ["sqrt"]}'
    main(["run", "--landing", str(landing), "--out", str(tmp_path / "cli"), "--gpr-schema", GPR_SCHEMA,
          "--folds", "2", "--grid", grid, "--csv"])
    out = capsys.readouterr().out
    assert "before:" in out and "after:" in out
    n = spark.read.parquet(str(tmp_path / "cli" / "panel")).count()
    assert spark.read.parquet(str(tmp_path / "cli" / "final")).count() == n
    assert spark.read.option("header", True).csv(str(tmp_path / "cli" / "final_csv")).count() == n


def test_duplicate_source_key_fails_fast(spark, landing, tmp_path):
    import shutil

    bad = tmp_path / "bad"
    shutil.copytree(landing, bad)
    with open(bad / "conflict_events.csv", "a") as fh:
        fh.write("Japan,May,2006,1\n")  # second row for (japan, 2006, 5)
    with pytest.raises(ValueError, match="not unique"):
        run_pipeline(spark, str(bad), str(tmp_path / "out"), GPR_SCHEMA, folds=2)


def test_event_coverage_flag(spark):
    from panelsmith.plans.panel import PanelSpec, build_panel

    D2 = dt.date
    base = spark.createDataFrame([("a", D2(2006, 5, 2)), ("a", D2(2006, 7, 3))], "country string, date date")
    prices = spark.createDataFrame([(D2(2006, 5, 2), 1.0, 2.0)], "date date, brent_dollars_per_barrel double, wti_dollars_per_barrel double")
    per = lambda col: spark.createDataFrame([], f"country string, year int, month int, {col} double")
    events = spark.createDataFrame([("a", 2006, 5, 3)], "country string, year int, month int, events int")
    patch = spark.createDataFrame([], "country string, year int, month int, patch_cpi double")
    p = build_panel(base, prices, events, per("cpi"), patch, per("gpr_index"), per("lsci"), per("fx_reserves"),
                    spec=PanelSpec(flag_event_coverage=True))
    got = sorted((r.date, r.events, r.events_covered) for r in p.collect())
    assert got == [(D2(2006, 5, 2), 3, True), (D2(2006, 7, 3), 0, False)]
