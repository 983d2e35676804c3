"""Landed-source normalisers on small literal fixtures (FIXTURES.md shapes)."""

import datetime as dt
import gzip
import json

import pytest

from panelsmith.sources import dims, landed
from panelsmith.sources import normalise as N

D = dt.date


def _write_json(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(obj))


def test_inferred_types(spark, tmp_path):
    """Every row counts: the value that does not fit is in the last file."""
    head = "flag,n,code,x,late,day,at,none,big,`odd` name.x\n"
    (tmp_path / "a.csv").write_text(head + "true,1,007,1,2,2024-02-29,2024-01-01 10:00:00,,9223372036854775807,1d\n" * 50)
    (tmp_path / "b.csv").write_text(head + "FALSE,-2,010,2.5e3,x,2023-01-31,2024-01-02T11:30:00,,9223372036854775808,NaN\n,,,,,,,,,\n")
    files = [str(tmp_path / f) for f in ("a.csv", "b.csv")]
    df = landed.read_inferred_csv(spark, files)
    assert [f.dataType.simpleString() for f in df.schema] == [
        "boolean", "bigint", "string", "double", "string", "date", "timestamp", "string", "double", "string",
    ]
    explicit = "flag boolean, n bigint, code string, x double, late string, day date, at timestamp, none string, big double, odd string"
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, map(tuple, landed.read_csv(spark, files, explicit, enforceSchema=True).collect())))
    only = landed.infer_csv_schema(spark, files[0])
    assert "`late` bigint" in only and "`x` bigint" in only
    (tmp_path / "c.csv").write_text("a,b\n")
    assert landed.infer_csv_schema(spark, str(tmp_path / "c.csv")) == "`a` string, `b` string"
    (tmp_path / "d.csv").write_text("day\n2024-02-30\n")  # no such day
    assert landed.infer_csv_schema(spark, str(tmp_path / "d.csv")) == "`day` string"


def test_rates_panel(spark, tmp_path):
    root = tmp_path / "rates"
    obs = lambda rows: {"observations": [dict(zip(["date", "realtime_start", "value"], r)) for r in rows]}
    # monthly rate: two revisions for April, the later one wins
    _write_json(root / "series_id=IRSTCI01JPM156N" / "p1.json",
                obs([("2006-04-01", "2006-05-01", "0.1"), ("2006-04-01", "2006-06-01", "0.2"), ("2006-05-01", "2006-06-01", ".")]))
    # daily FX quoted yen per USD: inverted; a '.' day is dropped with the gap
    _write_json(root / "series_id=DEXJPUS" / "p1.json",
                obs([("2006-04-03", "2006-04-03", "100"), ("2006-04-04", "2006-04-04", "."), ("2006-05-01", "2006-05-01", "50"),
                     ("2005-12-30", "2005-12-30", "90")]))
    out = N.rates_panel(spark, str(root), start="2006-01-01")
    got = sorted((r.date, r.country, r.interest_rate, r.fx_rate) for r in out.collect())
    assert got == [(D(2006, 4, 3), "japan", 0.2, 0.01)]


def test_price_panel(spark, tmp_path):
    root = tmp_path / "oil"
    page = lambda rows: {"response": {"data": [{"period": p, "value": v} for p, v in rows]}}
    _write_json(root / "series=brent_dollars_per_barrel" / "b1.json", page([("2006-01-03", "60.5"), ("2006-01-04", "61")]))
    _write_json(root / "series=brent_dollars_per_barrel" / "b2.json", page([("2025-01-02", "75")]))
    _write_json(root / "series=wti_dollars_per_barrel" / "w1.json", page([("2006-01-03", "59"), ("2025-01-02", "72")]))
    got = sorted(tuple(r) for r in N.price_panel(spark, str(root)).collect())
    assert got == [(D(2006, 1, 3), 60.5, 59.0), (D(2025, 1, 2), 75.0, 72.0)]


def test_reserves_usd_only(spark, tmp_path):
    rec = lambda v, a, t, u: {"OBS_VALUE": v, "REF_AREA": a, "TIME_PERIOD": t, "UNIT_MEASURE": u}
    _write_json(tmp_path / "reserves" / "p.json", {"value": [rec("10.5", "JPN", "2006-04", "USD"), rec("9", "JPN", "2006-04", "XDR"),
                                                        rec("3", "XXX", "2006-05", "USD")]})
    got = sorted(((r.country, r.year, r.month, r.fx_reserves) for r in N.reserves(spark, str(tmp_path / "reserves")).collect()),
                 key=lambda t: (t[0] is None, t[0] or "", t[1], t[2]))
    # unknown code kept with a NULL group (reported, not silently dropped)
    assert got == [("japan", 2006, 4, 10.5), (None, 2006, 5, 3.0)]


def test_event_counts(spark, tmp_path):
    p = tmp_path / "conflict_events.csv"
    p.write_text("Country,Month,Year,Events\nSouth Africa,March,2006,7\nTurkey,May,2007,3\nFrance,January,2005,1\nAtlantis,May,2007,9\n")
    got = sorted(tuple(r) for r in N.event_counts(spark, str(p)).collect())
    assert got == [("south_africa", 3, 2006, 7), ("turkiye", 5, 2007, 3)]


def test_event_counts_unknown_month_fails(spark, tmp_path):
    p = tmp_path / "acled_bad.csv"
    p.write_text("Country,Month,Year,Events\nFrance,Smarch,2006,1\n")
    with pytest.raises(Exception):
        N.event_counts(spark, str(p)).collect()


def test_wide_index_melt_keeps_nulls(spark, tmp_path):
    p = tmp_path / "risk_index.csv"
    p.write_text("month,GPR,GPRC_JPN,GPRC_ZAF\n2005-12-01,1,2,3\n2006-01-01,1,0.5,\n")
    out = N.wide_index(spark, str(p), "month date, GPR double, GPRC_JPN double, GPRC_ZAF double")
    got = sorted((r.country, r.year, r.month, r.gpr_index) for r in out.collect())
    assert got == [("japan", 2006, 1, 0.5), ("south_africa", 2006, 1, None)]


def test_period_index(spark, tmp_path):
    p = tmp_path / "price_index.csv"
    p.write_text("TIME_PERIOD,COUNTRY,value\n2006-M04,DEU,101.5\n2006-M05,ITA,99\n")
    got = sorted(tuple(r) for r in N.period_index(spark, str(p)).collect())
    assert got == [("germany", 101.5, 2006, 4), ("italy", 99.0, 2006, 5)]


def test_shipping_index_gzip_and_aliases(spark, tmp_path):
    p = tmp_path / "shipping_index.csv.gz"
    body = ("Economy_Label,Month_Label,Index_Average_M2_2023__100_Value\n"
            "Russian Federation,feb. 2006,10.5\nRepublic of Korea,may 2006,20\nCanada,Sep. 2010,30\nNowhere,jan. 2006,1\n")
    p.write_bytes(gzip.compress(body.encode()))
    got = sorted(tuple(r) for r in N.shipping_index(spark, str(p)).collect())
    assert got == [("canada", 2010, 9, 30.0), ("russia", 2006, 2, 10.5), ("south_korea", 2006, 5, 20.0)]


def test_quarterly_patch(spark, tmp_path):
    p = tmp_path / "aucpi.csv"
    p.write_text("date,cpi_index\nMar 2006,84.5\nJun 2006,85.9\n")
    got = sorted(tuple(r) for r in N.quarterly_patch(spark, str(p), "australia").collect())
    assert got == [("australia", 2006, 3, 84.5), ("australia", 2006, 6, 85.9)]


def test_dimensions(spark):
    cat = dims.series_catalog(spark)
    assert cat.count() == 32
    inv = {r.series_id for r in cat.where("invert").collect()}
    assert "DEXJPUS" in inv and "DEXUSAL" not in inv and "CCUSSP01DEM650N" not in inv
    assert dims.countries(spark).count() == 16


def test_json_lines_pages(spark, tmp_path):
    from panelsmith.sources.landed import explode_records, read_json_pages

    p = tmp_path / "pages.jsonl"
    p.write_text("\n".join(json.dumps({"observations": [{"date": f"2006-01-0{i}", "value": str(i)}]}) for i in range(1, 6)))
    df = explode_records(read_json_pages(spark, str(p), "observations array<struct<date:string, value:string>>", multi_line=False), "observations")
    assert df.count() == 5


def test_parquet_ingest_turns_nan_into_null(spark, tmp_path):
    import pandas as pd

    from panelsmith.sources.landed import read_parquet

    path = str(tmp_path / "nan.parquet")
    spark.createDataFrame(pd.DataFrame({"a": [1.0, float("nan")], "b": ["x", "y"]})).write.parquet(path)
    got = sorted((r.b, r.a) for r in read_parquet(spark, path).collect())
    assert got == [("x", 1.0), ("y", None)]


def test_keep_groups_is_a_semi_join(spark):
    df = spark.createDataFrame([("japan", 1), ("atlantis", 2), ("japan", 3)], "country string, v int")
    assert sorted(r.v for r in N.keep_groups(df).collect()) == [1, 3]
