"""Page coverage, incremental revisions, merged sketches and open sheets."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelsmith.operators import sketches as SK
from panelsmith.operators.revisions import apply_vintage
from panelsmith.sources import normalise as N
from panelsmith.sources.coverage import page_coverage

D = dt.date


def test_page_coverage_finds_gaps_overlaps_and_cut_pages(spark):
    pages = [
        ("a", D(2020, 1, 1), D(2020, 1, 31), 31, D(2020, 1, 31)),
        ("a", D(2020, 1, 5), D(2020, 1, 10), 6, D(2020, 1, 10)),  # inside the first
        ("a", D(2020, 2, 1), D(2020, 2, 29), 20, D(2020, 2, 20)),  # cut at 20 rows
        ("a", D(2020, 4, 1), D(2020, 4, 30), 9, D(2020, 4, 9)),  # after a gap
        ("b", D(2020, 2, 1), D(2020, 5, 31), 5, D(2020, 2, 5)),  # ends early, below the limit
    ]
    frame = spark.createDataFrame(pages, "series string, start date, end date, n_rows int, last_day date")
    expected = spark.createDataFrame([(s, D(2020, 1, 1), D(2020, 5, 31)) for s in "abc"], "series string, lo date, hi date")
    got = {tuple(r) for r in page_coverage(frame, expected, max_rows=20).collect()}
    assert got == {
        ("a", "overlap", D(2020, 1, 5), D(2020, 1, 10)),
        ("a", "cut", D(2020, 2, 21), D(2020, 2, 29)),
        ("a", "gap", D(2020, 3, 1), D(2020, 3, 31)),
        ("a", "gap", D(2020, 5, 1), D(2020, 5, 31)),
        ("b", "gap", D(2020, 1, 1), D(2020, 1, 31)),
        ("c", "gap", D(2020, 1, 1), D(2020, 5, 31)),
    }
    assert page_coverage(frame.limit(0)).collect() == []


def test_overlapping_price_pages_must_agree(spark, tmp_path):
    page = '{"response": {"data": [{"period": "2006-01-02", "value": "%s"}]}}'
    for series, batch, value in (("brent_dollars_per_barrel", 1, "61"), ("wti_dollars_per_barrel", 1, "62"), ("wti_dollars_per_barrel", 2, "62")):
        os.makedirs(tmp_path / f"series={series}", exist_ok=True)
        (tmp_path / f"series={series}" / f"{batch}.json").write_text(page % value)
    assert [tuple(r) for r in N.price_panel(spark, str(tmp_path)).collect()] == [(D(2006, 1, 2), 61.0, 62.0)]
    (tmp_path / "series=wti_dollars_per_barrel" / "3.json").write_text(page % "63")
    with pytest.raises(Exception, match="different values for 2006-01-02"):
        N.price_panel(spark, str(tmp_path)).collect()


def _files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_vintages_touch_what_they_revise(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = lambda vintage, ids: spark.createDataFrame(
        [(i, i % 4, vintage, float(100 * vintage + i)) for i in ids], "id long, slice int, vintage int, value double"
    )
    apply_vintage(state, rows(1, range(40)), ["id"], ["vintage"], "slice")
    before = _files(state)
    new = rows(2, [2, 6, 41])
    apply_vintage(state, new, ["id"], ["vintage"], "slice")
    kept = {f for f in before if "slice=0" in f or "slice=3" in f}
    assert kept <= _files(state) and not {f for f in before if "slice=2" in f} & _files(state)
    want = {i: 100 + i for i in range(40)} | {i: 200 + i for i in (2, 6, 41)}
    read = lambda: {r.id: r.value for r in spark.read.parquet(state).collect()}
    assert read() == want
    apply_vintage(state, new, ["id"], ["vintage"], "slice")  # again
    apply_vintage(state, rows(1, [2, 5]), ["id"], ["vintage"], "slice")  # an old vintage, late
    apply_vintage(state, new.limit(0), ["id"], ["vintage"], "slice")  # nothing
    assert read() == want and spark.read.parquet(state).count() == 41


def test_merged_sketches_give_the_fences(spark):
    df = spark.range(0, 60_000).select(
        (F.col("id") % 2).alias("g"), (F.xxhash64("id") % 100_000).cast("double").alias("a"), F.when(F.col("id") < 500, F.col("id")).alias("few")
    )
    thirds = [df.where(F.col("a") % 3 == i) for i in (0, 1, 2, -1, -2)]
    stored = None
    for part in thirds:
        new = SK.column_sketches(part, ["a", "few"], ["g"])
        stored = new if stored is None else SK.merge_sketches(stored, new, ["g"])
    got = {(r.g, r.column): r for r in SK.fences(stored, ["g"]).collect()}
    n = {(r.g, r.column): r.n for r in stored.collect()}
    assert {k: v for k, v in n.items() if k[1] == "few"} == {(0, "few"): 250, (1, "few"): 250}
    for (g, c), r in got.items():
        values = sorted(x[0] for x in df.where((F.col("g") == g) & F.col(c).isNotNull()).select(F.col(c).cast("double")).collect())
        slack = 0 if c == "few" else SK.rank_error()
        for p, q in ((0.25, r.q1), (0.75, r.q3)):
            below, upto = sum(v < q for v in values), sum(v <= q for v in values)
            assert below <= (p + slack) * len(values) and upto >= (p - slack) * len(values)
        assert abs(r.upper - (r.q3 + 1.5 * (r.q3 - r.q1))) < 1e-9


def test_open_sheet_takes_new_columns(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"month": "2006-01-01", "GPRC_AUS": 1.5, "GPRC_BRA": null, "GPR": 9}\n')
    (tmp_path / "b.json").write_text('{"month": "2006-02-01", "GPRC_AUS": 2, "GPRC_USA": "3.25", "GPRC_XXX": 4}\n{"month": "2005-12-01", "GPRC_AUS": 7}\n')
    got = sorted(map(tuple, N.open_wide_index(spark, str(tmp_path)).collect()), key=str)
    assert got == [("australia", 2006, 1, 1.5), ("australia", 2006, 2, 2.0), ("brazil", 2006, 1, None), ("united_states", 2006, 2, 3.25)]


def test_message_of_nested_series(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        '<DataSet><Series COUNTRY="AUS" FREQ="M"><Obs TIME_PERIOD="2006-M04" OBS_VALUE="1.5"/><Obs TIME_PERIOD="2006-M05" OBS_VALUE="2"/></Series>'
        '<Series COUNTRY="XXX"><Obs TIME_PERIOD="2006-M04" OBS_VALUE="9"/></Series></DataSet>'
    )
    got = sorted(map(tuple, N.period_message(spark, str(tmp_path)).collect()), key=str)
    assert got == [("australia", 1.5, 2006, 4), ("australia", 2.0, 2006, 5), (None, 9.0, 2006, 4)]
