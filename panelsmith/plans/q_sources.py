"""Registered queries: every source pipeline, from landed files to its table.

Each query lands data of the given tables in the shape of one source (pages,
sheets, messages), in a fresh folder of the shared area, and reads it through
that source's normaliser. The first 16 nations stand for the 16 groups; the
others are names that a source holds and no group has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelsmith.functions.columns import round_doubles
from panelsmith.operators import sketches as SK
from panelsmith.operators.revisions import apply_vintage
from panelsmith.plans import inputs as I
from panelsmith.plans.inputs import R4
from panelsmith.plans.registry import query
from panelsmith.session import Tables, cut_lineage, shared_dir
from panelsmith.sources import dims, landed
from panelsmith.sources import normalise as N
from panelsmith.sources.coverage import page_coverage

NAMES = [(i, c, iso) for i, (c, iso) in enumerate(dims.COUNTRIES)]
BASE_SQL = f"""
WITH names(nation, country, iso3) AS (VALUES {", ".join(str(n) for n in NAMES)}),
daily AS (
  SELECT c.c_nationkey AS nation, CAST(o.o_orderdate AS DATE) AS day, avg(o.o_totalprice) AS price, count(*) AS n
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
monthly AS (
  SELECT nation, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(sum(n) AS BIGINT) AS n, max(price) AS price
  FROM daily GROUP BY ALL)
"""


def _folder(spark) -> str:
    return shared_dir(spark, "landing", uuid.uuid4().hex)


def _named(spark, df):
    """``df`` with the country and code of its nation; unknown ones are X<key>."""
    names = F.broadcast(spark.createDataFrame(NAMES, "nation long, country string, iso3 string"))  # 16 rows
    other = F.concat(F.lit("X"), F.col("nation").cast("string"))
    return df.join(names, "nation", "left").withColumns({"country": F.coalesce("country", other), "iso3": F.coalesce("iso3", other)})


def _monthly(t: Tables):
    """(nation, first, year, month, n, price)."""
    d = I.order_days(t).withColumn("first", F.trunc("day", "month"))
    m = d.groupBy("nation", "first").agg(F.sum("n_orders").alias("n"), F.max("price").alias("price"))
    return m.withColumns({"year": F.year("first"), "month": F.month("first")})


@query(
    "src_inferred",
    """
SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS cust_code, CAST(o_orderdate AS DATE) AS o_day,
       round(o_totalprice, 4) AS o_totalprice, o_totalprice > 100000 AS is_large, o_orderpriority,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS some_custkey
FROM orders
""",
)
def src_inferred(spark, sf_dir):
    """orders landed as CSV and read with types found over all rows: counts,
    codes with leading zeros, days, prices, flags and a column with gaps."""
    root = _folder(spark)
    orders = Tables(spark, sf_dir).orders.select(
        "o_orderkey",
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("cust_code"),
        F.to_date("o_orderdate").alias("o_day"),
        "o_totalprice",
        (F.col("o_totalprice") > 100000).alias("is_large"),
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("some_custkey"),
    )
    landed.write_csv(orders, root)
    return round_doubles(landed.read_inferred_csv(spark, root), 4)


@query(
    "src_rates",
    BASE_SQL
    + """
SELECT d.day AS date, a.country, CAST(m.n AS DOUBLE) AS interest_rate,
       round(CASE WHEN d.nation % 2 = 1 THEN 1000000 / d.price ELSE d.price / 1000000 END, 4) AS fx_rate
FROM daily d JOIN names a USING (nation) JOIN monthly m ON m.nation = d.nation AND m.year = year(d.day) AND m.month = month(d.day)
WHERE day(d.day) % 7 <> 0 AND d.day >= DATE '1996-01-01'
""",
)
def src_rates(spark, sf_dir):
    """Observation pages of a monthly rate and a daily FX series per nation, one
    page per series and year; days of a week's multiple are revised to missing."""
    t, root = Tables(spark, sf_dir), _folder(spark)
    fx = I.order_days(t).select(
        F.concat(F.lit("FX"), "nation").alias("series_id"), F.col("day").alias("date"), (F.col("price") / 1e6).cast("string").alias("value")
    )
    first = F.struct(F.date_add("date", 1).cast("string").alias("realtime_start"), "value")
    later = F.struct(F.date_add("date", 30).cast("string").alias("realtime_start"), F.lit(".").alias("value"))
    revisions = F.when(F.dayofmonth("date") % 7 == 0, F.array(later, first)).otherwise(F.array(first))
    fx = fx.select("series_id", "date", F.inline(revisions))
    rate = _monthly(t).select(
        F.concat(F.lit("IR"), "nation").alias("series_id"), F.col("first").alias("date"),
        F.col("first").cast("string").alias("realtime_start"), F.col("n").cast("string").alias("value"),
    )
    rows = fx.unionByName(rate).groupBy("series_id", F.year("date").alias("year"))
    pages = rows.agg(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), "realtime_start", "value")).alias("observations"))
    pages.drop("year").write.partitionBy("series_id").json(root)
    catalog = spark.createDataFrame(
        [(c, kind, f"{p}{i}", p == "FX" and i % 2 == 1) for i, c, _ in NAMES for kind, p in (("fx_rate", "FX"), ("interest_rate", "IR"))],
        "country string, kind string, series_id string, invert boolean",
    )
    return round_doubles(N.rates_panel(spark, root, catalog, start="1996-01-01", multi_line=False), R4)


# The batches asked for, with a missing half year and a month asked twice.
BATCHES = [
    ("brent_dollars_per_barrel", "1995-01-01", "1996-06-30"),
    ("brent_dollars_per_barrel", "1996-07-01", "1997-12-31"),
    ("brent_dollars_per_barrel", "1997-12-01", "2000-12-31"),
    ("wti_dollars_per_barrel", "1995-01-01", "1996-12-31"),
    ("wti_dollars_per_barrel", "1997-07-01", "1998-06-30"),
]
_BATCH_ROWS = ", ".join(f"('{s}', DATE '{a}', DATE '{b}')" for s, a, b in BATCHES)
OIL_DAYS_SQL = """oil AS (SELECT CAST(o_orderdate AS DATE) AS day, min(o_totalprice) AS brent_dollars_per_barrel, max(o_totalprice) AS wti_dollars_per_barrel
  FROM orders GROUP BY 1)"""


def _price_pages(spark, sf_dir) -> str:
    """Pages of two daily series, one folder per batch of dates and a record
    per month."""
    t, root = Tables(spark, sf_dir), _folder(spark)
    day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    names = [n for n, _ in dims.OIL_SERIES]
    rows = day.select("day", F.inline(F.array(*[F.struct(F.lit(n).alias("series"), F.col(c).alias("value")) for n, c in zip(names, ("lo", "hi"))])))
    batches = F.broadcast(spark.createDataFrame(BATCHES, "series string, start string, end string"))
    met = rows.join(batches, "series").where(F.col("day").between(F.to_date("start"), F.to_date("end")))
    record = F.struct(F.col("day").cast("string").alias("period"), F.col("value").cast("string").alias("value"))
    pages = met.groupBy("series", "start", "end", F.trunc("day", "month")).agg(F.collect_list(record).alias("data"))
    pages.select("series", "start", "end", F.struct("data").alias("response")).write.partitionBy("series", "start", "end").json(root)
    return root


@query(
    "src_prices",
    f"""
WITH {OIL_DAYS_SQL}
SELECT day AS date, round(brent_dollars_per_barrel, 4) AS brent_dollars_per_barrel, round(wti_dollars_per_barrel, 4) AS wti_dollars_per_barrel
FROM oil WHERE day BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' OR day BETWEEN DATE '1997-07-01' AND DATE '1998-06-30'
""",
)
def src_prices(spark, sf_dir):
    """Oil pages in batches, one of which overlaps another and one is missing."""
    return round_doubles(N.price_panel(spark, _price_pages(spark, sf_dir), multi_line=False), R4)


@query(
    "src_page_coverage",
    f"""
WITH {OIL_DAYS_SQL}, batches(series, lo, hi) AS (VALUES {_BATCH_ROWS}),
days AS (SELECT DISTINCT series, CAST(unnest(generate_series(DATE '1995-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) AS day FROM batches),
times AS (SELECT d.series, d.day, count(b.lo) AS n FROM days d LEFT JOIN batches b ON b.series = d.series AND d.day BETWEEN b.lo AND b.hi GROUP BY ALL),
odd AS (SELECT *, CASE WHEN n = 0 THEN 'gap' ELSE 'overlap' END AS finding FROM times WHERE n <> 1),
islands AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY series, finding ORDER BY day) AS INTEGER) AS island FROM odd)
SELECT i.series, finding, min(day) AS first_day, max(day) AS last_day, count(oil.day) AS n_days
FROM islands i LEFT JOIN oil USING (day) GROUP BY i.series, finding, island
""",
)
def src_page_coverage(spark, sf_dir):
    """Gaps and overlaps of the landed oil pages, with the trading days that
    fall into them."""
    root = _price_pages(spark, sf_dir)
    schema = "response struct<data: array<struct<period:string, value:string>>>, series string, start date, end date"
    raw = N.read_json_pages(spark, root, schema, multi_line=False)
    last = F.to_date(F.array_max("response.data.period"))
    pages = raw.groupBy("series", "start", "end").agg(F.sum(F.size("response.data")).alias("n_rows"), F.max(last).alias("last_day"))
    expected = spark.createDataFrame([(n,) for n, _ in dims.OIL_SERIES], "series string").withColumns(
        {"lo": F.lit("1995-01-01").cast("date"), "hi": F.lit("2000-12-31").cast("date")}
    )
    found = page_coverage(pages, expected)
    days = Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    # a finding is a few rows; its days are met by equality
    each = found.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).join(days.withColumn("traded", F.lit(1)), "day", "left")
    return each.groupBy("series", "finding", "first_day", "last_day").agg(F.count("traded").alias("n_days"))


@query(
    "src_reserves",
    BASE_SQL + "SELECT a.country, m.year, m.month, round(m.price, 4) AS fx_reserves FROM monthly m LEFT JOIN names a USING (nation)",
)
def src_reserves(spark, sf_dir):
    """Reserve pages in two units, one record per nation and year."""
    root = _folder(spark)
    m = _named(spark, _monthly(Tables(spark, sf_dir)))
    unit = F.explode(F.array(F.lit("USD"), F.lit("EUR"))).alias("UNIT_MEASURE")
    rows = m.select(
        "iso3", "year", F.col("price").cast("string").alias("OBS_VALUE"), F.col("iso3").alias("REF_AREA"),
        F.date_format("first", "yyyy-'M'MM").alias("TIME_PERIOD"), unit,
    )
    record = F.struct("OBS_VALUE", "REF_AREA", "TIME_PERIOD", "UNIT_MEASURE")
    rows.groupBy("iso3", "year").agg(F.collect_list(record).alias("value")).select("value").write.json(root)
    return round_doubles(N.reserves(spark, root, multi_line=False), R4)


@query(
    "src_events",
    BASE_SQL + "SELECT a.country, m.month, m.year, CAST(m.n AS INTEGER) AS events FROM monthly m JOIN names a USING (nation) WHERE m.year >= 1996",
)
def src_events(spark, sf_dir):
    """An event sheet with month names and free country spellings."""
    root = _folder(spark)
    m = _named(spark, _monthly(Tables(spark, sf_dir)))
    shown = F.concat(F.lit(" "), F.initcap(F.regexp_replace("country", "_", " ")), F.lit(" "))
    sheet = m.select(shown.alias("Country"), F.date_format("first", "MMMM").alias("Month"), F.col("year").alias("Year"), F.col("n").alias("Events"))
    sheet.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return N.event_counts(spark, root, start_year=1996)


@query(
    "src_wide_sheet",
    BASE_SQL
    + """
SELECT a.country, p.year, p.month, round(m.price, 4) AS gpr_index
FROM (SELECT DISTINCT year, month FROM monthly) p CROSS JOIN names a LEFT JOIN monthly m ON m.nation = a.nation AND m.year = p.year AND m.month = p.month
WHERE p.year >= 1996
""",
)
def src_wide_sheet(spark, sf_dir):
    """A wide sheet whose country columns the reader does not know."""
    root = _folder(spark)
    m = _named(spark, _monthly(Tables(spark, sf_dir)))
    own = [F.max(F.when(F.col("iso3") == iso, F.col("price"))).alias(f"GPRC_{iso}") for iso in [n[2] for n in NAMES] + ["X16", "X17"]]
    sheet = m.groupBy(F.col("first").alias("month")).agg(*own, F.sum("n").alias("GPR"))
    sheet.write.option("ignoreNullFields", False).json(root)
    return round_doubles(N.open_wide_index(spark, root, start="1996-01-01"), R4)


@query(
    "src_sdmx_xml",
    BASE_SQL + "SELECT a.country, round(m.price, 4) AS value, m.year, m.month FROM monthly m LEFT JOIN names a USING (nation)",
)
def src_sdmx_xml(spark, sf_dir):
    """SDMX messages in XML: a series per nation and year with nested observations."""
    root = _folder(spark)
    m = _named(spark, _monthly(Tables(spark, sf_dir)))
    obs = F.struct(F.date_format("first", "yyyy-'M'MM").alias("_TIME_PERIOD"), F.col("price").alias("_OBS_VALUE"))
    series = m.groupBy(F.col("iso3").alias("_COUNTRY"), "year").agg(F.collect_list(obs).alias("Obs")).drop("year")
    series.write.format("xml").option("rootTag", "DataSet").option("rowTag", "Series").save(root)
    return round_doubles(N.period_message(spark, root), R4)


@query(
    "src_shipping",
    BASE_SQL + "SELECT a.country, m.year, m.month, round(m.price, 4) AS lsci FROM monthly m JOIN names a USING (nation)",
)
def src_shipping(spark, sf_dir):
    """A gzip export with month labels such as 'feb. 1996'."""
    root = _folder(spark)
    m = _named(spark, _monthly(Tables(spark, sf_dir)))
    label = F.concat(F.lower(F.date_format("first", "MMM")), F.lit(". "), F.col("year").cast("string"))
    sheet = m.select(F.initcap(F.regexp_replace("country", "_", " ")).alias("Economy_Label"), label.alias("Month_Label"), F.col("price").alias("Index_Value"))
    sheet.write.option("header", True).option("compression", "gzip").csv(root)
    return round_doubles(N.shipping_index(spark, root, "Index_Value"), R4)


@query(
    "src_patch",
    BASE_SQL
    + """
SELECT 'australia' AS country, year, month, round(price, 4) AS patch_cpi FROM monthly WHERE nation = 0 AND month % 3 = 0
""",
)
def src_patch(spark, sf_dir):
    """Quarterly values with labels such as 'Mar 1996'."""
    root = _folder(spark)
    m = _monthly(Tables(spark, sf_dir)).where("nation = 0 AND month % 3 = 0")
    m.select(F.date_format("first", "MMM yyyy").alias("date"), F.col("price").alias("cpi_index")).write.option("header", True).csv(root)
    return round_doubles(N.quarterly_patch(spark, root, "australia"), R4)


@query(
    "revision_increment",
    """
SELECT o_custkey, arg_max(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS o_orderkey,
       round(arg_max(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)), 4) AS o_totalprice
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01' OR o_custkey % 16 < 4 GROUP BY o_custkey
""",
)
def revision_increment(spark, sf_dir):
    """Each customer's last order, kept as state: the orders up to 1995, then a
    vintage that revises a quarter of the partitions."""
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    o = o.withColumn("slice", (F.col("o_custkey") % 16).cast("int"))
    state = _folder(spark)
    old = F.col("day") < F.lit("1996-01-01").cast("date")
    for batch in (o.where(old), o.where(~old & (F.col("slice") < 4))):
        apply_vintage(state, batch, ["o_custkey"], ["day", "o_orderkey"], "slice")
    return round_doubles(spark.read.parquet(state).select("o_custkey", "o_orderkey", "o_totalprice"), R4)


_ORDER_COLS = ("o_totalprice", "o_custkey")


@query(
    "sketch_fences",
    "WITH q AS ("
    + " UNION ALL ".join(
        f"""SELECT o_orderpriority, year(CAST(o_orderdate AS DATE)) AS year, '{c}' AS col, quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1,
  quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3 FROM orders GROUP BY ALL"""
        for c in _ORDER_COLS
    )
    + """), n AS (SELECT o_orderpriority, year(CAST(o_orderdate AS DATE)) AS year, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderpriority, CAST(year AS INTEGER) AS year, col AS "column", n, true AS within_rank_error FROM q JOIN n USING (o_orderpriority, year)
""",
)
def sketch_fences(spark, sf_dir):
    """Fences of orders per priority and year from sketches of two halves of the
    table, merged; the rows below each quartile are counted and lie within the
    stated rank error of a quarter and of three quarters."""
    o = Tables(spark, sf_dir).orders
    o = o.select("o_orderkey", "o_orderpriority", F.year(F.to_date("o_orderdate")).alias("year"), *_ORDER_COLS)
    by = ["o_orderpriority", "year"]
    stored = None
    for half in (0, 1):
        new = cut_lineage(SK.column_sketches(o.where(F.col("o_orderkey") % 2 == half), _ORDER_COLS, by), "sketches")
        stored = new if stored is None else cut_lineage(SK.merge_sketches(stored, new, by), "sketches")
    f = SK.fences(stored, by)
    long = o.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in _ORDER_COLS])))
    met = long.join(f, [*by, "column"])
    below = [(p, F.count_if(F.col("v") < F.col(q)), F.count_if(F.col("v") <= F.col(q))) for p, q in ((0.25, "q1"), (0.75, "q3"))]
    n = F.count(F.lit(1))
    near = [(lo <= (p + SK.rank_error()) * n) & (hi >= (p - SK.rank_error()) * n) for p, lo, hi in below]
    return met.groupBy(*by, "column").agg(n.alias("n"), (near[0] & near[1]).alias("within_rank_error"))
