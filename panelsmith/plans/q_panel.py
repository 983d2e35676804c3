"""Registered queries: joins, fills, placement, overrides, cutoff, top-k and
the flagship panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelsmith.functions.columns import drop_missing, round_doubles, zero_fill
from panelsmith.operators.fill import forward_fill
from panelsmith.operators.joins import inner_join, left_join, outer_join
from panelsmith.operators.placement import latest_per_key, period_end_place
from panelsmith.plans import inputs as I
from panelsmith.plans.inputs import OIL_SQL, PANEL_SQL, RETURNS_SQL, SPINE_SQL
from panelsmith.plans.panel import index_override
from panelsmith.plans.registry import query
from panelsmith.session import Tables


def _month_bucket():
    return F.trunc("day", "month")


@query(
    "ffill_daily",
    "WITH "
    + SPINE_SQL
    + """
SELECT nation, day, round(price, 4) AS price_obs,
       round(last_value(price IGNORE NULLS) OVER (PARTITION BY nation ORDER BY day), 4) AS price
FROM spine
""",
)
def ffill_daily(spark, sf_dir):
    s = I.spine(Tables(spark, sf_dir)).withColumn("price_obs", F.col("price"))
    f = forward_fill(s, ["price"], ["nation"], ["day"], strategy="ranged")
    return round_doubles(f.select("nation", "day", "price_obs", "price"), I.R4)


@query(
    "ffill_period",
    "WITH "
    + SPINE_SQL
    + """,
m AS (SELECT nation, year, month, avg(price) AS mprice FROM spine GROUP BY ALL),
pv AS (
  SELECT s.nation, s.day, s.year, s.month, CASE WHEN s.price IS NOT NULL THEN m.mprice END AS v
  FROM spine s JOIN m ON s.nation = m.nation AND s.year = m.year AND s.month = m.month)
SELECT nation, day, year, month, round(v, 4) AS v_obs,
       round(last_value(v IGNORE NULLS) OVER (PARTITION BY nation ORDER BY year, month), 4) AS v
FROM pv
""",
)
def ffill_period(spark, sf_dir):
    """Fill ordered by (year, month): all days of a month are peers, so a day
    without a value takes the month's value even from a later day."""
    s = I.spine(Tables(spark, sf_dir))
    m = s.groupBy("nation", "year", "month").agg(F.avg("price").alias("mprice"))
    pv = s.join(m, ["nation", "year", "month"]).select(
        "nation", "day", "year", "month", F.when(F.col("price").isNotNull(), F.col("mprice")).alias("v")
    )
    pv = pv.withColumn("v_obs", F.col("v"))
    f = forward_fill(pv, ["v"], ["nation"], ["year", "month"], bucket="year")
    return round_doubles(f.select("nation", "day", "year", "month", "v_obs", "v"), I.R4)


EVENTS_DAILY_SQL = """
WITH d AS (
  SELECT event_type, CAST(ts AS DATE) AS day, CAST(year(ts) AS INTEGER) AS year,
         CAST(month(ts) AS INTEGER) AS month, count(*) AS n_day
  FROM events GROUP BY ALL),
m AS (SELECT event_type, year, month, sum(n_day) AS n_month FROM d GROUP BY ALL)
"""


@query(
    "period_end_place",
    EVENTS_DAILY_SQL
    + """
SELECT d.event_type, d.day, d.n_day,
       CAST(CASE WHEN row_number() OVER (PARTITION BY d.event_type, d.year, d.month ORDER BY d.day DESC) = 1
            THEN m.n_month ELSE 0 END AS BIGINT) AS events
FROM d LEFT JOIN m ON d.event_type = m.event_type AND d.year = m.year AND d.month = m.month
""",
)
def period_end_place_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = t.events.select("event_type", F.to_date("ts").alias("day")).withColumns(
        {"year": F.year("day"), "month": F.month("day")}
    )
    daily = e.groupBy("event_type", "day", "year", "month").agg(F.count("*").alias("n_day"))
    monthly = daily.groupBy("event_type", "year", "month").agg(F.sum("n_day").alias("events"))
    placed = period_end_place(
        left_join(daily, monthly, ["event_type", "year", "month"]), "events", ["event_type"], ["year", "month"], "day"
    )
    return placed.select("event_type", "day", "n_day", F.col("events").cast("bigint").alias("events"))


@query(
    "zero_fill",
    """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
cal AS (
  SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM d GROUP BY user_id)
SELECT cal.user_id, cal.day, coalesce(d.n, 0) AS n_events
FROM cal LEFT JOIN d ON cal.user_id = d.user_id AND cal.day = d.day
""",
)
def zero_fill_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.events.select("user_id", F.to_date("ts").alias("day")).groupBy("user_id", "day").agg(
        F.count("*").alias("n_events")
    )
    cal = I.calendar(d, "user_id")
    return zero_fill(left_join(cal, d, ["user_id", "day"]), ["n_events"]).select("user_id", "day", "n_events")


@query(
    "join_left_date",
    "WITH "
    + SPINE_SQL
    + ","
    + OIL_SQL
    + """
SELECT s.nation, s.day, round(s.price, 4) AS price, round(oil.oil, 4) AS oil
FROM spine s LEFT JOIN oil ON s.day = oil.day
""",
)
def join_left_date(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = left_join(I.spine(t), I.oil_series(t), ["day"])
    return round_doubles(j.select("nation", "day", "price", "oil"), I.R4)


@query(
    "join_left_period",
    "WITH "
    + SPINE_SQL
    + ","
    + RETURNS_SQL
    + """
SELECT s.nation, s.day, s.year, s.month, round(s.price, 4) AS price, r.events
FROM spine s LEFT JOIN rets r ON s.nation = r.nation AND s.year = r.year AND s.month = r.month
""",
)
def join_left_period(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = left_join(I.spine(t), I.supplier_returns(t), ["nation", "year", "month"])
    return round_doubles(j.select("nation", "day", "year", "month", "price", "events"), I.R4)


@query(
    "join_inner_series",
    """
WITH u AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS urgent
           FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
h AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS high
      FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1)
SELECT u.day, round(u.urgent, 4) AS urgent, round(h.high, 4) AS high FROM u JOIN h ON u.day = h.day
""",
)
def join_inner_series(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", "o_totalprice", F.to_date("o_orderdate").alias("day"))

    def series(prio, name):
        return o.where(F.col("o_orderpriority") == prio).groupBy("day").agg(F.avg("o_totalprice").alias(name))

    j = inner_join(series("1-URGENT", "urgent"), series("2-HIGH", "high"), ["day"])
    return round_doubles(j, I.R4)


def _outer(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return outer_join(I.daily_fx(t), I.monthly_rates(t), ["nation", "yyyymm"]).select(
        "nation", "yyyymm", "day", "fx_rate", "interest_rate"
    )


_OUTER_SQL = (
    PANEL_SQL
    + """,
oj AS (
  SELECT coalesce(fx.nation, rates.nation) AS nation, coalesce(fx.yyyymm, rates.yyyymm) AS yyyymm,
         fx.day, round(fx.fx_rate, 4) AS fx_rate, round(rates.interest_rate, 4) AS interest_rate
  FROM fx FULL OUTER JOIN rates ON fx.nation = rates.nation AND fx.yyyymm = rates.yyyymm)
"""
)


@query("join_outer_period", _OUTER_SQL + "SELECT * FROM oj")
def join_outer_period(spark, sf_dir):
    return round_doubles(_outer(spark, sf_dir), I.R4)


@query(
    "drop_missing",
    _OUTER_SQL
    + """
SELECT * FROM oj
WHERE nation IS NOT NULL AND yyyymm IS NOT NULL AND day IS NOT NULL
  AND fx_rate IS NOT NULL AND interest_rate IS NOT NULL
""",
)
def drop_missing_q(spark, sf_dir):
    return round_doubles(drop_missing(_outer(spark, sf_dir)), I.R4)


def _override(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spec = I.panel_spec()
    b = I.rates_base(t).withColumns({"year": F.year("day"), "month": F.month("day")})
    p = left_join(b, I.unit_price_index(t), ["year", "month", "nation"])
    p = left_join(p, I.index_patch(t), ["nation", "year", "month"])
    p = p.withColumn("cpi", index_override(spec)).drop("patch_cpi")
    p = forward_fill(p, ["cpi"], ["nation"], ["year", "month"], bucket="year")
    return round_doubles(p.select("nation", "day", "year", "month", "cpi"), I.R4)


_OVERRIDE_SQL = (
    PANEL_SQL
    + """,
oc AS (
  SELECT b.nation, b.day, CAST(year(b.day) AS INTEGER) AS year, CAST(month(b.day) AS INTEGER) AS month,
         CASE WHEN b.nation = 0 AND year(b.day) = 1995 AND month(b.day) IN (3, 4, 5) THEN 100.0
              WHEN b.nation = 0 AND c.cpi IS NULL THEN pt.patch_cpi
              ELSE c.cpi END AS cpi0
  FROM base b
  LEFT JOIN cpi c ON b.nation = c.nation AND year(b.day) = c.year AND month(b.day) = c.month
  LEFT JOIN patch pt ON b.nation = pt.nation AND year(b.day) = pt.year AND month(b.day) = pt.month),
ocf AS (
  SELECT nation, day, year, month,
         round(last_value(cpi0 IGNORE NULLS) OVER (PARTITION BY nation ORDER BY year, month), 4) AS cpi
  FROM oc)
"""
)


@query("override_chain", _OVERRIDE_SQL + "SELECT * FROM ocf")
def override_chain_q(spark, sf_dir):
    return _override(spark, sf_dir)


@query("cutoff_after_fill", _OVERRIDE_SQL + "SELECT * FROM ocf WHERE day > DATE '1995-04-30'")
def cutoff_after_fill(spark, sf_dir):
    """The cutoff is applied after the fill, so values before it still seed
    the first kept rows (the filter stays above the window in the plan)."""
    return _override(spark, sf_dir).where(F.col("day") > F.lit("1995-04-30").cast("date"))


@query(
    "latest_revision",
    """
SELECT o_custkey, year, month, o_orderkey, day, round(o_totalprice, 4) AS o_totalprice FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate), month(o_orderdate)
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
WHERE rn = 1
""",
)
def latest_revision(spark, sf_dir):
    """Latest order per (customer, month); ties on the date go to the larger key."""
    o = Tables(spark, sf_dir).orders.select(
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        "o_totalprice",
    )
    out = latest_per_key(o, ["o_custkey", "year", "month"], ["day"], ["o_orderkey"])
    return round_doubles(out, I.R4)


@query(
    "topk_recent",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, round(o_totalprice, 4) AS o_totalprice
FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20
""",
)
def topk_recent(spark, sf_dir):
    """Top 20 most recent orders (a unique last sort key makes it exact)."""
    o = Tables(spark, sf_dir).orders
    top = o.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20)
    return round_doubles(
        top.select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"), I.R4
    )


@query(
    "panel",
    PANEL_SQL
    + """
SELECT year, month, nation, day, round(interest_rate, 4) AS interest_rate, round(fx_rate, 4) AS fx_rate,
       round(brent, 4) AS brent, round(wti, 4) AS wti, events, round(cpi, 4) AS cpi,
       round(gpr_index, 4) AS gpr_index, round(lsci, 4) AS lsci, round(reserves, 4) AS reserves
FROM panel
""",
)
def panel(spark, sf_dir):
    """Flagship: the full panel assembly on the test tables."""
    return round_doubles(I.build_test_panel(Tables(spark, sf_dir)), I.R4)


@query(
    "latest_revision_masked",
    f"""
WITH e AS (
  SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id,
         CASE WHEN {I.md5_sql('event_id', 10)} = 0 THEN '.' ELSE CAST(value AS VARCHAR) END AS raw
  FROM events),
r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS rn FROM e)
SELECT user_id, day, event_id, raw, round(TRY_CAST(raw AS DOUBLE), 4) AS value FROM r WHERE rn = 1
""",
)
def latest_revision_masked(spark, sf_dir):
    """Latest event per (user, day) whose value text may be '.': the latest
    row wins even then, and its value stays missing (no fall-back to an
    earlier row), as for a series revision that is not a number."""
    from panelsmith.functions.hashing import md5_bucket

    e = Tables(spark, sf_dir).events.select(
        "user_id",
        F.to_date("ts").alias("day"),
        "ts",
        "event_id",
        F.when(md5_bucket("event_id", 10) == 0, F.lit(".")).otherwise(F.col("value").cast("string")).alias("raw"),
    )
    latest = latest_per_key(e, ["user_id", "day"], ["ts"], ["event_id"])
    return round_doubles(
        latest.select("user_id", "day", "event_id", "raw", F.col("raw").try_cast("double").alias("value")), I.R4
    )
