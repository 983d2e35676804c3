"""Panel-shaped inputs derived from the driver tables.

The reference works on (country, date) series; on the test tables the group
is the nation and the daily series comes from orders. Every input here is a
Spark plan over the full tables, so its size grows with them.

``spine``: for each nation, one row per day from its first to its last order
day (a per-group calendar exploded from the group's own bounds; no cross join),
left-joined to the nation's daily average order price. Days without orders
have a NULL price, which is what the fills have to deal with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.functions.hashing import md5_bucket
from panelsmith.session import Tables

R4 = 4  # digits kept on doubles in compared results


def _materialized(t: Tables, key: str, build) -> DataFrame:
    """Build a small shared aggregate once per ``Tables`` handle and cut its
    lineage with a reliable checkpoint in the shared checkpoint dir: later
    plans read it instead of repeating the scan + aggregation, and a lost
    executor does not replay the raw-table scan."""
    cached = t.__dict__.get(key)
    if cached is None:
        from panelsmith.session import cut_lineage

        cached = cut_lineage(build(t))
        t.__dict__[key] = cached
    return cached


def order_days(t: Tables) -> DataFrame:
    """(nation, day, price, n_orders), materialized once per handle."""
    return _materialized(t, "_order_days", _order_days_plan)


def _order_days_plan(t: Tables) -> DataFrame:
    """(nation, day, price, n_orders): daily average order price and order
    count per customer nation."""
    o = t.orders.select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return o.join(c, "o_custkey").groupBy("nation", "day").agg(
        F.avg("o_totalprice").alias("price"), F.count("*").alias("n_orders")
    )


def calendar(daily: DataFrame, by: str, day: str = "day") -> DataFrame:
    """(by, day) for every day between each group's first and last day."""
    bounds = daily.groupBy(by).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    return bounds.select(by, F.explode(F.sequence("__lo", "__hi", F.expr("INTERVAL 1 DAY"))).alias(day))


def spine(t: Tables) -> DataFrame:
    """(nation, day, year, month, price)."""
    daily = order_days(t)
    cal = calendar(daily, "nation")
    return cal.join(daily, ["nation", "day"], "left").withColumns(
        {"year": F.year("day"), "month": F.month("day")}
    ).select("nation", "day", "year", "month", "price")


SPINE_SQL = """
daily AS (
  SELECT c.c_nationkey AS nation, CAST(o.o_orderdate AS DATE) AS day, avg(o.o_totalprice) AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2),
cal AS (
  SELECT nation, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily GROUP BY nation),
spine AS (
  SELECT cal.nation, cal.day, CAST(year(cal.day) AS INTEGER) AS year,
         CAST(month(cal.day) AS INTEGER) AS month, daily.price
  FROM cal LEFT JOIN daily ON cal.nation = daily.nation AND cal.day = daily.day)
"""


def md5_sql(expr: str, modulo: int, purpose: str = "", seed: int = 2026) -> str:
    """DuckDB form of ``md5_bucket`` for a single key expression."""
    salt = f"'{purpose}:{seed}:' || " if purpose else ""
    return f"CAST(CAST('0x' || substr(md5({salt}CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT) % {modulo} AS INTEGER)"


def oil_series(t: Tables) -> DataFrame:
    """Global daily series with gaps: average ship-day line price; the value
    of days whose md5 bucket is 0 (of 10) is missing, as on non-trading days.
    Every day is kept; only the value is masked."""
    li = t.lineitem.select(F.to_date("l_shipdate").alias("day"), "l_extendedprice")
    daily = li.groupBy("day").agg(F.avg("l_extendedprice").alias("oil"))
    return daily.withColumn("oil", F.when(md5_bucket(F.col("day"), 10) != 0, F.col("oil")))


OIL_SQL = f"""
oil AS (
  SELECT CAST(l_shipdate AS DATE) AS day,
         CASE WHEN {md5_sql('CAST(l_shipdate AS DATE)', 10)} <> 0 THEN avg(l_extendedprice) END AS oil
  FROM lineitem GROUP BY 1)
"""


def supplier_returns(t: Tables) -> DataFrame:
    """(nation, year, month, events): monthly count of returned lines
    (l_returnflag = 'R') per supplier nation."""
    li = t.lineitem.where(F.col("l_returnflag") == "R").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    )
    # count per (supplier, month) before the join: the join sees suppliers x
    # months rows, not every returned line
    per_supp = li.groupBy("l_suppkey", "year", "month").agg(F.count("*").alias("n"))
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    return per_supp.join(s, "l_suppkey").groupBy("nation", "year", "month").agg(
        F.sum("n").cast("int").alias("events")
    )


RETURNS_SQL = """
rets AS (
  SELECT s.s_nationkey AS nation, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(month(l.l_shipdate) AS INTEGER) AS month, CAST(count(*) AS INTEGER) AS events
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_returnflag = 'R'
  GROUP BY 1, 2, 3)
"""


# ------------------------------------------------------------ panel sources
#
# The flagship panel on the test tables: group = customer / supplier nation.
#   base      daily order price (fx_rate) x monthly line discount (interest_rate),
#             full outer on (nation, yyyymm), rows with a gap dropped
#   prices    two global daily series from lineitem (brent, wti), each with
#             md5-masked values on some days, inner-joined on the day
#   events    monthly returned lines per supplier nation
#   cpi       quarter-month unit price per supplier nation; nation 0's source
#             starts in 1997 and a quarterly patch series ('Mmm yyyy' labels)
#             covers it
#   gpr       monthly order count per customer nation / 10
#   lsci      monthly discount index on months 2, 5, 8, 11
#   reserves  monthly line price per supplier nation up to 2000-12 (the tail
#             after that is missing and is what imputation fills)

LSCI_MONTHLY_NATIONS = (3, 7, 11, 19)


def panel_spec():
    from panelsmith.plans.panel import PanelSpec

    return PanelSpec(
        group="nation",
        date="day",
        price_cols=["brent", "wti"],
        target_col="reserves",
        override_group=0,
        override_year=1995,
        override_months=(3, 4, 5),
        override_value=100.0,
        lsci_first_year=1995,
        lsci_first_month=2,
        lsci_monthly_groups=LSCI_MONTHLY_NATIONS,
        lsci_monthly_to=3,
        lsci_others_to=4,
        cutoff="1995-04-30",
    )


def _supplier_month_sums(t: Tables) -> DataFrame:
    """lineitem pre-aggregated by (supplier, year, month) BEFORE the join with
    supplier: sums and counts are mergeable, so the join sees suppliers x
    months rows instead of every line, and a hot supplier is combined map-side."""
    li = t.lineitem.select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        "l_discount",
        F.try_divide("l_extendedprice", "l_quantity").alias("unit"),
        "l_extendedprice",
        "l_returnflag",
    )
    return li.groupBy("l_suppkey", "year", "month").agg(
        F.sum("l_discount").alias("s_disc"),
        F.count("l_discount").alias("n_disc"),
        F.sum("unit").alias("s_unit"),
        F.count("unit").alias("n_unit"),
        F.sum("l_extendedprice").alias("s_price"),
        F.count("l_extendedprice").alias("n_price"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
    )


def supplier_monthly(t: Tables) -> DataFrame:
    """Every monthly per-supplier-nation measure the panel needs, from ONE
    scan of lineitem, materialized once (nations x months rows); the period
    sources below are projections and filters of it."""
    return _materialized(t, "_supplier_monthly", _supplier_monthly_plan)


def _supplier_monthly_plan(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    sums = _supplier_month_sums(t).join(s, "l_suppkey")
    m = F.col("month")
    return sums.groupBy("nation", "year", "month").agg(
        (F.try_divide(F.sum("s_disc"), F.sum("n_disc")) * 100).alias("interest_rate"),
        F.try_divide(F.sum("s_unit"), F.sum("n_unit")).alias("unit_price"),
        F.try_divide(F.sum("s_price"), F.sum("n_price")).alias("line_price"),
        F.sum("n_ret").cast("int").alias("returns"),
    ).withColumn("is_quarter_month", m.isin(3, 6, 9, 12))


def monthly_rates(t: Tables) -> DataFrame:
    """(nation, yyyymm, interest_rate)."""
    from panelsmith.functions.dates import yyyymm

    return supplier_monthly(t).select("nation", yyyymm("year", "month").alias("yyyymm"), "interest_rate")


def daily_fx(t: Tables) -> DataFrame:
    """(nation, yyyymm, day, fx_rate)."""
    return order_days(t).select(
        "nation", F.date_format("day", "yyyyMM").alias("yyyymm"), "day", F.col("price").alias("fx_rate")
    )


def rates_base(t: Tables) -> DataFrame:
    """Full outer join of the daily and the monthly series, gaps dropped."""
    from panelsmith.operators.joins import outer_join_complete

    return outer_join_complete(daily_fx(t), monthly_rates(t), ["nation", "yyyymm"]).select(
        "nation", "day", "interest_rate", "fx_rate"
    )


def daily_prices(t: Tables) -> DataFrame:
    """(day, brent, wti), materialized once per handle (one row per day)."""
    return _materialized(t, "_daily_prices", _daily_prices_plan)


def _daily_prices_plan(t: Tables) -> DataFrame:
    """(day, brent, wti): two masked global daily series, inner-joined."""
    li = t.lineitem.select(F.to_date("l_shipdate").alias("day"), "l_extendedprice", "l_quantity")
    daily = li.groupBy("day").agg(F.avg("l_extendedprice").alias("brent"), F.avg("l_quantity").alias("wti"))
    b = md5_bucket(F.col("day"), 10)
    # values masked on some days (bucket 0 for one series, 1 for the other);
    # every day is kept
    brent = daily.select("day", F.when(b != 0, F.col("brent")).alias("brent"))
    wti = daily.select("day", F.when(b != 1, F.col("wti")).alias("wti"))
    return brent.join(wti, "day", "inner")


def panel_returns(t: Tables) -> DataFrame:
    """(nation, year, month, events), months with returns only."""
    return supplier_monthly(t).where(F.col("returns") > 0).select(
        "nation", "year", "month", F.col("returns").alias("events")
    )


def unit_price_index(t: Tables) -> DataFrame:
    """(nation, year, month, cpi) on quarter months; nation 0 only from 1997."""
    q = supplier_monthly(t).where(F.col("is_quarter_month"))
    q = q.where(~((F.col("nation") == 0) & (F.col("year") < 1997)))
    return q.select("nation", "year", "month", F.col("unit_price").alias("cpi"))


def index_patch(t: Tables) -> DataFrame:
    """Nation 0's quarterly series as a landed text table ('Mmm yyyy' labels),
    parsed back: year from characters 5-8, month from the quarter label."""
    from panelsmith.functions.dates import quarter_month

    q = supplier_monthly(t).where((F.col("nation") == 0) & F.col("is_quarter_month"))
    landed = q.select(
        F.date_format(F.make_date("year", "month", F.lit(1)), "MMM yyyy").alias("date"),
        F.col("unit_price").alias("cpi_index"),
    )
    return landed.select(
        F.lit(0).alias("nation"),
        F.substring("date", 5, 4).cast("int").alias("year"),
        quarter_month(F.substring("date", 1, 3)).alias("month"),
        F.col("cpi_index").alias("patch_cpi"),
    )


def order_index(t: Tables) -> DataFrame:
    """(nation, year, month, gpr_index): monthly order count / 10, from the
    same daily order aggregate the base uses (one orders scan)."""
    d = order_days(t)
    return d.groupBy("nation", F.year("day").alias("year"), F.month("day").alias("month")).agg(
        (F.sum("n_orders") / 10.0).alias("gpr_index")
    )


def discount_index(t: Tables) -> DataFrame:
    """(nation, year, month, lsci) on months 2, 5, 8, 11."""
    q = supplier_monthly(t).where(F.col("month").isin(2, 5, 8, 11))
    return q.select("nation", "year", "month", F.col("interest_rate").alias("lsci"))


def reserves(t: Tables) -> DataFrame:
    """(nation, year, month, reserves) before 2001."""
    q = supplier_monthly(t).where(F.col("year") < 2001)
    return q.select("nation", "year", "month", F.col("line_price").alias("reserves"))


def panel_inputs(t: Tables) -> dict:
    return dict(
        base=rates_base(t),
        prices=daily_prices(t),
        events=panel_returns(t),
        index=unit_price_index(t),
        patch=index_patch(t),
        gpr=order_index(t),
        lsci=discount_index(t),
        target=reserves(t),
    )


def materialized_panel(t: Tables) -> DataFrame:
    return _materialized(t, "_panel", build_test_panel)


def build_test_panel(t: Tables, fill_strategy: str = "bucketed") -> DataFrame:
    from panelsmith.plans.panel import build_panel

    return build_panel(**panel_inputs(t), spec=panel_spec(), fill_strategy=fill_strategy)


_SL = "lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"
_Y = "CAST(year(l.l_shipdate) AS INTEGER)"
_M = "CAST(month(l.l_shipdate) AS INTEGER)"

PANEL_SRC_SQL = f"""
rates AS (
  SELECT s.s_nationkey AS nation, strftime(l.l_shipdate, '%Y%m') AS yyyymm, avg(l.l_discount) * 100 AS interest_rate
  FROM {_SL} GROUP BY 1, 2),
fx AS (SELECT nation, strftime(day, '%Y%m') AS yyyymm, day, price AS fx_rate FROM daily),
base AS (
  SELECT coalesce(fx.nation, rates.nation) AS nation, fx.day, rates.interest_rate, fx.fx_rate
  FROM fx FULL OUTER JOIN rates ON fx.nation = rates.nation AND fx.yyyymm = rates.yyyymm
  WHERE fx.day IS NOT NULL AND fx.fx_rate IS NOT NULL AND rates.interest_rate IS NOT NULL),
pdaily AS (
  SELECT CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) AS brent, avg(l_quantity) AS wti
  FROM lineitem GROUP BY 1),
prices AS (
  SELECT b.day, b.brent, w.wti
  FROM (SELECT day, CASE WHEN {md5_sql('day', 10)} <> 0 THEN brent END AS brent FROM pdaily) b
  JOIN (SELECT day, CASE WHEN {md5_sql('day', 10)} <> 1 THEN wti END AS wti FROM pdaily) w ON b.day = w.day),
cpi AS (
  SELECT s.s_nationkey AS nation, {_Y} AS year, {_M} AS month,
         avg(l.l_extendedprice / l.l_quantity) AS cpi
  FROM {_SL} WHERE month(l.l_shipdate) IN (3, 6, 9, 12)
  GROUP BY 1, 2, 3 HAVING NOT (s.s_nationkey = 0 AND {_Y} < 1997)),
patch_landed AS (
  SELECT strftime(make_date({_Y}, {_M}, 1), '%b %Y') AS date,
         avg(l.l_extendedprice / l.l_quantity) AS cpi_index
  FROM {_SL} WHERE s.s_nationkey = 0 AND month(l.l_shipdate) IN (3, 6, 9, 12)
  GROUP BY {_Y}, {_M}),
patch AS (
  SELECT 0 AS nation, CAST(substr(date, 5, 4) AS INTEGER) AS year,
         CASE substr(date, 1, 3) WHEN 'Mar' THEN 3 WHEN 'Jun' THEN 6 WHEN 'Sep' THEN 9 WHEN 'Dec' THEN 12 END AS month,
         cpi_index AS patch_cpi
  FROM patch_landed),
gpr AS (
  SELECT c.c_nationkey AS nation, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month, count(*) / 10.0 AS gpr_index
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3),
lsci_raw AS (
  SELECT s.s_nationkey AS nation, {_Y} AS year, {_M} AS month, avg(l.l_discount) * 100 AS lsci
  FROM {_SL} WHERE month(l.l_shipdate) IN (2, 5, 8, 11) GROUP BY 1, 2, 3),
lsci AS (
  SELECT nation, year,
         CASE WHEN year = 1995 AND month = 2 AND nation IN {LSCI_MONTHLY_NATIONS} THEN 3
              WHEN year = 1995 AND month = 2 THEN 4 ELSE month END AS month,
         lsci
  FROM lsci_raw),
reserves AS (
  SELECT s.s_nationkey AS nation, {_Y} AS year, {_M} AS month, avg(l.l_extendedprice) AS reserves
  FROM {_SL} WHERE year(l.l_shipdate) < 2001 GROUP BY 1, 2, 3),
p1 AS (
  SELECT b.nation, b.day, b.interest_rate, b.fx_rate, pr.brent, pr.wti,
         CAST(year(b.day) AS INTEGER) AS year, CAST(month(b.day) AS INTEGER) AS month
  FROM base b LEFT JOIN prices pr ON b.day = pr.day),
p2 AS (
  SELECT nation, day, year, month, interest_rate, fx_rate,
         last_value(brent IGNORE NULLS) OVER (PARTITION BY nation ORDER BY day) AS brent,
         last_value(wti IGNORE NULLS) OVER (PARTITION BY nation ORDER BY day) AS wti
  FROM p1),
p3 AS (
  SELECT p2.*, coalesce(r.events, 0) AS events0
  FROM p2 LEFT JOIN rets r ON p2.nation = r.nation AND p2.year = r.year AND p2.month = r.month),
p4 AS (
  SELECT * EXCLUDE (events0),
         CASE WHEN row_number() OVER (PARTITION BY nation, year, month ORDER BY day DESC) = 1
              THEN events0 ELSE 0 END AS events
  FROM p3),
p5 AS (
  SELECT p4.*,
         CASE WHEN p4.nation = 0 AND p4.year = 1995 AND p4.month IN (3, 4, 5) THEN 100.0
              WHEN p4.nation = 0 AND c.cpi IS NULL THEN pt.patch_cpi
              ELSE c.cpi END AS cpi0,
         g.gpr_index, ls.lsci AS lsci0
  FROM p4
  LEFT JOIN cpi c ON p4.nation = c.nation AND p4.year = c.year AND p4.month = c.month
  LEFT JOIN patch pt ON p4.nation = pt.nation AND p4.year = pt.year AND p4.month = pt.month
  LEFT JOIN gpr g ON p4.nation = g.nation AND p4.year = g.year AND p4.month = g.month
  LEFT JOIN lsci ls ON p4.nation = ls.nation AND p4.year = ls.year AND p4.month = ls.month),
p6 AS (
  SELECT * EXCLUDE (cpi0, lsci0),
         last_value(cpi0 IGNORE NULLS) OVER (PARTITION BY nation ORDER BY year, month) AS cpi,
         last_value(lsci0 IGNORE NULLS) OVER (PARTITION BY nation ORDER BY year, month) AS lsci
  FROM p5),
panel AS (
  SELECT p6.year, p6.month, p6.nation, p6.day, p6.interest_rate, p6.fx_rate, p6.brent, p6.wti,
         p6.events, p6.cpi, p6.gpr_index, p6.lsci, rs.reserves
  FROM p6 LEFT JOIN reserves rs ON p6.nation = rs.nation AND p6.year = rs.year AND p6.month = rs.month
  WHERE p6.day > DATE '1995-04-30')
"""

PANEL_SQL = "WITH " + SPINE_SQL + "," + RETURNS_SQL + "," + PANEL_SRC_SQL
