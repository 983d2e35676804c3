"""Registered queries: pivot, melt, one-hot encoding, aligned concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelsmith.functions.columns import norm_string, round_doubles
from panelsmith.functions.hashing import md5_bucket
from panelsmith.operators.reshape import (
    calendar_one_hot,
    concat_align,
    melt,
    one_hot_decode,
    pivot_wide,
)
from panelsmith.plans.inputs import R4
from panelsmith.plans.registry import query
from panelsmith.session import Tables

# The five region names of the region table, normalised.
REGIONS = ["africa", "america", "asia", "europe", "middle_east"]
REGION_KEYS = [0, 1, 2, 3, 4]


def _orders_by_region(t: Tables):
    """(year, month, region, r_regionkey, o_totalprice). nation and region are
    fixed-size dimensions (25 and 5 rows at any scale) and are broadcast."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = F.broadcast(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")))
    r = F.broadcast(t.region.select("r_regionkey", norm_string("r_name").alias("region")))
    return (
        o.join(c, "o_custkey")
        .join(n, "n_nationkey")
        .join(r, "r_regionkey")
        .select(
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            "region",
            "r_regionkey",
            "o_totalprice",
        )
    )


_ORB_SQL = """
WITH orb AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
         regexp_replace(lower(trim(r.r_name)), '\\s+', '_', 'g') AS region, r.r_regionkey, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


@query(
    "pivot_period",
    _ORB_SQL
    + "SELECT year, month, "
    + ", ".join(f"round(max(o_totalprice) FILTER (WHERE region = '{r}'), 4) AS {r}" for r in REGIONS)
    + " FROM orb GROUP BY year, month",
)
def pivot_period(spark, sf_dir):
    """(year, month) x region, max order price; explicit region list."""
    rows = _orders_by_region(Tables(spark, sf_dir))
    return round_doubles(pivot_wide(rows, ["year", "month"], "region", REGIONS, "o_totalprice", "max"), R4)


def _masked_cell(k: int):
    key = F.concat_ws("|", F.col("year").cast("string"), F.col("month").cast("string"), F.lit(str(k)))
    return F.when(md5_bucket(key, 10) != 0, F.col(f"price_{k}"))


def _mask_sql(k: int) -> str:
    key = f"CAST(year AS VARCHAR) || '|' || CAST(month AS VARCHAR) || '|{k}'"
    return (
        f"CASE WHEN CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 10 AS INTEGER) <> 0 "
        f"THEN price_{k} END AS price_{k}"
    )


@query(
    "melt_wide",
    _ORB_SQL
    + ", wide0 AS (SELECT year, month, "
    + ", ".join(f"max(o_totalprice) FILTER (WHERE r_regionkey = {k}) AS price_{k}" for k in REGION_KEYS)
    + " FROM orb GROUP BY year, month), wide AS (SELECT year, month, "
    + ", ".join(_mask_sql(k) for k in REGION_KEYS)
    + """ FROM wide0),
long AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (value FOR series IN ("""
    + ", ".join(f"price_{k}" for k in REGION_KEYS)
    + """)))
SELECT year, month, series, CAST(split_part(series, '_', 2) AS INTEGER) AS region_key, round(value, 4) AS value
FROM long
""",
)
def melt_wide(spark, sf_dir):
    """Wide (year, month, price_<region key>) with masked cells, melted to
    long form keeping the NULL cells; the key is split off the column name."""
    rows = _orders_by_region(Tables(spark, sf_dir))
    wide = pivot_wide(
        rows, ["year", "month"], "r_regionkey", REGION_KEYS, "o_totalprice", "max",
        names=[f"price_{k}" for k in REGION_KEYS],
    )
    wide = wide.withColumns({f"price_{k}": _masked_cell(k) for k in REGION_KEYS})
    long = melt(wide, ["year", "month"], [f"price_{k}" for k in REGION_KEYS], "series", "value")
    long = long.withColumn("region_key", F.get(F.split("series", "_"), 1).cast("int"))
    return round_doubles(long.select("year", "month", "series", "region_key", "value"), R4)


_ONE_HOT_SQL = (
    "SELECT event_id, "
    + ", ".join(f"CASE WHEN month(ts) = {i} THEN 1 ELSE 0 END AS month_{i}" for i in range(1, 13))
    + ", "
    + ", ".join(f"CASE WHEN dayofweek(ts) + 1 = {i} THEN 1 ELSE 0 END AS dow_{i}" for i in range(1, 8))
    + " FROM events"
)


@query("one_hot", _ONE_HOT_SQL)
def one_hot_q(spark, sf_dir):
    """Month 1..12 and day of week 1..7 (1 = Sunday) as 0/1 columns."""
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    return calendar_one_hot(e, "ts").drop("ts")


@query(
    "one_hot_decode",
    "SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow FROM events",
)
def one_hot_decode_q(spark, sf_dir):
    """Encode, then decode back to month and day of week."""
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    enc = calendar_one_hot(e, "ts").drop("ts")
    dec = one_hot_decode(enc, "month", list(range(1, 13)), "month")
    return one_hot_decode(dec, "dow", list(range(1, 8)), "dow")


@query(
    "concat_align",
    """
SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS day, round(o_totalprice, 4) AS o_totalprice,
       CAST(NULL AS DOUBLE) AS l_extendedprice
FROM orders
UNION ALL
SELECT l_orderkey, CAST(l_shipdate AS DATE), CAST(NULL AS DOUBLE), round(l_extendedprice, 4)
FROM lineitem
""",
)
def concat_align_q(spark, sf_dir):
    """Two frames with different value columns, unioned by name."""
    t = Tables(spark, sf_dir)
    a = t.orders.select(F.col("o_orderkey").alias("order_key"), F.to_date("o_orderdate").alias("day"), "o_totalprice")
    b = t.lineitem.select(F.col("l_orderkey").alias("order_key"), F.to_date("l_shipdate").alias("day"), "l_extendedprice")
    return round_doubles(concat_align([a, b]), R4)
