"""Registered queries: outliers and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelsmith.functions.columns import round_half_up, zero_fill
from panelsmith.operators import outliers as O
from panelsmith.operators import quality as Q
from panelsmith.operators.fill import forward_fill
from panelsmith.plans.inputs import R4, RETURNS_SQL, SPINE_SQL, spine, supplier_returns
from panelsmith.plans.registry import query
from panelsmith.session import Tables


def _events_daily(t: Tables):
    return t.events.select(
        "event_id", "event_type", "user_id", "value", F.to_date("ts").alias("day")
    )


def _round_outliers(df):
    return df.withColumns({c: round_half_up(c, R4) for c in ["outlier_value", "q1", "q3", "iqr"]})


EVENT_Q_SQL = """
WITH q AS (
  SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
  FROM events GROUP BY event_type)
"""


@query(
    "iqr_outliers",
    EVENT_Q_SQL
    + """
SELECT e.event_id, e.event_type, CAST(e.ts AS DATE) AS day, 'value' AS outlier_column,
       round(e.value, 4) AS outlier_value, round(q.q1, 4) AS q1, round(q.q3, 4) AS q3,
       round(q.q3 - q.q1, 4) AS iqr
FROM events e JOIN q USING (event_type)
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)
""",
)
def iqr_outliers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = O.iqr_outliers(
        _events_daily(t), ["value"], ["event_type"], ["event_id", "event_type", "day"], method="exact"
    )
    return _round_outliers(out)


@query(
    "outlier_counts",
    EVENT_Q_SQL
    + """
SELECT e.event_type, count(*) AS n_outliers
FROM events e JOIN q USING (event_type)
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)
GROUP BY e.event_type ORDER BY n_outliers DESC, e.event_type
""",
)
def outlier_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = O.iqr_outliers(_events_daily(t), ["value"], ["event_type"], ["event_id", "event_type"], method="exact")
    return O.outlier_counts(out, ["event_type"])


TWO_COL_SQL = """
WITH e AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, value, value * value AS value_sq FROM events),
q AS (
  SELECT event_type,
         quantile_disc(value, 0.25) AS q1_v, quantile_disc(value, 0.75) AS q3_v,
         quantile_disc(value_sq, 0.25) AS q1_s, quantile_disc(value_sq, 0.75) AS q3_s
  FROM e GROUP BY event_type),
long AS (
  SELECT e.event_id, e.event_type, e.day, 'value' AS outlier_column, e.value AS outlier_value, q1_v AS q1, q3_v AS q3
  FROM e JOIN q USING (event_type)
  UNION ALL
  SELECT e.event_id, e.event_type, e.day, 'value_sq', e.value_sq, q1_s, q3_s
  FROM e JOIN q USING (event_type)),
flagged AS (
  SELECT *, q3 - q1 AS iqr,
         coalesce(outlier_value < q1 - 1.5 * (q3 - q1) OR outlier_value > q3 + 1.5 * (q3 - q1), false) AS is_outlier
  FROM long)
"""


def _two_col_flags(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = _events_daily(t).withColumn("value_sq", F.col("value") * F.col("value"))
    return O.flag_outliers(e, ["value", "value_sq"], ["event_type"], ["event_id", "event_type", "day"], method="exact")


@query(
    "outlier_union",
    TWO_COL_SQL
    + """
SELECT event_id, event_type, day, outlier_column, round(outlier_value, 4) AS outlier_value,
       round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr
FROM flagged WHERE is_outlier
""",
)
def outlier_union(spark, sf_dir):
    f = _two_col_flags(spark, sf_dir)
    return _round_outliers(f.where("is_outlier").select("event_id", "event_type", "day", *O.OUTLIER_COLUMNS))


@query(
    "outlier_summary",
    TWO_COL_SQL
    + """
SELECT outlier_column, CAST(count(*) FILTER (WHERE is_outlier) AS BIGINT) AS n_outliers,
       CAST(count(*) AS BIGINT) AS n_rows,
       round(count(*) FILTER (WHERE is_outlier) * 100.0 / count(*), 4) AS pct_outliers
FROM flagged GROUP BY outlier_column
""",
)
def outlier_summary(spark, sf_dir):
    return O.outlier_summary(_two_col_flags(spark, sf_dir))


@query(
    "outlier_years",
    """
WITH e AS (SELECT event_id, event_type, value, CAST(weekofyear(ts) AS INTEGER) AS week FROM events),
q AS (
  SELECT event_type, week, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
  FROM e GROUP BY event_type, week)
SELECT e.week, count(*) AS n_outliers
FROM e JOIN q USING (event_type, week)
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)
GROUP BY e.week
""",
)
def outlier_years(spark, sf_dir):
    """Outliers per (type, week) partition, counted by week (the data spans
    one month, so week plays the role the year plays in a long history)."""
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", "event_type", "value", F.weekofyear("ts").alias("week"))
    out = O.iqr_outliers(e, ["value"], ["event_type", "week"], ["event_id", "week"], method="exact")
    return out.groupBy("week").agg(F.count("*").alias("n_outliers"))


# ---------------------------------------------------------------- quality


@query(
    "key_uniqueness",
    """
SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n_rows
FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1
""",
)
def key_uniqueness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.key_duplicates(_events_daily(t), ["user_id", "event_type", "day"])


@query(
    "duplicate_rows",
    """
SELECT 'events' AS table_name, count(*) AS n_duplicate_groups FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events GROUP BY ALL HAVING count(*) > 1)
UNION ALL
SELECT 'orders', count(*) FROM (
  SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders GROUP BY ALL HAVING count(*) > 1)
""",
)
def duplicate_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = Q.duplicate_groups(_events_daily(t).select("user_id", "event_type", "day"))
    od = Q.duplicate_groups(t.orders.select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day")))
    return ev.select(F.lit("events").alias("table_name"), "*").unionByName(
        od.select(F.lit("orders").alias("table_name"), "*")
    )


def masked_spine(t: Tables):
    """Spine + monthly supplier-nation returns (NULL where a month has none)."""
    return spine(t).join(supplier_returns(t), ["nation", "year", "month"], "left").select(
        "nation", "day", "year", "month", "price", "events"
    )


MASKED_SQL = (
    "WITH "
    + SPINE_SQL
    + ","
    + RETURNS_SQL
    + """,
masked AS (
  SELECT s.nation, s.day, s.year, s.month, s.price, r.events
  FROM spine s LEFT JOIN rets r ON s.nation = r.nation AND s.year = r.year AND s.month = r.month)
"""
)


@query(
    "missing_profile",
    MASKED_SQL
    + """
SELECT column_name, n_missing FROM (
  SELECT 'nation' AS column_name, CAST(count(*) FILTER (WHERE nation IS NULL) AS BIGINT) AS n_missing FROM masked
  UNION ALL SELECT 'day', count(*) FILTER (WHERE day IS NULL) FROM masked
  UNION ALL SELECT 'year', count(*) FILTER (WHERE year IS NULL) FROM masked
  UNION ALL SELECT 'month', count(*) FILTER (WHERE month IS NULL) FROM masked
  UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL) FROM masked
  UNION ALL SELECT 'events', count(*) FILTER (WHERE events IS NULL) FROM masked)
""",
)
def missing_profile(spark, sf_dir):
    return Q.missing_profile(masked_spine(Tables(spark, sf_dir)))


@query(
    "any_null_rows",
    MASKED_SQL
    + """
SELECT nation, day, year, month, round(price, 4) AS price, events FROM masked
WHERE nation IS NULL OR day IS NULL OR year IS NULL OR month IS NULL OR price IS NULL OR events IS NULL
""",
)
def any_null_rows(spark, sf_dir):
    return Q.rows_with_nulls(masked_spine(Tables(spark, sf_dir))).withColumn("price", round_half_up("price", R4))


@query(
    "null_by_group",
    MASKED_SQL
    + """
SELECT nation, count(*) AS n_null_rows FROM masked
WHERE price IS NULL OR events IS NULL GROUP BY nation
""",
)
def null_by_group(spark, sf_dir):
    return Q.null_rows_by_group(masked_spine(Tables(spark, sf_dir)), ["nation"], ["price", "events"])


@query(
    "panel_profile",
    MASKED_SQL + "SELECT count(*) AS n_rows, 6 AS n_cols FROM masked",
)
def panel_profile(spark, sf_dir):
    return Q.shape(masked_spine(Tables(spark, sf_dir)))


@query(
    "null_before_after",
    MASKED_SQL
    + """,
filled AS (
  SELECT nation, day, year, month,
         last_value(price IGNORE NULLS) OVER (PARTITION BY nation ORDER BY day) AS price,
         coalesce(events, 0) AS events
  FROM masked)
SELECT 'before' AS stage, count(*) AS n_rows,
       count(*) FILTER (WHERE price IS NULL OR events IS NULL) AS n_null_rows FROM masked
UNION ALL
SELECT 'after', count(*), count(*) FILTER (WHERE price IS NULL OR events IS NULL) FROM filled
""",
)
def null_before_after(spark, sf_dir):
    before = masked_spine(Tables(spark, sf_dir))
    after = zero_fill(
        forward_fill(before, ["price"], ["nation"], ["day"], bucket=F.trunc("day", "month")), ["events"]
    )
    return Q.null_row_counts({"before": before, "after": after})


@query(
    "coverage",
    """
SELECT c.c_nationkey AS nation,
       CAST(min(year(o.o_orderdate)) AS INTEGER) AS min_year, CAST(max(year(o.o_orderdate)) AS INTEGER) AS max_year,
       min(CAST(year(o.o_orderdate) AS VARCHAR) || lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0')) AS min_yyyymm,
       max(CAST(year(o.o_orderdate) AS VARCHAR) || lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0')) AS max_yyyymm
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey
""",
)
def coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return Q.coverage(o.join(c, "o_custkey"), ["nation"])


@query(
    "distinct_groups",
    """
SELECT DISTINCT c.c_nationkey AS nation
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""",
)
def distinct_groups(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return Q.distinct_values(t.orders.select("o_custkey").join(c, "o_custkey"), ["nation"])
