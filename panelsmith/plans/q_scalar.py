"""Registered queries: dates and periods, casts, strings, mappings, filters,
JSON and CSV sources, hash splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelsmith.functions import columns as C
from panelsmith.functions import dates as D
from panelsmith.functions.columns import round_doubles
from panelsmith.functions.hashing import fold_of, md5_bucket, split_label
from panelsmith.operators.joins import semi_join
from panelsmith.plans.inputs import R4, md5_sql
from panelsmith.plans.registry import query
from panelsmith.session import Tables
from panelsmith.sources import landed

# ---------------------------------------------------------------- dates


@query(
    "date_bounds",
    """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of,
       last_day(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE)) AS prev_month_end,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before
FROM orders
""",
)
def date_bounds(spark, sf_dir):
    """Both upper-bound rules for every as-of day found in orders."""
    d = Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return d.select("as_of", D.prev_month_end("as_of").alias("prev_month_end"), D.day_before("as_of").alias("day_before"))


@query(
    "date_parts",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS yyyymmdd,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed
FROM orders
""",
)
def date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    o = o.withColumns(
        {"year": F.year("day"), "month": F.month("day"), "dow": F.dayofweek("day"), "yyyymmdd": D.yyyymmdd("day")}
    )
    return o.withColumn("parsed", D.from_yyyymmdd("yyyymmdd"))


_LABEL_KINDS = {"dash": "yyyy-MM", "imf": "yyyy-'M'MM", "compact": "yyyyMMdd"}
_LABEL_SQL = {"dash": "%Y-%m", "imf": "%Y-M%m", "compact": "%Y%m%d"}


@query(
    "period_split",
    "WITH l AS ("
    + " UNION ALL ".join(
        f"SELECT o_orderkey, '{k}' AS kind, strftime(o_orderdate, '{f}') AS label FROM orders"
        for k, f in _LABEL_SQL.items()
    )
    + """)
SELECT o_orderkey, kind, label,
       CAST(CASE WHEN contains(label, '-') THEN split_part(label, '-', 1) ELSE substr(label, 1, 4) END AS INTEGER) AS year,
       CAST(CASE WHEN contains(label, '-') THEN regexp_replace(split_part(label, '-', 2), '^M', '')
                 ELSE substr(label, 5, 2) END AS INTEGER) AS month
FROM l
""",
)
def period_split(spark, sf_dir):
    """Period labels in three landed formats parsed back to (year, month)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    parts = []
    for kind, fmt in _LABEL_KINDS.items():
        lab = o.select("o_orderkey", F.lit(kind).alias("kind"), F.date_format("o_orderdate", fmt).alias("label"))
        y, m = D.period_from_label("label")
        parts.append(lab.withColumns({"year": y, "month": m}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_ABBR_SQL = "[" + ", ".join(f"'{m}'" for m in D.MONTH_ABBR) + "]"


@query(
    "month_label_parse",
    f"""
WITH l AS (
  SELECT DISTINCT lower(strftime(o_orderdate, '%b')) || CASE WHEN month(o_orderdate) = 5 THEN ' ' ELSE '. ' END
         || CAST(year(o_orderdate) AS VARCHAR) AS label
  FROM orders)
SELECT label,
       CAST(list_position({_ABBR_SQL}, regexp_extract(label, '^([a-z]{{3}})[a-z]*\\.? +(\\d{{4}})$', 1)) AS INTEGER) AS month,
       CAST(regexp_extract(label, '^([a-z]{{3}})[a-z]*\\.? +(\\d{{4}})$', 2) AS INTEGER) AS year
FROM l
""",
)
def month_label_parse(spark, sf_dir):
    """'feb. 1995' style labels ('may 1995' has no dot) parsed to (month, year)."""
    o = Tables(spark, sf_dir).orders.select("o_orderdate")
    label = F.concat(
        F.lower(F.date_format("o_orderdate", "MMM")),
        F.when(F.month("o_orderdate") == 5, F.lit(" ")).otherwise(F.lit(". ")),
        F.year("o_orderdate").cast("string"),
    )
    labels = o.select(label.alias("label")).distinct()
    m, y = D.month_label_parts("label")
    return labels.select("label", m.alias("month"), y.alias("year"))


# ---------------------------------------------------------------- casts


def _k_text():
    return F.get_json_object("props", "$.k")


@query(
    "cast_strict",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def cast_strict(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", C.strict_cast(_k_text(), "int").alias("k"))


@query(
    "cast_lenient",
    f"""
WITH r AS (
  SELECT event_id, CASE WHEN {md5_sql('event_id', 10)} = 0 THEN '.' ELSE json_extract_string(props, '$.k') END AS raw
  FROM events)
SELECT event_id, raw, TRY_CAST(raw AS DOUBLE) AS k FROM r
""",
)
def cast_lenient(spark, sf_dir):
    """A '.' placeholder (as in a missing observation) becomes NULL."""
    e = Tables(spark, sf_dir).events
    raw = F.when(md5_bucket("event_id", 10) == 0, F.lit(".")).otherwise(_k_text())
    return e.select("event_id", raw.alias("raw")).withColumn("k", C.lenient_cast("raw", "double"))


def _series_id():
    code = F.upper(F.substring("event_type", 1, 2))
    return F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("DEX"), code, F.lit("US"))).otherwise(
        F.concat(F.lit("DEXUS"), code)
    )


@query(
    "rate_invert",
    """
WITH s AS (
  SELECT event_id, value,
         CASE WHEN event_type IN ('click', 'view') THEN 'DEX' || upper(substr(event_type, 1, 2)) || 'US'
              ELSE 'DEXUS' || upper(substr(event_type, 1, 2)) END AS series_id
  FROM events)
SELECT event_id, series_id,
       round(CASE WHEN substr(series_id, 6) = 'US' THEN (CASE WHEN value = 0 THEN NULL ELSE 1.0 / value END)
                  ELSE value END, 4) AS rate
FROM s
""",
)
def rate_invert(spark, sf_dir):
    """Quotes whose series id ends in 'US' (from the 6th character) are inverted."""
    e = Tables(spark, sf_dir).events.select("event_id", "value", _series_id().alias("series_id"))
    out = e.select("event_id", "series_id", C.quote_suffix_invert("series_id", "value").alias("rate"))
    return C.round_doubles(out, R4)


# ---------------------------------------------------------------- strings / mapping


@query("norm_columns", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def norm_columns(spark, sf_dir):
    """Column names with stray case and blanks (as in a landed sheet) normalised."""
    n = Tables(spark, sf_dir).nation
    messy = n.select(
        F.col("n_nationkey").alias(" N_NationKey"), F.col("n_name").alias("N_NAME "), F.col("n_regionkey").alias("n_RegionKey")
    )
    return C.norm_columns(messy)


@query(
    "norm_strings",
    """
SELECT n.n_nationkey, regexp_replace(lower(trim(n.n_name)), '\\s+', '_', 'g') AS nation_name,
       regexp_replace(lower(trim(r.r_name)), '\\s+', '_', 'g') AS region_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""",
)
def norm_strings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = F.broadcast(t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"))
    j = t.nation.join(r, "n_regionkey")
    return j.select("n_nationkey", C.norm_string("n_name").alias("nation_name"), C.norm_string("r_name").alias("region_name"))


# Source codes of the region dimension and their canonical names,
# with one alias (two source codes for one canonical group).
REGION_CODES = [
    ("AFR", "africa"),
    ("AME", "america"),
    ("ASI", "asia"),
    ("EUR", "europe"),
    ("MID", "middle_east"),
    ("MEA", "middle_east"),
]


@query(
    "dim_remap",
    "WITH dim(code, region) AS (VALUES "
    + ", ".join(f"('{c}', '{r}')" for c, r in REGION_CODES)
    + """)
SELECT n.n_nationkey, upper(substr(r.r_name, 1, 3)) AS region_code, dim.region
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN dim ON upper(substr(r.r_name, 1, 3)) = dim.code
""",
)
def dim_remap(spark, sf_dir):
    """Source codes mapped through a small alias dimension (broadcast); an
    unknown code stays visible with a NULL name instead of being dropped."""
    t = Tables(spark, sf_dir)
    dim = F.broadcast(spark.createDataFrame(REGION_CODES, "region_code string, region string"))
    r = F.broadcast(t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"))
    src = t.nation.join(r, "n_regionkey").select(
        "n_nationkey", F.upper(F.substring("r_name", 1, 3)).alias("region_code")
    )
    return src.join(dim, "region_code", "left").select("n_nationkey", "region_code", "region")


# ---------------------------------------------------------------- filters


@query(
    "filter_members",
    """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""",
)
def filter_members(spark, sf_dir):
    """isin on a fixed list + semi join on a member table (no fan-out)."""
    t = Tables(spark, sf_dir)
    o = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )
    members = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return semi_join(o, members, ["o_custkey"])


@query(
    "filter_range",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def filter_range(spark, sf_dir):
    """Inclusive lower bound, pushed into the parquet scan."""
    o = Tables(spark, sf_dir).orders
    return o.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.to_date("o_orderdate").alias("day")
    )


@query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'gear')")
def filter_contains(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.where(F.col("p_name").contains("gear")).select("p_partkey", "p_name")


# ---------------------------------------------------------------- sources


@query(
    "src_json_inline",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def src_json_inline(spark, sf_dir):
    """A JSON payload column parsed with an explicit schema and its array of
    records expanded with ``inline`` (the shape of an API page)."""
    e = Tables(spark, sf_dir).events.select("event_id", "props")
    return landed.inline_json_records(e, "props", "k int", keep=["event_id"], wrap_object=True)


@query(
    "src_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderpriority FROM orders",
)
def src_roundtrip(spark, sf_dir):
    """orders written as CSV into a fresh folder of the shared checkpoint area
    and read back with an explicit schema (no inference pass)."""
    import uuid

    from panelsmith.session import shared_dir

    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = shared_dir(spark, "roundtrip", f"orders-{uuid.uuid4().hex}")
    landed.write_csv(o, path)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    return round_doubles(landed.read_csv(spark, path, schema), 4)


# ---------------------------------------------------------------- splits


@query(
    "hash_split",
    f"""
SELECT o_orderpriority, CASE WHEN {md5_sql('o_orderkey', 100, 'split')} < 80 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n_rows
FROM orders GROUP BY ALL
""",
)
def hash_split(spark, sf_dir):
    """80/20 split by key hash: stable under repartitioning and retries."""
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", split_label("o_orderkey").alias("split"))
    return o.groupBy("o_orderpriority", "split").agg(F.count("*").alias("n_rows"))


@query(
    "kfold_assign",
    f"SELECT o_orderpriority, {md5_sql('o_orderkey', 5, 'fold')} AS fold, count(*) AS n_rows FROM orders GROUP BY ALL",
)
def kfold_assign(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", fold_of("o_orderkey", 5).alias("fold"))
    return o.groupBy("o_orderpriority", "fold").agg(F.count("*").alias("n_rows"))


_NAMES_SQL = "[" + ", ".join(f"'{m}'" for m in D.MONTH_NAMES) + "]"


@query(
    "month_name_remap",
    f"""
SELECT DISTINCT strftime(o_orderdate, '%B') AS month_name,
       CAST(list_position({_NAMES_SQL}, lower(strftime(o_orderdate, '%B'))) AS INTEGER) AS month
FROM orders
""",
)
def month_name_remap(spark, sf_dir):
    """Full month names (as in a landed sheet) mapped to 1..12; a name that
    is not a month fails the job instead of becoming NULL."""
    o = Tables(spark, sf_dir).orders.select(F.date_format("o_orderdate", "MMMM").alias("month_name")).distinct()
    return o.select("month_name", D.month_from_name("month_name").alias("month"))


@query(
    "quarter_month_map",
    """
SELECT DISTINCT strftime(o_orderdate, '%b') AS label,
       CASE strftime(o_orderdate, '%b') WHEN 'Mar' THEN 3 WHEN 'Jun' THEN 6 WHEN 'Sep' THEN 9 WHEN 'Dec' THEN 12 END AS month
FROM orders
""",
)
def quarter_month_map(spark, sf_dir):
    """Quarter-end labels of a quarterly series mapped to their month; other
    labels give NULL."""
    o = Tables(spark, sf_dir).orders.select(F.date_format("o_orderdate", "MMM").alias("label")).distinct()
    return o.select("label", D.quarter_month("label").alias("month"))


@query(
    "column_slice",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def column_slice(spark, sf_dir):
    """Inclusive slice of columns by label (first..last in table order); only
    the sliced columns reach the scan."""
    return C.select_slice(Tables(spark, sf_dir).lineitem, "l_quantity", "l_tax")
