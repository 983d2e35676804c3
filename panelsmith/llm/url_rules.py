"""URL rules by a sort-merge range join (DataFrame functions only).

A rule (host, path) gets the canonical key: host labels reversed, each ended
by a dot, then the path. Everything a rule covers starts with its key, so the
rule is the interval from the key up to the key with a last byte FF, which no
UTF-8 text holds. Rule intervals are nested or disjoint. A url is one point
for every suffix of its host (a rule also covers subdomains): the reversed
suffix, then the url's path.

Interval starts, ends and points are range-partitioned and sorted together.
The sweep keeps the stack of active nested rules: the depth is the running
sum of starts and ends, and the rule on top of a stack of depth d is the
latest one that opened at depth d. Rules already open where a partition
begins are found by an equi-join on the prefixes of its first key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelsmith.session import cut_lineage

RULES_SCHEMA = "host string, path string, verdict string"
#: Rows of a range partition of the sweep, on average.
PARTITION_ROWS = 200_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block); hosts are
    lower-cased. A rule fits its host and all its subdomains if the url's path
    starts with the rule's path. The rule with the longest host and path
    together wins; on equal length, the longer host, then block. Null or empty
    hosts or null paths in ``rules`` fit nothing. ``rule`` is host and path
    joined, null where none fits; the verdict is then ``default``. A null url
    or one without ``://`` has an empty host and path, which no rule fits.
    Repeated rows and null ids are judged like any other row; other columns
    of ``pages`` are not read. Empty tables give no rows, or the default.
    """
    spark = pages.sparkSession
    clean = (
        rules.select(
            F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("r_host"),
            F.col("path").alias("r_path"),
            F.col("verdict").alias("r_verdict"),
        )
        .where("r_host <> '' and r_path is not null")
        .groupBy("r_host", "r_path")
        .agg(F.max("r_verdict").alias("r_verdict"))  # block after allow
        .withColumn("k", F.concat(_reversed(F.col("r_host")), F.col("r_path")).cast("binary"))
    )
    rule = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("len"),
        F.length("r_host").alias("host_len"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    # repeated rows are swept once; the count brings them back
    urls = (
        pages.select(F.col(id_col).alias("u_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
        .groupBy("u_id", "host", "path")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    page = F.struct("u_id", "host", "path", "copies")
    levels = urls.where("host <> ''").select(
        page.alias("page"), F.explode(F.transform(F.split("host", r"\.", -1), lambda x, i: i)).alias("level"), F.split("host", r"\.", -1).alias("labels")
    )
    suffix = F.concat(
        F.array_join(F.reverse(F.slice("labels", F.col("level") + 1, F.size("labels") - F.col("level"))), "."), F.lit(".")
    )
    points = levels.select(
        F.concat(suffix, F.col("page.path")).cast("binary").alias("k"),
        F.lit(1).alias("kind"),
        F.col("page.u_id").alias("tie"),
        F.lit(None).cast("struct<len:int,host_len:int,rule:string,verdict:string>").alias("rule"),
        "page",
    )
    no_page = F.lit(None).cast(points.schema["page"].dataType)
    no_tie = F.lit(None).cast(points.schema["tie"].dataType)
    opens = clean.select("k", F.lit(0).alias("kind"), no_tie.alias("tie"), rule.alias("rule"), no_page.alias("page"))
    ends = clean.select(F.concat("k", F.unhex(F.lit("FF"))).alias("k"), F.lit(2).alias("kind"), no_tie.alias("tie"), rule.alias("rule"), no_page.alias("page"))
    events = points.unionByName(opens).unionByName(ends)

    n_events = urls.where("host <> ''").agg(F.sum(F.size(F.split("host", r"\.", -1)))).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_events // PARTITION_ROWS)
    # the tie column lets equal keys of many pages spread over partitions
    swept = events.repartitionByRange(n_parts, "k", "kind", "tie").withColumn("part", F.spark_partition_id())
    swept = cut_lineage(swept, "url-events")

    # rules open where a partition begins: their keys are proper prefixes of
    # its first key, or equal it while their opening lies in an earlier one
    firsts = swept.groupBy("part").agg(F.min(F.struct("k", "kind")).alias("f")).select("part", "f.k", "f.kind")
    prefixes = firsts.select(
        "part", F.explode(F.sequence(F.lit(1), F.length("k"))).alias("n"), F.col("k").alias("first_k"), F.col("kind").alias("first_kind")
    ).select("part", F.substring("first_k", F.lit(1), F.col("n")).alias("k"), (F.col("n") == F.length("first_k")).alias("whole"), "first_kind")
    carried = (
        prefixes.where("not whole or first_kind > 0")
        .join(clean.select("k", rule.alias("rule")), "k")
        .select("k", F.lit(-1).alias("kind"), no_tie.alias("tie"), "rule", no_page.alias("page"), "part")
    )
    stream = swept.unionByName(carried)
    order = Window.partitionBy("part").orderBy("kind_first", "k", "kind")
    delta = F.when(F.col("kind") <= 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    stream = stream.withColumn("kind_first", F.when(F.col("kind") == -1, 0).otherwise(1)).withColumn("delta", delta)
    stream = stream.withColumn(
        "depth", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # points of depth d see the latest rule opened at depth d
    top = Window.partitionBy("part", "depth").orderBy("kind_first", "k", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (
        stream.where("kind <= 1 and depth > 0")
        .withColumn("top", F.last(F.when(F.col("kind") <= 0, F.col("rule")), ignorenulls=True).over(top))
        .where("kind = 1")
    )
    best = hits.groupBy("page").agg(F.max("top").alias("best"))
    none = urls.select(page.alias("page"), F.lit(None).cast("struct<len:int,host_len:int,rule:string,verdict:string>").alias("best"))
    judged = best.unionByName(none).groupBy("page").agg(F.max("best").alias("best"))
    return judged.select(
        F.col("page.u_id").alias(id_col),
        F.col("page.host").alias("host"),
        F.col("page.path").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("page.copies"))).alias("copy"),
    ).drop("copy")
