"""Secret scans over an incremental blob ledger (DataFrame functions only).

A version of a file is its content: the blob id is the SHA-256 of the text.
The ledger holds one row per (blob, rule, rule version) that was scanned, with
its findings, also where there are none. A scan takes one version of each
blob that has a pair missing from the ledger, runs the missing rules over its
whole text, appends the new rows to the ledger's table, and joins the findings
back to every path with that content.

Positions come from splitting at the rule's matches: a match starts after all
earlier pieces and matches. They count code points; ends are exclusive. Running
sums go block by block, so that a text with many matches costs their number to
the power 1.5, not its square.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsmith.session import cut_lineage

FINDING = "array<struct<start:int,end:int>>"
LEDGER_SCHEMA = f"blob_id string, rule string, version int, spans {FINDING}"


@dataclass(frozen=True)
class Rule:
    """``min_chars`` is the least length of ``group`` (0: the whole match);
    shorter matches are dropped after matching. ``hint`` is a cheap pattern
    that every match contains."""

    name: str
    version: int
    pattern: str
    min_chars: int
    group: int = 0
    hint: str = ""


#: The contract's kinds, in the order in which kinds with equal start are listed.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        group=2,
    ),
    # a run is matched whole, so the least length may stand in the pattern
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 20, hint="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 24),
)
#: Formats that are secrets by themselves; fixed values of public token formats.
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,20}PRIVATE KEY-----", 1, hint="PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", 1, hint="eyJ"),
    Rule("prefixed", 1, r"(?:gh[oprsu]_[A-Za-z0-9]{36,}|xox[abeprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35,}|sk_live_[A-Za-z0-9]{20,})", 1),
    Rule("url_login", 1, r"[a-z][a-z0-9+]{1,15}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{6,128}@", 1, hint="://"),
)
RULES = BASE_RULES + MORE_RULES


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, whatever the uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of ints, in blocks of about the
    square root of its size; an empty array for an empty one."""
    none = F.array().cast("array<int>")

    def scan(xs: Column) -> Column:
        return F.aggregate(xs, none, lambda s, x: F.concat(s, F.array(F.coalesce(F.get(s, F.size(s) - 1), F.lit(0)) + x)))

    def blocks(xs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(xs))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.size(xs) - 1, width), lambda i: scan(F.slice(xs, i + 1, width)))
        return _let(cut, lambda c: _let(scan(F.transform(c, lambda b: F.get(b, F.size(b) - 1))), lambda sums: shifted(c, sums)))

    def shifted(cut: Column, sums: Column) -> Column:
        def shift(block: Column, i: Column) -> Column:
            return _let(F.coalesce(F.get(sums, i - 1), F.lit(0)), lambda before: F.transform(block, lambda x: x + before))

        return F.flatten(F.transform(cut, shift))

    return _let(values, lambda xs: F.when(F.size(xs) > 0, blocks(xs)).otherwise(none))


def match_spans(text: Column, rule: Rule) -> Column:
    """All kept matches of ``rule`` in ``text`` as an array of (start, end)."""
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    # zipped, so that each expression is evaluated once per text; the last
    # piece follows the last match
    parts = F.transform(
        F.filter(F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), tested.alias("tested")), lambda z: z["whole"].isNotNull()),
        lambda z: F.struct(F.length(z["piece"]).alias("gap"), F.length(z["whole"]).alias("len"), F.length(z["tested"]).alias("size")),
    )
    def placed(ps: Column) -> Column:
        ends = running_sums(F.transform(ps, lambda x: x["gap"] + x["len"]))
        spans = F.zip_with(
            ps, ends, lambda x, end: F.struct((end - x["len"]).alias("start"), end.alias("end"), x["size"].alias("size"))
        )
        return F.filter(spans, lambda x: x["size"] >= rule.min_chars)

    found = _let(parts, placed)
    found = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    # most texts have no match: the cheap test spares them the split
    hit = text.contains(rule.hint) if rule.hint else text.rlike(rule.pattern)
    return F.when(hit, found).otherwise(F.array().cast(FINDING))


def blob_id(text: Column) -> Column:
    """SHA-256 of the text as lower-case hex; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """New ledger rows: every (blob of ``versions``, rule version) pair that
    ``ledger`` lacks, scanned over the whole text. Append them to the ledger.

    A null text is an empty blob. Copies are scanned once; blobs with all
    pairs in the ledger are not read by any rule. No versions: no rows."""
    spark = versions.sparkSession
    blobs = versions.select(blob_id(F.col(text_col)).alias("blob_id"), F.coalesce(F.col(text_col), F.lit("")).alias("b_text"))
    known = [(r.name, r.version) for r in rules]
    wanted = spark.createDataFrame(known, "rule string, version int")
    todo = blobs.select("blob_id").distinct()
    if ledger is not None:
        seen = (
            ledger.join(F.broadcast(wanted), ["rule", "version"], "left_semi")
            .groupBy("blob_id")
            .agg(F.collect_set("rule").alias("seen"))
        )
        todo = todo.join(seen, "blob_id", "left").where(F.size(F.coalesce("seen", F.array().cast("array<string>"))) < len(rules))
        todo = todo.withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        texts = blobs.groupBy("blob_id").agg(F.first("b_text").alias("b_text")).join(todo, "blob_id")
    else:
        texts = blobs.groupBy("blob_id").agg(F.first("b_text").alias("b_text")).withColumn("seen", F.array().cast("array<string>"))
    results = [
        F.when(
            ~F.array_contains("seen", r.name),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), match_spans(F.col("b_text"), r).alias("spans")),
        )
        for r in rules
    ]
    # the outer form: for the inner one the optimiser would add a test of the
    # array's size, and so run the rules twice
    scanned = texts.select("blob_id", F.explode_outer(F.array(*results)).alias("r")).where("r is not null")
    return scanned.select("blob_id", "r.rule", "r.version", "r.spans")


def update_ledger(
    versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """Scan what the ledger stored at ``path`` lacks, append it there, and
    return the whole ledger. A ledger that is not there yet is begun.

    The append is one job: if it fails, nothing of it is seen. Two that run at
    once may store a pair twice, which counts once."""
    spark = versions.sparkSession
    new = scan_unseen(versions, read_ledger(spark, path), rules, text_col)
    new.write.mode("append").parquet(path)
    return read_ledger(spark, path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger stored at ``path``; None where there is none."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def blob_findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with a finding of the current rules: blob_id, found
    (array of rank, kind, start, end, by start and then rule order). If a
    ledger holds a pair twice, its spans count once."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    current = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.version))])
    hits = ledger.where((F.size("spans") > 0) & (F.element_at(current, F.col("rule")) == F.col("version")))
    per_rule = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), F.element_at(rank, F.col("rule")).alias("rank"), F.col("rule").alias("kind"), s["end"].alias("end")
        ),
    )
    return (
        hits.select("blob_id", per_rule.alias("s"))
        .groupBy("blob_id")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("found"))
    )


#: Blobs with findings, and findings, up to which their list may be broadcast.
BROADCAST_ROWS, BROADCAST_SPANS = 200_000, 2_000_000


def _small(findings: DataFrame) -> DataFrame:
    """``findings`` stored, and marked for a broadcast if small enough."""
    hits = cut_lineage(findings, "secret-findings")
    rows, spans = hits.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("found")), F.lit(0))).first()
    return F.broadcast(hits) if rows <= BROADCAST_ROWS and spans <= BROADCAST_SPANS else hits


def findings_by_path(
    versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Every row of ``versions`` (columns ``keep``) with blob_id and found; an
    empty array where its content has no finding. Repeated rows and null ids
    keep their rows. ``keep`` may not name blob_id or found. Up to
    BROADCAST_ROWS blobs with BROADCAST_SPANS findings in all are broadcast, so
    that the copies of one blob do not gather in a task."""
    if {"blob_id", "found"} & set(keep):
        raise ValueError("keep names blob_id or found")
    paths = versions.select(F.struct(*keep).alias("path"), blob_id(F.col(text_col)).alias("blob_id"))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return paths.join(_small(blob_findings(ledger, rules)), "blob_id", "left").select(
        "path.*", "blob_id", F.coalesce("found", none).alias("found")
    )


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("bigint")


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """``text`` with every finding replaced by ``mark``; overlapping findings
    become one. ``found`` must be ordered by start."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, x["start"] - s["at"])
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], gap, F.lit(mark))).otherwise(s["out"]).alias("out"),
        )

    done = F.aggregate(found, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)


def redact_versions(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``versions`` with the findings in ``text_col`` replaced; all rows and
    columns stay, texts without findings as they are."""
    hits = _small(blob_findings(ledger, rules).select(F.col("blob_id").alias("__blob"), "found")).withColumnRenamed("found", "__found")
    joined = versions.withColumn("__id", blob_id(F.col(text_col))).join(hits, F.col("__id") == F.col("__blob"), "left")
    clean = F.when(F.col("__found").isNull(), F.col(text_col)).otherwise(redact(F.col(text_col), F.col("__found")))
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in versions.columns])
