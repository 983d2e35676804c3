"""Mixing sources to target weights by Pfair scheduling (DataFrame functions only).

Every source's documents are put in a fixed pseudo-random order and cut into
blocks of ``block_chars`` characters. With integer weights ``a_i`` of sum ``D``,
the k-th block (from 0) of source i may run from slot ``floor(k * D / a_i)``
(its release) and must have run before slot ``ceil((k + 1) * D / a_i)`` (its
deadline). Slots are filled earliest deadline first among released blocks, so
after every slot each source is less than one block away from its exact share.

Windows repeat every D slots, so a round of D slots is laid out once by a fold
over the slots (its size is set by the weights, not by the data) and block k
of source i is found by arithmetic: round ``k div a_i``, place ``k mod a_i``.
A source that runs out leaves; the later rounds are laid out for the sources
that still have blocks. No row is dropped or repeated: rows from the first
round that some source cannot fill whole carry ``on_target = false``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HASH_BITS = 40
#: Rows that one bucket of the order holds on average; it sets parallelism only.
BUCKET_ROWS = 4096
MAX_PERIOD = 10_000
OTHER = "(other)"


def _round_layout(active: Column) -> Column:
    """Slots of one round as an array of indexes into ``active``: an array of
    structs (idx, parts). Earliest deadline first among released blocks."""
    period = F.aggregate(active, F.lit(0).cast("bigint"), lambda s, x: s + x["parts"])
    start = F.struct(
        F.transform(active, lambda x: F.lit(0).cast("bigint")).alias("done"),
        F.array().cast("array<int>").alias("slots"),
    )

    def step(state: Column, t: Column) -> Column:
        choices = F.transform(
            active,
            lambda x, i: F.when(
                F.floor(F.get(state["done"], i) * period / x["parts"]) <= t,
                F.struct(
                    F.ceil((F.get(state["done"], i) + 1) * period / x["parts"]).alias("deadline"),
                    i.alias("pos"),
                ),
            ),
        )
        chosen = F.array_min(F.filter(choices, lambda c: c.isNotNull()))["pos"]
        return F.struct(
            F.transform(state["done"], lambda n, i: F.when(i == chosen, n + 1).otherwise(n)).alias("done"),
            F.concat(state["slots"], F.array(F.get(active, chosen)["idx"])).alias("slots"),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), period - 1), start, step, lambda s: s["slots"])


def source_plan(totals: DataFrame, block_chars: int) -> DataFrame:
    """One row per source: its phases (from_round, to_round, first_slot,
    period, places), from ``totals`` (source_key, parts, chars). A table of at
    most one row per weight and one for all other sources."""
    blocks = totals.withColumn("blocks", F.greatest(F.ceil(F.col("chars") / block_chars), F.lit(1))).withColumn(
        "rounds", F.ceil(F.col("blocks") / F.col("parts"))
    ).withColumn("full_rounds", F.floor(F.col("blocks") / F.col("parts")))
    one = blocks.agg(
        F.sort_array(F.collect_list(F.struct("source_key", F.col("parts").cast("bigint").alias("parts"), "rounds", "full_rounds"))).alias("raw")
    ).select(
        F.transform(
            "raw",
            lambda x, i: F.struct(
                i.alias("idx"), *[x[c].alias(c) for c in ("source_key", "parts", "rounds", "full_rounds")]
            ),
        ).alias("all")
    )
    ends = one.select("all", F.array_sort(F.array_distinct(F.transform("all", lambda x: x["rounds"]))).alias("ends"))
    full = F.array_min(F.transform("all", lambda x: x["full_rounds"]))
    phases = ends.select("all", F.posexplode("ends").alias("phase", "to_round"), "ends").select(
        "phase",
        "to_round",
        F.when(F.col("phase") == 0, F.lit(0)).otherwise(F.get("ends", F.col("phase") - 1)).cast("bigint").alias("from_round"),
        F.filter("all", lambda x: x["rounds"] >= F.col("to_round")).alias("active"),
        full.alias("target_rounds"),
    )
    phases = phases.withColumn("period", F.aggregate("active", F.lit(0).cast("bigint"), lambda s, x: s + x["parts"])).withColumn(
        "slots", _round_layout(F.col("active"))
    )
    in_order = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)
    phases = phases.withColumn(
        "first_slot", F.coalesce(F.sum((F.col("to_round") - F.col("from_round")) * F.col("period")).over(in_order), F.lit(0))
    )
    per_source = phases.select("phase", "from_round", "to_round", "period", "first_slot", "slots", "target_rounds", F.explode("active").alias("a")).select(
        F.col("a.source_key").alias("source_key"),
        F.col("a.parts").alias("parts"),
        F.struct(
            "phase",
            "from_round",
            "to_round",
            "period",
            "first_slot",
            "target_rounds",
            F.filter(
                F.transform("slots", lambda s, i: F.when(s == F.col("a.idx"), i)),
                lambda i: i.isNotNull(),
            ).alias("places"),
        ).alias("p"),
    )
    return per_source.groupBy("source_key", "parts").agg(F.sort_array(F.collect_list("p")).alias("phases"))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, int],
    block_chars: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    other_weight: int = 1,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Give every row of ``docs`` its slot in the interleaved order.

    Returns ``id_col``, ``source_col``, the columns named in ``keep``, and:
    mix_source (the weight's name, or "(other)" for null and unlisted sources,
    which share ``other_weight``), block, release, deadline, slot (long),
    offset_chars (characters of the source before this row) and on_target.
    Rows ordered by (slot, offset_chars) form the mixed corpus.

    Null or empty texts have size 0 and stay in the block where they fall; a
    text longer than a block sits in the block where it begins, and the blocks
    it covers stay empty. Rows with a null id are ordered by their text.
    Repeated rows each keep a place. An empty table gives an empty result.
    ``block_chars`` and weights must be positive integers with a sum of at
    most ``MAX_PERIOD``, else ValueError.
    """
    if block_chars < 1 or not weights or any(int(w) != w or w < 1 for w in [*weights.values(), other_weight]):
        raise ValueError("weights and block_chars must be positive integers")
    if OTHER in weights:
        raise ValueError(f"{OTHER!r} names the sources without a weight")
    if sum(weights.values()) + other_weight > MAX_PERIOD:
        raise ValueError(f"the sum of the weights is over {MAX_PERIOD}")
    spark = docs.sparkSession
    table = spark.createDataFrame([*weights.items(), (OTHER, other_weight)], "source_key string, parts long")
    source = F.col(source_col).cast("string")
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.col(text_col))), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("m_id"),
        F.col(source_col).alias("m_source"),
        F.struct(*[F.col(c) for c in keep]).alias("m_kept") if keep else F.lit(0).alias("m_kept"),
        F.coalesce(F.when(source.isin(*weights), source), F.lit(OTHER)).alias("source_key"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("bigint").alias("chars"),
        F.conv(F.substring(order, 1, HASH_BITS // 4), 16, 10).cast("bigint").alias("m_hash"),
    )
    sums = rows.groupBy("source_key").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n_rows"))
    plan = source_plan(sums.join(F.broadcast(table), "source_key"), block_chars)

    # order within a source: buckets of the hash, then the hash in the bucket;
    # the number of buckets follows the number of rows
    n_rows = docs.count()
    n_buckets = max(1, min(n_rows // BUCKET_ROWS, 1 << 22))
    rows = rows.withColumn("m_bucket", F.shiftright(F.col("m_hash") * n_buckets, HASH_BITS))
    bucket_sums = rows.groupBy("source_key", "m_bucket").agg(F.sum("chars").alias("bucket_chars"))
    before = Window.partitionBy("source_key").orderBy("m_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket_sums = bucket_sums.select(
        "source_key", "m_bucket", F.coalesce(F.sum("bucket_chars").over(before), F.lit(0)).alias("bucket_start")
    )
    inside = Window.partitionBy("source_key", "m_bucket").orderBy("m_hash", "m_id", "chars").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("m_inside", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
        .join(bucket_sums, ["source_key", "m_bucket"])
        .join(F.broadcast(plan), "source_key")  # one row per weight
        .withColumn("offset_chars", F.col("bucket_start") + F.col("m_inside"))
        .withColumn("block", F.floor(F.col("offset_chars") / block_chars))
    )
    # rows of size 0 at the very end of a source belong to its last block
    last = F.greatest(F.ceil(F.col("source_chars") / block_chars), F.lit(1)) - 1
    placed = placed.join(
        F.broadcast(sums.select("source_key", F.col("chars").alias("source_chars"))), "source_key"
    ).withColumn("block", F.least("block", last))
    placed = placed.withColumn("m_round", F.floor(F.col("block") / F.col("parts"))).withColumn("m_place", F.col("block") % F.col("parts"))
    placed = placed.withColumn(
        "p", F.get(F.filter("phases", lambda p: (p["from_round"] <= F.col("m_round")) & (F.col("m_round") < p["to_round"])), F.lit(0))
    )
    start = F.col("p.first_slot") + (F.col("m_round") - F.col("p.from_round")) * F.col("p.period")
    return placed.select(
        F.col("m_id").alias(id_col),
        F.col("m_source").alias(source_col),
        *[F.col("m_kept")[c].alias(c) for c in keep],
        F.col("source_key").alias("mix_source"),
        F.col("block").cast("bigint").alias("block"),
        (start + F.floor(F.col("m_place") * F.col("p.period") / F.col("parts"))).cast("bigint").alias("release"),
        (start + F.ceil((F.col("m_place") + 1) * F.col("p.period") / F.col("parts"))).cast("bigint").alias("deadline"),
        (start + F.get("p.places", F.col("m_place").cast("int"))).cast("bigint").alias("slot"),
        F.col("offset_chars").cast("bigint").alias("offset_chars"),
        (F.col("m_round") < F.col("p.target_rounds")).alias("on_target"),
    )
