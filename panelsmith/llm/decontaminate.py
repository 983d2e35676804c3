"""Benchmark decontamination by MinHash containment search over size classes
(DataFrame functions only).

Documents are partitioned by size: class b holds those of up to 2**b shingles.
A document's sketch is a one-permutation MinHash whose number of bins follows
its class: the hash range is cut into 2**(b + d) bins and each bin keeps its
least shingle hash. A bin agrees with an item when its minimum is one of the
item's shingles. A shared shingle is the minimum of its bin with probability
p(L) = (1 - exp(-L)) / L at a load of at most L = 2**-d shingles a bin, in
every class alike, so an item with m shingles to be shared is missed with
probability (1 - p)**m. ``d`` is the smallest for which that is at most
``max_miss`` for the shortest item; no document or item is left out.
Every pair with an agreeing bin is verified by exact shingle containment.

An item of fewer than n words has its whole sequence as its only shingle; the
runs of that many words in the documents are added to their sketches unreduced,
since each may be the one that is shared, for the lengths that occur only.
One sketch, of the bins that the shortest item needs, serves items of all
sizes: coarser bins' minima are among those of finer bins, so a sketch per size
of item would add rows, not save them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelsmith.session import cut_lineage

#: Rows up to which a list of text digests (8 bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000


def text_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _windows(words: Column, n: int) -> Column:
    """Starts of the n-word runs."""
    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(none)


def shingle_texts(words: Column, n: int) -> Column:
    return F.array_distinct(F.transform(_windows(words, n), lambda i: F.array_join(F.slice(words, i, n), " ")))


def shingle_hashes(words: Column, n: int) -> Column:
    return F.sort_array(F.transform(_windows(words, n), lambda i: F.xxhash64(F.slice(words, i, n))))


def run_hashes(words: Column, k: int) -> Column:
    """Distinct hashes of the k-word runs."""
    return F.array_distinct(F.transform(_windows(words, k), lambda i: F.xxhash64(F.slice(words, i, k))))


def _padded(words: Column) -> Column:
    """Words hold no space, so that runs of words are substrings of this."""
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def extra_bits(least_shared: int, max_miss: float) -> int:
    """The smallest d for which an item that shares ``least_shared`` shingles
    is missed with probability ``max_miss`` at most."""
    for d in range(40):
        load = 2.0**-d
        if (1 - -math.expm1(-load) / load) ** least_shared <= max_miss:
            return d
    raise ValueError("max_miss is too small")


def sketch(hashes: Column, n_bits: Column) -> Column:
    """Least hash of each bin; ``hashes`` is sorted, so a bin's elements are
    neighbours and its first one is kept."""
    shift = (F.lit(64) - n_bits).cast("int")
    return F.filter(
        hashes,
        lambda h, i: (i == 0)
        | (F.call_function("shiftrightunsigned", h, shift) != F.call_function("shiftrightunsigned", F.get(hashes, i - 1), shift)),
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    max_miss: float = 1e-6,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least_words: int = 1,
) -> DataFrame:
    """Pairs (``id_col``, ``item_col``, n_shared, n_item, containment) of a
    document that holds at least ``threshold`` of an item's distinct n-word
    shingles.

    An item of fewer than n words is held by a document that has its words
    consecutively (n_item and n_shared are 1); items of fewer than
    ``least_words`` are not searched. Null and empty items and documents match
    nothing. A very long text is handled whole, by one task. Ids may be null; a
    pair of ids that several rows give is reported once, with its largest
    containment. Other columns are not read. Empty tables give no pairs.
    """
    short = F.size("w") < n
    wanted = (
        items.select(F.col(item_col).alias("item"), text_words(F.col(item_text_col)).alias("w"))
        .where(F.size("w") >= max(1, least_words))
        .select(
            "item",
            F.when(short, F.size("w")).alias("short"),
            F.when(short, F.array(_padded(F.col("w")))).otherwise(shingle_texts(F.col("w"), n)).alias("item_shingles"),
            F.when(short, F.array(F.xxhash64("w"))).otherwise(shingle_hashes(F.col("w"), n)).alias("h"),
        )
        .distinct()
        .withColumns({"n_item": F.size("item_shingles"), "item_key": F.xxhash64("item", "h")})
    )
    wanted = cut_lineage(wanted, "decontaminate-items")
    shortest = wanted.where("short IS NULL").agg(F.min("n_item")).first()[0]
    d = extra_bits(max(1, math.ceil(threshold * (shortest or 1))), max_miss) if shortest else 0
    lengths = sorted(r.short for r in wanted.where("short IS NOT NULL").select("short").distinct().collect())  # below n
    probes = wanted.select(F.explode(F.array_distinct("h")).alias("hash"), "item_key")

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("d_text"), F.xxhash64(text_col).alias("digest"))
    sized = (
        texts.select("digest", text_words(F.col("d_text")).alias("w"))
        .select("digest", shingle_hashes(F.col("w"), n).alias("h"), *[run_hashes(F.col("w"), k).alias(f"r{k}") for k in lengths])
        .withColumn("n_bits", F.least(F.ceil(F.log2(F.greatest(F.size("h"), F.lit(1)))) + d, F.lit(63)))
    )
    # the outer form, and no filter on the size: the optimiser would push a
    # filter into the scan and compute every array again for each element
    hashes = F.concat(sketch(F.col("h"), F.col("n_bits")), *[F.col(f"r{k}") for k in lengths])
    agreeing = sized.select("digest", F.explode_outer(hashes).alias("hash")).join(probes, "hash")
    found = cut_lineage(agreeing.select("digest", "item_key").distinct(), "decontaminate-candidates")

    some = found.select("digest").distinct()
    few = some.count() <= BROADCAST_ROWS
    read = texts.join(F.broadcast(some) if few else some.hint("shuffle_hash"), "digest")
    read = read.select("id", "digest", text_words(F.col("d_text")).alias("w")).select(
        "id", "digest", shingle_texts(F.col("w"), n).alias("s"), *([_padded(F.col("w")).alias("run")] if lengths else [])
    )
    shared = F.size(F.array_intersect("s", "item_shingles"))
    if lengths:
        held = F.col("run").contains(F.col("item_shingles")[0]).cast("int")
        shared = F.when(F.col("short").isNull(), shared).otherwise(held)
    pairs = (
        read.join(found, "digest")
        .join(wanted.select("item_key", "item", "short", "item_shingles", "n_item"), "item_key")
        .select("id", "item", shared.cast("bigint").alias("n_shared"), F.col("n_item").cast("bigint").alias("n_item"))
        .where((F.col("n_shared") > 0) & (F.col("n_shared") >= F.lit(threshold) * F.col("n_item")))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )
    best = F.max(F.struct("containment", "n_shared", "n_item"))
    return (
        pairs.groupBy("id", "item")
        .agg(best.alias("b"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "b.n_shared", "b.n_item", "b.containment")
    )
