"""Divergence between the sources of a language, over its terms.

First pass: the exact document frequency of every (lang, term), counted per
chunk of text and then by Spark; a language keeps the terms in at least
``min_docs`` of its documents. The kept terms are dealt to shards by their hash,
and each shard gets a minimal perfect hash (``perfect_hash``).

Second pass: batches of shards of bounded size are broadcast; each task looks
up the distinct terms of a chunk, checks them against the stored ones, and adds
their occurrences to dense counters, one per kept term of the batch, for each
(lang, source) it meets. Counters are merged by shard, smoothed, and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelsmith.llm.perfect_hash import Shards, build, hash_terms
from panelsmith.llm.words import chunks, word_runs
from panelsmith.session import cut_lineage

#: Bytes of terms: letters (upper case is lowered first) and all beyond ASCII.
INSIDE = np.ones(256, dtype=bool)
INSIDE[[*range(0x61), *range(0x7B, 0x80)]] = False
#: Terms of a shard, and cells (sources x terms) one task compares at once.
SHARD_TERMS = 1 << 14
SHARD_CELLS = 1 << 23
#: Bytes of hashes and terms that are broadcast at once; more are counted in
#: as many passes over the text.
BATCH_BYTES = 64 << 20
#: Counters a task holds; more are written out and begun again.
DENSE_CELLS = 1 << 24
#: Occurrences after which counters are written out, whatever their number.
FLUSH_WORDS = 1 << 30
#: Partial counters of so many tasks are added by one.
MERGE_TASKS = 256
#: Langs, or sources in all langs, up to which their table is broadcast; beyond,
#: it is joined by the lang.
BROADCAST_ROWS = 100_000
#: Probabilities are whole parts of this.
PARTS = 1_000_000_000


def _labels(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, hash, n): documents of a chunk that hold the term."""
    for batch in batches:
        for part in chunks(batch, "text"):
            words, first = word_runs(part.column("text"), INSIDE)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            size = len(coded.dictionary)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            pair = np.unique(text * size + coded.indices.to_numpy())
            lang, names = _labels(part.column("lang"))
            pair, times = np.unique(lang[pair // size].astype(np.int64) * size + pair % size, return_counts=True)
            hashes = hash_terms(coded.dictionary).view(np.int64)
            yield pa.record_batch(
                [
                    pa.array(names, pa.string()).take(pa.array(pair // size)),
                    coded.dictionary.take(pa.array(pair % size)).cast(pa.large_string()).cast(pa.string()),
                    pa.array(hashes[pair % size]),
                    pa.array(times, pa.int64()),
                ],
                names=["lang", "term", "hash", "n"],
            )


def _build_shard(key: tuple, table: pa.Table) -> pa.Table:
    terms = table.column("term").combine_chunks().cast(pa.large_string())
    levels, slots = build(table.column("hash").to_numpy().view(np.uint64))
    order = np.empty(len(slots), dtype=np.int64)
    order[slots] = np.arange(len(slots))
    terms = terms.take(pa.array(order))
    packed = [bits.tobytes() for bits in levels]
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()], pa.string()),
            "shard": pa.array([key[1].as_py()], pa.int64()),
            "n_shards": pa.array([table.column("n_shards")[0].as_py()], pa.int64()),
            "n_terms": pa.array([len(terms)], pa.int64()),
            "bytes": pa.array([sum(map(len, packed)) + terms.nbytes], pa.int64()),
            "levels": pa.array([packed], pa.list_(pa.binary())),
            "terms": pa.array([terms.to_pylist()], pa.list_(pa.string())),
        }
    )


_SHARD = "lang string, shard long, n_shards long, n_terms long, bytes long, levels array<binary>, terms array<string>"


def term_shards(rows: DataFrame, min_docs: int = 3) -> DataFrame:
    """The kept terms of every language of ``rows`` (lang, source, text),
    sharded: lang, shard, n_shards, n_terms, bytes, levels, terms."""
    counted = rows.select("lang", "text").mapInArrow(_document_terms, "lang string, term string, hash long, n long")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.first("hash").alias("hash")).where(F.col("n") >= min_docs)
    kept = cut_lineage(kept.select("lang", "term", "hash"), "divergence-terms")
    sources = rows.groupBy("lang").agg(F.count_distinct("source").alias("n_sources"))
    per_shard = F.least(F.lit(SHARD_TERMS), F.greatest(F.lit(64), F.floor(F.lit(SHARD_CELLS) / F.col("n_sources"))))
    sizes = kept.groupBy("lang").count().join(sources, "lang").select("lang", F.ceil(F.col("count") / per_shard).alias("n_shards"))
    sizes = cut_lineage(sizes, "divergence-langs")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    dealt = kept.join(sizes, "lang").withColumn("shard", F.pmod("hash", F.col("n_shards")))
    return cut_lineage(dealt.groupBy("lang", "shard").applyInArrow(_build_shard, _SHARD), "divergence-shards")


_PART = "lang string, source string, shard long, part long, slots array<int>, counts array<long>"
_PART_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("shard", pa.int64()),
        ("part", pa.int64()),
        ("slots", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)


class _Counters:
    """Dense counters of a task: a run of cells per (lang, source)."""

    def __init__(self, loaded: dict[str, tuple[Shards, np.ndarray]], part: int):
        self.loaded, self.part = loaded, part
        self.cells = np.zeros(0, dtype=np.int32)
        self.rows: dict[tuple[str, str], int] = {}
        self.used, self.words = 0, 0

    def row(self, lang: str, source: str) -> int:
        """Where the counters of a group begin."""
        if (lang, source) not in self.rows:
            n = int(self.loaded[lang][0].first[-1])
            if self.used + n > len(self.cells):
                grown = np.zeros(max(self.used + n, min(2 * len(self.cells), DENSE_CELLS)), dtype=np.int32)
                grown[: self.used] = self.cells[: self.used]
                self.cells = grown
            self.rows[lang, source] = self.used
            self.used += n
        return self.rows[lang, source]

    def is_full(self, lang: str, source: str) -> bool:
        return bool(self.rows) and (lang, source) not in self.rows and self.used + int(self.loaded[lang][0].first[-1]) > DENSE_CELLS

    def flush(self) -> Iterator[pa.RecordBatch]:
        out = []
        for (lang, source), begin in self.rows.items():
            shards, numbers = self.loaded[lang]
            own = self.cells[begin : begin + int(shards.first[-1])]
            hit = np.flatnonzero(own)
            bounds = np.searchsorted(hit, shards.first)
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                slots = hit[bounds[k] : bounds[k + 1]]
                out.append((lang, source, int(numbers[k]), self.part, (slots - shards.first[k]).astype(np.int32), own[slots].astype(np.int64)))
        self.cells[:] = 0
        self.rows, self.used, self.words = {}, 0, 0
        for i in range(0, len(out), 256):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[i : i + 256]), _PART_ARROW)], schema=_PART_ARROW)


def _load(rows: list[tuple]) -> dict[str, tuple[Shards, np.ndarray, np.ndarray]]:
    """Per lang: the shards of the batch, their numbers, and the place of each
    of the language's shards among them (-1 where it is in another batch)."""
    loaded = {}
    for lang in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: r[1])
        place = np.full(mine[0][2], -1, dtype=np.int64)
        numbers = np.array([r[1] for r in mine], dtype=np.int64)
        place[numbers] = np.arange(len(mine))
        shards = Shards([([np.frombuffer(b, dtype=np.uint64) for b in levels], pa.array(terms, pa.large_string())) for *_, levels, terms in mine])
        loaded[lang] = shards, numbers, place
    return loaded


def _count(batch_of_shards):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = _load(batch_of_shards.value)
        counters = _Counters({k: v[:2] for k, v in loaded.items()}, TaskContext.get().partitionId())
        for batch in batches:
            for part in chunks(batch, "text"):
                words, first = word_runs(part.column("text"), INSIDE)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                codes, terms = coded.indices.to_numpy(), coded.dictionary
                hashes = hash_terms(terms)
                lang, langs = _labels(part.column("lang"))
                source, sources = _labels(part.column("source"))
                group = lang.astype(np.int64) * len(sources) + source
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                # occurrences of the chunk's groups by term, then the slots of
                # each language's own terms
                key, times = np.unique(group[text] * len(terms) + codes, return_counts=True)
                of, code = key // len(terms), key % len(terms)
                for name in langs:
                    if name not in loaded:
                        continue
                    shards, _, place = loaded[name]
                    own = np.flatnonzero(of // len(sources) == langs.index(name))
                    some = np.unique(code[own])
                    shard = place[np.mod(hashes[some].view(np.int64), len(place))]
                    here = shard >= 0
                    slot = np.full(len(terms), -1, dtype=np.int64)
                    slot[some[here]] = shards.lookup(shard[here], hashes[some[here]], terms.take(pa.array(some[here])))
                    own = own[slot[code[own]] >= 0]
                    for g in np.unique(of[own]).tolist():
                        mine = own[of[own] == g]
                        at = name, sources[g % len(sources)]
                        if counters.is_full(*at) or counters.words > FLUSH_WORDS:
                            yield from counters.flush()
                        begin = counters.row(*at)
                        counters.cells[begin + slot[code[mine]]] += times[mine].astype(np.int32)
                        counters.words += int(times[mine].sum())
        yield from counters.flush()

    return count


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    """Sum of the partial counters of one (lang, source, shard)."""
    slots = table.column("slots").combine_chunks().flatten().to_numpy()
    counts = table.column("counts").combine_chunks().flatten().to_numpy()
    total = np.zeros(int(slots.max()) + 1, dtype=np.int64)
    np.add.at(total, slots, counts)
    slots = np.flatnonzero(total)
    row = {"lang": key[0], "source": key[1], "shard": key[2], "part": key[3]}
    row = {k: pa.array([v.as_py()], _PART_ARROW.field(k).type) for k, v in row.items()}
    return pa.table(row | {"slots": pa.array([slots.astype(np.int32)], pa.list_(pa.int32())), "counts": pa.array([total[slots]], pa.list_(pa.int64()))})


def recount(rows: DataFrame, shards: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Occurrences of the terms of ``shards`` in ``rows`` (lang, source, text):
    one row per (lang, source, shard) with any: slots and counts, in order."""
    spark = rows.sparkSession
    before = Window.orderBy("lang", "shard").rowsBetween(Window.unboundedPreceding, -1)
    # one short row per shard
    sizes = shards.select("lang", "shard", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / batch_bytes).alias("batch"))
    numbers = sorted(r[0] for r in sizes.select("batch").distinct().collect())
    dealt = shards.join(sizes, ["lang", "shard"])
    found = None
    for number in numbers:
        # bounded by batch_bytes and one shard
        held = [tuple(r) for r in dealt.where(F.col("batch") == number).select("lang", "shard", "n_shards", "levels", "terms").collect()]
        held = spark.sparkContext.broadcast(held)
        part = cut_lineage(rows.select("lang", "source", "text").mapInArrow(_count(held), _PART), "divergence-counts")
        found = part if found is None else found.unionByName(part)
        held.unpersist()
    if found is None:
        return spark.createDataFrame([], _PART).drop("part")
    tasks = (found.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        found = found.withColumn("part", F.floor(F.col("part") / MERGE_TASKS)).groupBy("lang", "source", "shard", "part").applyInArrow(_merge, _PART)
        if tasks <= MERGE_TASKS:
            return cut_lineage(found.drop("part"), "divergence-merged")
        tasks = -(-tasks // MERGE_TASKS)
        found = cut_lineage(found, "divergence-merging")


def smoothed(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(PARTS * (count + 1) / (n + v)), exact."""
    if n + v < (1 << 63) // PARTS:
        return 1 + PARTS * (counts + 1) // (n + v)
    return np.array([1 + PARTS * (int(c) + 1) // (n + v) for c in counts], dtype=np.int64)


_RESULT = "lang string, source string, part string, item string, value long"


def _compare(ranks: int):
    def compare(key: tuple, counted: pa.Table, shard: pa.Table) -> pa.Table:
        """Pair values over one shard's terms, and each group's highest terms
        in the shard."""
        lang = key[0].as_py()
        terms = shard.column("terms")[0].values
        v = shard.column("v")[0].as_py()
        totals = {x["source"]: x["n"] for x in shard.column("totals")[0].as_py()}
        sources = sorted(totals)
        place = {s: i for i, s in enumerate(sources)}
        counts = np.zeros((len(sources), len(terms)), dtype=np.int64)
        for s, slots, c in zip(counted.column("source").to_pylist(), counted.column("slots"), counted.column("counts")):
            counts[place[s], slots.values.to_numpy()] = c.values.to_numpy()
        all_p = smoothed(counts.sum(axis=0), sum(totals.values()), v)
        p = np.stack([smoothed(row, totals[s], v) for s, row in zip(sources, counts)])
        by_term = np.empty(len(terms), dtype=np.int64)
        by_term[pc.sort_indices(terms.cast(pa.large_binary())).to_numpy()] = np.arange(len(terms))
        out: list[tuple] = []
        for i, source in enumerate(sources):
            total = ((p[i] - p) ** 2 // p).sum(axis=1)
            out += [(source, "pair", other, int(total[j])) for j, other in enumerate(sources) if j != i]
            high = np.flatnonzero((counts[i] > 0) & (p[i] > all_p))
            value = (p[i, high] - all_p[high]) ** 2 // all_p[high]
            top = np.lexsort((by_term[high], -value))[:ranks]
            out += [(source, "term", terms[int(high[k])].as_py(), int(value[k])) for k in top.tolist()]
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array([lang] * len(out), pa.string()), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["lang", "source", "part", "item", "value"])

    return compare


def audit_sources(
    docs: DataFrame,
    min_docs: int = 3,
    ranks: int = 200,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: every other source
    of the lang with the divergence of the group from it; part ``term``: the
    ``ranks`` terms that set the group apart from its lang. Ranks go by value,
    then by the item's bytes.

    A term's share p in a group is 1 + floor(PARTS * (count + 1) / (N + V)), N
    the occurrences of kept terms in the group, V the lang's kept terms; the
    divergence from q is floor((p - q)^2 / q), summed over the terms for a pair.

    Null texts, langs and sources count as empty ones. A lang without kept
    terms has pairs of value 0, a source without terms takes part. Repeated rows
    count each; texts are read whole, whatever their length. Other columns are
    not read, so that names cannot clash. An empty table gives no rows."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    rows = docs.select(*text)
    groups = cut_lineage(rows.select("lang", "source").distinct(), "divergence-groups")
    shards = term_shards(rows, min_docs)
    counted = recount(rows, shards, batch_bytes)
    totals = counted.groupBy("lang", "source").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    totals = groups.join(totals, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = totals.groupBy("lang").agg(F.collect_list(F.struct("source", "n")).alias("totals"))
    per_lang = cut_lineage(shards.groupBy("lang").agg(F.sum("n_terms").alias("v")).join(totals, "lang"), "divergence-totals")
    per_lang = F.broadcast(per_lang) if groups.count() <= BROADCAST_ROWS else per_lang
    info = shards.select("lang", "shard", "terms").join(per_lang, "lang")
    parts = counted.groupBy("lang", "shard").cogroup(info.groupBy("lang", "shard")).applyInArrow(_compare(ranks), _RESULT)
    parts = cut_lineage(parts, "divergence-parts")

    other = groups.select("lang", F.col("source").alias("item"))
    none = groups.join(per_lang.select("lang"), "lang", "left_anti").join(other, "lang").where("source <> item")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(none.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = [t.withColumn("rank", F.row_number().over(order)) for t in (pairs, parts.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= ranks))
