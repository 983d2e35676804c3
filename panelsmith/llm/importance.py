"""Quality selection by importance resampling.

A text is the set of its hashed n-grams: words, word pairs, word shapes, and
runs of 4, 8 and 16 equal words, whichever word it is. The target model is
fitted on labelled good text, the raw model on all text. A document's weight
is log p(target) - log p(raw), a sum of one log rate per distinct n-gram; the
sample without replacement is the Gumbel top-k of weight + temperature *
noise, with noise from a keyed hash of the id.

Of a bucket that n documents hold, c of them in the target, the rate is (c +
s) / (s (n + 1)), s the target's share of all counts. Most buckets differ from
s by chance alone, and a long text sums thousands of them. So the log rate is
weighed by the probability that the bucket's share is its own and not s: a
beta-binomial of mean s that varies with CLUMPS (documents come in families)
against one with a share near 0 or 1, at odds of SPECIAL to begin with.

A target document would count as its own evidence. Its weight comes from a
model without its fold of the target (folds by text, so that copies share
one); all other documents' from the whole target. So the weights of labelled
and other good documents are alike, and k is the number of documents whose
weight is no less than that of the RECALL share of the labelled good ones.

Counts have a fixed number of buckets; every document is counted. Rows pass
between jobs as blocks of buckets and (id, weight).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.llm import words as W
from panelsmith.session import cut_lineage

#: Buckets of the hashed n-grams: a bound on the size of every model.
N_BUCKETS = 1 << 20
#: Odds that a bucket's share of target documents is its own, before counts.
SPECIAL = 1e-3
#: Documents whose chance variation the other buckets' shares have.
CLUMPS = 30.0
#: Share of the labelled good documents whose weights the sample's size covers.
RECALL = 0.99
#: Parts of the target, each scored without itself.
FOLDS = 4
#: Lengths of runs of equal words that are n-grams of their own.
RUNS = (4, 8, 16)
#: Buckets that travel together, and groups that a block's counts are first added up in.
BLOCK, SALTS = 1 << 16, 64
#: Bytes of text whose n-grams are held at once.
CHUNK_BYTES = 1 << 19
#: Labels (an id and a kind, 16 bytes) up to which they may be broadcast.
BROADCAST_ROWS = 1_000_000


def _shape_hashes(words: W.Words) -> np.ndarray:
    """Hash of each word's shape: its runs of upper case, lower case and other
    letters, digits, and each punctuation mark, one sign per run."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91], table[97:123], table[48:58], table[128:] = 65, 97, 48, 97
    signs = table[words.data]
    keep = ~W.SEPARATOR[words.data]
    same = np.zeros(len(signs), dtype=bool)
    same[1:] = signs[1:] == signs[:-1]
    same[words.begin] = False  # a word's first run counts
    keep &= ~same
    places = np.cumsum(keep) - 1
    return W.hash_runs(signs[keep], W._byte_values(False), places[words.begin])


def features(words: W.Words, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each of some texts, and their texts, in the
    order of text and bucket."""
    text, h = words.text_of_word(), words.hashes
    shapes = W.mix(_shape_hashes(words) + np.uint64(0x2545F4914F6CDD1D))
    inside = text[1:] == text[:-1] if len(text) else np.zeros(0, dtype=bool)
    half = np.uint64(n_buckets // 2)  # pairs, mostly rare, do not dilute words
    buckets = [h % half, shapes % half, W.ngrams(h, 2)[inside] % half + half]
    texts = [text, text, text[1:][inside]]
    equal = inside & (h[1:] == h[:-1])  # a word and the one before it
    for length in RUNS:
        ends = np.flatnonzero(np.convolve(equal, np.ones(length - 1, dtype=np.int64), "valid") == length - 1) if len(equal) >= length - 1 else []
        texts.append(np.unique(text[ends]) if len(ends) else text[:0])
        buckets.append(np.full(len(texts[-1]), W.mix(np.array([length], dtype=np.uint64))[0] % half, dtype=np.uint64))
    keys = np.sort(np.concatenate(texts).astype(np.int64) * n_buckets + np.concatenate(buckets).astype(np.int64))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return keys % n_buckets, keys // n_buckets


def _pack(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize * int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), dtype=kind)


_BLOCKS = pa.schema([("kind", pa.int32()), ("at", pa.int32()), ("salt", pa.int32()), ("blob", pa.binary())])


def _count(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(kind, at, total, blob): documents per bucket from ``at`` on, of each
    fold of the target (kind 0 to FOLDS - 1) and of all rows (FOLDS), over the
    rows (kind, text). Tasks send compressed blocks, which are added up in
    salted groups first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((FOLDS + 1, n_buckets), dtype=np.int32)
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK_BYTES):
                bucket, text = features(W.split_words(part.column("text"), lower=False), n_buckets)
                kind = part.column("kind").to_numpy(zero_copy_only=False)[text]
                for k in range(FOLDS):
                    np.add.at(counts[k], bucket[kind == k], 1)
                np.add.at(counts[FOLDS], bucket, 1)
        size, salt = min(BLOCK, n_buckets), TaskContext.get().partitionId() % SALTS
        for k, row in enumerate(counts):
            for at in range(0, n_buckets, size):
                if row[at : at + size].any():
                    block = {"kind": k, "at": at, "salt": salt, "blob": _pack(row[at : at + size].astype("i8"))}
                    yield pa.RecordBatch.from_pylist([block], schema=_BLOCKS)
        del counts, row
        W.release_memory()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = 0
        for blob in pdf["blob"]:
            counts = counts + _unpack(blob, "i8")
        return pdf.iloc[:1][["kind", "at"]].assign(total=int(counts.sum()), blob=[_pack(counts)])

    schema = "kind int, at int, total long, blob binary"
    first = docs.mapInArrow(work, "kind int, at int, salt int, blob binary").groupBy("kind", "at", "salt").applyInPandas(add, schema)
    return cut_lineage(first.groupBy("kind", "at").applyInPandas(add, schema), "importance-counts")


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """log of the gamma function for z > 0, by Stirling's series at z + 8."""
    shift = np.zeros(np.shape(z))
    for i in range(8):
        shift += np.log(z + i)
    z = z + 8.0
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) - shift


def _log_split(c: np.ndarray, n: np.ndarray, a: float, b: float) -> np.ndarray:
    """log probability of one order of c of n under a beta-binomial of a, b."""
    of = [_log_gamma(np.array([x]))[0] for x in (a + b, a, b)]
    return _log_gamma(c + a) + _log_gamma(n - c + b) - _log_gamma(n + a + b) + of[0] - of[1] - of[2]


def log_rates(c: np.ndarray, n: np.ndarray, share: float, special: float = SPECIAL) -> np.ndarray:
    """log p(target) - log p(raw) of buckets in n documents, c of them in the
    target, weighed by the evidence that their share is not ``share``."""
    both, at = np.unique(np.stack([c, n]), axis=1, return_inverse=True)  # few of them differ
    c, n = both.astype(np.float64)
    odds = _log_split(c, n, share, 1 - share) - _log_split(c, n, CLUMPS * share, CLUMPS * (1 - share)) + math.log(special)
    rate = np.log((c + share) / ((n + 1) * share))
    return (rate / (1 + np.exp(np.minimum(-odds, 700))))[at.reshape(-1)]


def fit_models(rows: DataFrame, n_buckets: int = N_BUCKETS, special: float = SPECIAL) -> np.ndarray | None:
    """Log rates per bucket of the target without each of its folds, and of the
    whole target (the last row), from rows (kind, text); None without a target.
    They are computed block by block in tasks; (FOLDS + 1) * n_buckets numbers
    of four bytes reach the driver, whatever the number of rows."""
    counts = _count(rows, n_buckets)
    totals = {r["kind"]: r["total"] for r in counts.groupBy("kind").agg(F.sum("total").alias("total")).collect()}
    target, everything = [totals.get(k, 0) for k in range(FOLDS)], totals.get(FOLDS, 0)
    if not sum(target):
        return None
    size = min(BLOCK, n_buckets)

    def rates(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = {k: _unpack(b, "i8") for k, b in zip(pdf["kind"], pdf["blob"])}
        folds = [blocks.get(k, np.zeros(size, dtype=np.int64)) for k in range(FOLDS)]
        out = []
        for left_out in range(FOLDS + 1):
            c = sum((f for k, f in enumerate(folds) if k != left_out), np.zeros(size, dtype=np.int64))
            share = (sum(target) - (target[left_out] if left_out < FOLDS else 0)) / everything
            # a share of 0 or 1 tells nothing apart
            out.append(log_rates(c, blocks[FOLDS], share, special) if 0 < share < 1 else np.zeros(size))
        return pd.DataFrame({"at": [int(pdf["at"].iloc[0])], "blob": [_pack(np.concatenate(out).astype("f4"))]})

    models = np.zeros((FOLDS + 1, n_buckets), dtype=np.float32)
    for r in counts.groupBy("at").applyInPandas(rates, "at int, blob binary").collect():
        models[:, r["at"] : r["at"] + size] = _unpack(bytes(r["blob"]), "f4").reshape(FOLDS + 1, size)
    return models


def log_weights(docs: DataFrame, shared, id_type: str) -> DataFrame:
    """(id, text_key, kind, n_words, log_weight) of the rows (id, text_key,
    kind, text). ``shared`` is the broadcast result of ``fit_models``."""
    n_buckets = shared.value.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in W.chunks(batch, "text", CHUNK_BYTES):
                split = W.split_words(part.column("text"), lower=False)
                bucket, text = features(split, n_buckets)
                kind = part.column("kind").to_numpy(zero_copy_only=False)
                weight = np.bincount(text, weights=table[kind[text], bucket], minlength=part.num_rows).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_key"), part.column("kind"), pa.array(np.diff(split.first), pa.int64()), pa.array(weight)],
                    names=["id", "text_key", "kind", "n_words", "log_weight"],
                )
        W.release_memory()

    return docs.mapInArrow(work, f"id {id_type}, text_key long, kind int, n_words long, log_weight double")


def kth_largest(df: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value (None beyond the number of rows), by counting
    equal bands of the range that holds it: 4096 counts are collected a pass,
    however many rows there are."""
    low, high, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if k > n or k < 1:
        return None
    above = 0  # values known to be larger than the range
    while low < high:
        width = (high - low) / 4096
        if low + width <= low or high - width >= high:
            width = 0.0
        band = F.least(F.floor((F.col(col) - low) / width), F.lit(4095)) if width else F.when(F.col(col) == high, 1).otherwise(0)
        counts = (
            df.where((F.col(col) >= low) & (F.col(col) <= high))
            .groupBy(band.alias("band"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
            .collect()
        )
        for row in sorted(counts, key=lambda r: -r["band"]):
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
    return low


def select_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_buckets: int = N_BUCKETS,
    special: float = SPECIAL,
    recall: float = RECALL,
    temperature: float = 1.0,
    seed: int = 20,
    share: float | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text_key (xxhash64 of the
    text), n_words, log_weight, key (log_weight + temperature * Gumbel noise)
    and kept (boolean).

    ``labels`` (``id_col``, quality 0/1, toxic 0/1) marks good text (quality 1,
    toxic 0), the target, and unwanted text (quality 0, or else toxic 1), which
    is raw text like any other. Labels with nulls are not used; an id with
    several labels is unwanted if any says so. k is ``share`` of the rows, or by
    default the number of documents whose weight is no less than that of the
    ``recall`` share of the labelled good ones. Ties at the cut all stay, so
    repeated rows share their fate. Null and empty texts have weight 0; a very
    long text is handled by itself. Where no row is labelled good, all weights
    are 0 and every row is kept. Rows with a null id are scored, with noise 0.
    Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    marks = labels.select(F.col(id_col).alias("id"), bad.alias("bad")).where("id is not null and bad is not null")
    marks = cut_lineage(marks.groupBy("id").agg(F.max("bad").alias("bad")), "importance-labels")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks.hint("shuffle_hash")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).join(marks, "id", "left")
    fold = F.when(F.col("bad") == 0, F.pmod("text_key", F.lit(FOLDS))).otherwise(FOLDS).cast("int")
    rows = rows.select("id", "text_key", fold.alias("kind"), "text")
    models = fit_models(rows, n_buckets, special)
    if models is None:
        models = np.zeros((FOLDS + 1, 2), dtype=np.float32)
        recall = None
    shared = docs.sparkSession.sparkContext.broadcast(models)
    scored = cut_lineage(log_weights(rows, shared, id_type), "importance-scores")
    shared.destroy()  # the scores are written; the driver keeps no model

    total, good = scored.agg(F.count(F.lit(1)), F.count(F.when(F.col("kind") < FOLDS, 1))).first()
    k = total
    if share is not None:
        k = round(share * total)
    elif recall is not None:
        least = kth_largest(scored.where(F.col("kind") < FOLDS), "log_weight", math.ceil(recall * good))
        k = scored.where(F.col("log_weight") >= F.lit(least)).count()
    uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = F.when(F.col("id").isNull(), 0.0).otherwise(-F.log(-F.log(uniform)))
    keyed = scored.select("id", "text_key", "n_words", "log_weight").withColumn("key", F.col("log_weight") + temperature * noise)
    cut = None
    if k < total:
        cut = kth_largest(keyed, "key", k) if k else math.inf
    kept = F.lit(True) if cut is None else F.col("key") >= F.lit(cut)
    return keyed.withColumn("kept", kept).withColumnRenamed("id", id_col)
