import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from panelsmith.llm import divergence, queries
from panelsmith.llm.perfect_hash import Shards, build, hash_terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, min_docs=3, ranks=200):
    """Rows (text, lang, source) -> the expected result."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(str.maketrans(UPPER, UPPER.lower())))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = collections.Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= min_docs]
        counts = {s: collections.Counter() for s in {d[1] for d in mine}}
        for _, s, terms in mine:
            counts[s].update(t for t in terms if held[t] >= min_docs)
        counts_all = sum(counts.values(), collections.Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(counts_all)
        for s in counts:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])]
    return sorted(out)


def same(docs, **kw):
    want = brute([(r.text, r.lang, r.source) for r in docs.collect()], **{k: v for k, v in kw.items() if k != "batch_bytes"})
    got = sorted(tuple(r[c] for c in COLUMNS) for r in divergence.audit_sources(docs, **kw).collect())
    assert got == want
    return got


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    words = [f"{draw.choice('abcdé')}{draw.choice('xyzßÉ')}{draw.choice('日klmn')}{'q' * draw.randrange(4)}" for _ in range(400)]
    rows = []
    for i in range(240):
        own = words[: draw.choice([20, 200, 400])]
        text = draw.choice([" ", "\n", "1", "-"]).join(draw.choice(own) for _ in range(draw.choice([0, 5, 80])))
        rows.append((text.upper() if i % 5 == 0 else text, draw.choice(["en", "de", "xx", None]), draw.choice(["a", "b", "É", "z", None, "a"])))
    rows += [("once", "rare", "s1"), ("twice", "rare", "s2"), (None, "rare", "s3"), ("word word word", "single", "s")]
    return spark.createDataFrame(rows, "text string, lang string, source string")


def test_all_parts_by_brute_force(corpus):
    got = same(corpus)
    assert {r[2] for r in got} == {"pair", "term"}
    assert [r[3:5] for r in got if r[0] == "rare" and r[1] == "s1"] == [("s2", 0), ("s3", 0)]
    same(corpus, min_docs=1, ranks=3)


def test_small_bounds_give_the_same(corpus, monkeypatch):
    """Many shards, many broadcast rounds, few counters, small merges; the
    tasks import the module anew, so bounds of theirs are set by size alone."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", 64)
    monkeypatch.setattr(divergence, "SHARD_CELLS", 64)
    monkeypatch.setattr(divergence, "MERGE_TASKS", 2)
    same(corpus.repartition(7), batch_bytes=4000)


def test_counters_are_written_out_when_full(monkeypatch):
    monkeypatch.setattr(divergence, "DENSE_CELLS", 5)
    terms = pa.array(["a", "b", "c"], pa.large_string())
    levels, slots = build(hash_terms(terms))
    order = np.argsort(slots)
    shards = Shards([(levels, terms.take(pa.array(order)))])
    counters = divergence._Counters({"en": (shards, np.array([0]))}, 0)
    begin = counters.row("en", "s")
    counters.cells[begin + slots] += np.array([1, 0, 2], dtype=np.int32)
    assert not counters.is_full("en", "s") and counters.is_full("en", "t")
    (batch,) = counters.flush()
    (row,) = batch.to_pylist()
    assert dict(zip(row["slots"], row["counts"])) == {int(slots[0]): 1, int(slots[2]): 2} and not counters.is_full("en", "t")
    assert list(counters.flush()) == []


def test_perfect_hash_is_minimal_and_exact():
    terms = pa.array([f"term{i}é" for i in range(30_000)], pa.large_string())
    hashes = hash_terms(terms)
    third = np.arange(len(terms)) % 3
    shards, placed = [], []
    for k in range(3):
        own = np.flatnonzero(third == k)
        levels, slots = build(hashes[own])
        assert sorted(slots.tolist()) == list(range(len(own)))
        order = np.empty(len(own), dtype=np.int64)
        order[slots] = own
        shards.append((levels, terms.take(pa.array(order))))
        placed.append(order)
    loaded = Shards(shards)
    slots = loaded.lookup(third, hashes, terms)
    assert (np.concatenate(placed)[slots] == np.arange(len(terms))).all()
    bits = sum(64 * len(b) for levels, _ in shards for b in levels)
    assert bits < 4 * len(terms)
    # unknown terms have no slot, nor has a known term in another shard
    others = pa.array([f"other{i}" for i in range(5000)], pa.large_string())
    assert (loaded.lookup(np.arange(5000) % 3, hash_terms(others), others) == -1).all()
    assert (loaded.lookup((third + 1) % 3, hashes, terms) == -1).all()


def test_equal_hashes_are_told_apart():
    terms = pa.array(["a", "b", "c", "d"], pa.large_string())
    hashes = np.array([7, 7, 9, 7], dtype=np.uint64)
    levels, slots = build(hashes)
    assert sorted(slots.tolist()) == [0, 1, 2, 3]
    order = np.argsort(slots)
    loaded = Shards([(levels, terms.take(pa.array(order)))])
    assert loaded.lookup(np.zeros(4, dtype=np.int64), hashes, terms).tolist() == slots.tolist()
    other = pa.array(["e"], pa.large_string())
    assert loaded.lookup(np.zeros(1, dtype=np.int64), hashes[:1], other).tolist() == [-1]


def test_shares_are_exact_at_any_count():
    counts = np.array([0, 1, 10**6, 5 * 10**10], dtype=np.int64)
    for n in (10**6, 9 * 10**9, 10**11):
        assert divergence.smoothed(counts, n, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (n + 7) for c in counts] or n < counts.max()


def test_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.selectExpr("*", "1 AS term", "2 AS shard", "'x' AS item", "3 AS value", "4 AS rank", "5 AS part")
    same(odd, min_docs=1)
    same(odd)
    assert same(no_docs) == []


def test_query_is_the_operator(spark, corpus, tmp_path):
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_source_divergence"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == brute([(r.text, r.lang, r.source) for r in corpus.collect()])
