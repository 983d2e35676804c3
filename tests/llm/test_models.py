import collections
import ctypes
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelsmith.llm import importance, pitman_yor
from panelsmith.llm import words as W
from panelsmith.llm.queries import held_out
from panelsmith.session import read_table

SMALL = "/root/testdata/sf0.001"


def quality_rows(seed=4, n=700):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 300]))]
        kind = rng.choice(["good", "good", "good", "loud", "rude"])
        if kind == "loud":
            words = [w.upper() + "!!" for w in words]
        if kind == "rude":
            for k in range(0, len(words), 25):
                words[k] = rng.choice(["vilest", "wretch", "dolt"])
        docs.append((i, " ".join(words), kind))
        if i % 2 == 0:
            labels.append((i, int(kind != "loud"), int(kind == "rude")))
    return docs, labels


def test_quality_on_held_out_documents(spark):
    docs, labels = quality_rows()
    got = importance.select_quality(
        spark.createDataFrame(docs, "doc_id long, text string, kind string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()
    assert len(got) == len(docs)
    kept = {r.doc_id: r.kept for r in got}
    share = {k: np.mean([kept[i] for i, _, kind in docs if kind == k and i % 2]) for k in ("good", "loud", "rude")}
    assert share["good"] > 0.98 and share["loud"] < 0.02 and share["rude"] < 0.1


def test_raw_text_of_no_labelled_kind_is_dropped(spark):
    docs, labels = quality_rows()
    rng = random.Random(8)
    vocab = ["".join(rng.choice("mnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    docs += [(10_000 + i, " ".join(rng.choice(vocab) for _ in range(80)), "junk") for i in range(100)]  # none labelled
    got = importance.select_quality(
        spark.createDataFrame(docs, "doc_id long, text string, kind string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()
    kept = {r.doc_id: r.kept for r in got}
    share = {k: np.mean([kept[i] for i, _, kind in docs if kind == k and i % 2 + (k == "junk")]) for k in ("good", "loud", "rude", "junk")}
    assert share["junk"] < 0.05 and share["good"] > 0.95


def test_quality_top_k_and_edges(spark, odd_docs, no_docs):
    docs, labels = quality_rows(n=200)
    frame = spark.createDataFrame(docs, "doc_id long, text string, kind string")
    marks = spark.createDataFrame(labels + [(None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    got = importance.select_quality(frame, marks, share=0.4).collect()
    keys = sorted((r.key for r in got), reverse=True)
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in got if r.key >= keys[79]} and sum(r.kept for r in got) == 80
    assert importance.select_quality(odd_docs, marks.limit(0)).where("kept").count() == odd_docs.count()
    assert importance.select_quality(odd_docs, marks).count() == odd_docs.count()
    assert importance.select_quality(no_docs, marks).count() == 0


def test_quality_weights_by_brute_force(spark):
    """Each weight from sets of hashed n-grams, counted and weighed one by one."""
    docs, labels = quality_rows(n=120)
    n_buckets, folds = 1 << 12, importance.FOLDS
    frame = spark.createDataFrame(docs, "doc_id long, text string, kind string")
    got = {r.doc_id: r for r in importance.select_quality(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), n_buckets=n_buckets).collect()}
    sets = {}
    for i, text, _ in docs:
        bucket, _ = importance.features(W.split_words(pa.array([text], pa.large_string()), lower=False), n_buckets)
        assert len(bucket) == len(set(bucket.tolist()))
        sets[i] = set(bucket.tolist())
    good = {i: got[i].text_key % folds for i, quality, toxic in labels if quality and not toxic}
    n = collections.Counter(b for s in sets.values() for b in s)

    def log_split(c, of, a, b):
        return sum(math.log(a + j) for j in range(c)) + sum(math.log(b + j) for j in range(of - c)) - sum(math.log(a + b + j) for j in range(of))

    for i in sets:
        target = collections.Counter(b for j, f in good.items() if f != good.get(i) for b in sets[j])
        s, want = target.total() / n.total(), 0.0
        for b in sets[i]:
            own, chance = log_split(target[b], n[b], s, 1 - s), log_split(target[b], n[b], importance.CLUMPS * s, importance.CLUMPS * (1 - s))
            odds = importance.SPECIAL * math.exp(own - chance)
            want += odds / (1 + odds) * math.log((target[b] + s) / ((n[b] + 1) * s))
        assert got[i].log_weight == pytest.approx(want, rel=1e-4, abs=1e-4)
    weights = sorted((got[i].log_weight for i in good), reverse=True)
    k = sum(r.log_weight >= weights[math.ceil(importance.RECALL * len(weights)) - 1] for r in got.values())
    assert {i for i, r in got.items() if r.kept} == set(sorted(got, key=lambda i: -got[i].key)[:k])


def test_runs_of_equal_words_are_ngrams():
    lengths = [3, 4, 15, 16, 1, 0]
    texts = pa.array(["b " + " ".join(["a"] * n) + " b a" for n in lengths], pa.large_string())
    bucket, text = importance.features(W.split_words(texts, lower=False), 1 << 20)
    for k in importance.RUNS:
        run = int(W.mix(np.array([k], dtype="u8"))[0] % np.uint64(1 << 19))
        assert text[bucket == run].tolist() == [i for i, n in enumerate(lengths) if n >= k]


@pytest.mark.parametrize("k", [1, 2, 50, 999, 1000, 1001])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([0.0, -1e9, 5.5, rng.gauss(0, 1), 1e-12 * rng.random()]) for _ in range(1000)]
    got = importance.kth_largest(spark.createDataFrame([(v,) for v in values], "v double"), "v", k)
    assert got == (sorted(values, reverse=True)[k - 1] if k <= 1000 else None)


def base_scores(rows):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    out = [zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows]
    counts = collections.Counter(w for (_, x), h in zip(tokens, out) if not h for w in x)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        ((i, h, len(x), sum(counts[w] > 0 for w in x), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x), 5)) for (i, x), h in zip(tokens, out)),
        key=str,
    )


def check_base(spark, docs):
    got = pitman_yor.score_texts(docs, held_out("doc_id")).collect()
    want = base_scores([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=str) == want
    return got


def test_scores_on_documents(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 20_000)  # several buckets
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 9_000)
    monkeypatch.setattr(pitman_yor, "GROUP_BYTES", 60_000)  # and groups in some
    got = check_base(spark, read_table(spark, SMALL, "documents"))
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    again = pitman_yor.score_texts(read_table(spark, SMALL, "documents"), held_out("doc_id")).collect()
    assert {r.doc_id: round(r.score, 6) for r in got} == {r.doc_id: round(r.score, 6) for r in again}


def test_scores_odd_rows(spark, odd_docs, no_docs):
    check_base(spark, odd_docs)
    assert pitman_yor.score_texts(no_docs, held_out("doc_id")).count() == 0
    none = pitman_yor.score_texts(odd_docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in none)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    words, contexts = rng.integers(1, 60, 4000).astype("u8"), rng.integers(0, 40, 4000).astype("u2")
    state = pitman_yor.Seating(*pitman_yor._sum_pairs(words, contexts, np.ones(4000, dtype=np.int64)))
    m = None
    for _ in range(3):
        rows = state.totals()
        m = pitman_yor.Totals({(a, i): (n, t) for a, i, n, t in rows if a >= 0}, {-1 - a: (n, t) for a, _, n, t in rows if a < 0}, len(state.words))
        state.sweep(m, [pitman_yor.log_stirling(d) for d in m.d], rng)
    rows = state.totals()
    m = pitman_yor.Totals({(a, i): (n, t) for a, i, n, t in rows if a >= 0}, {-1 - a: (n, t) for a, _, n, t in rows if a < 0}, len(state.words))
    vocabulary = np.append(state.words, np.uint64(10**9))  # and one unknown word
    for u in (0, 7, 39, 900):
        p = pitman_yor.probabilities(state, state.predict(m), m, vocabulary, np.full(len(vocabulary), u, dtype="u2"))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_seating_follows_the_exact_conditional():
    rng, d, weight, c = np.random.default_rng(0), 0.4, 0.7, 5
    stirling = pitman_yor.log_stirling(d)
    got = np.bincount(pitman_yor.seat(np.full(40_000, c), np.full(40_000, weight), d, stirling, rng), minlength=c + 1)[1:] / 40_000
    want = np.exp(stirling[c, 1 : c + 1]) * weight ** np.arange(1, c + 1)
    assert np.abs(got - want / want.sum()).max() < 0.01
    assert stirling[3, 2] == pytest.approx(math.log(3 * (1 - d)))


def test_scores_know_both_preceding_words(spark):
    rng = random.Random(1)
    texts = [f"a{a} b{b} c{(7 * a + b) % 50}" for a, b in ((rng.randrange(20), rng.randrange(60)) for _ in range(3000))]
    first, second, third = texts[0].split()
    other = f"{first} {second} c{(int(third[1:]) + 7) % 50}"  # the word is usual after the last word alone
    docs = spark.createDataFrame([*((i, t, False) for i, t in enumerate(texts)), (-1, texts[0], True), (-2, other, True)], "doc_id long, text string, h boolean")
    got = {r.doc_id: r.score for r in pitman_yor.score_texts(docs, F.col("h")).where("doc_id < 0").collect()}
    assert got[-1] - got[-2] > 0.8


def test_every_context_has_its_restaurant():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 2**63, 5000).astype("u8")[rng.integers(0, 5000, 40_000)]
    unique, v, x, w, _ = pitman_yor._triples(words, np.zeros(len(words), dtype=np.int64))
    first = np.flatnonzero(pitman_yor._is_first(v, x, w))
    blob = pitman_yor.pack_triples(unique, v[first], x[first], w[first], np.diff([*first, len(v)]))
    state = pitman_yor.Seating.of(*pitman_yor.merge_counts([blob, blob]))
    assert len(state.parents) == len(set(words[:-1].tolist())) + 1  # and the start
    assert len(state.contexts) == len(set(zip(words[:-2].tolist(), words[1:-1].tolist()))) + 2
    assert state.n.sum() == 2 * len(words)
    rows = state.totals()
    m = pitman_yor.Totals({(0, 0): rows[0][2:]}, {-1 - a: (n, t) for a, _, n, t in rows[1:]}, len(state.words) - 1)
    seen = np.flatnonzero(state.context == 7)
    everything = np.append(unique[unique != pitman_yor._START], np.uint64(3))
    contexts = np.full(len(everything), state.contexts[7])
    p = pitman_yor.probabilities(state, state.predict(m), m, everything, contexts)
    assert abs(p.sum() - 1) < 1e-9 and p[np.searchsorted(everything[:-1], state.words[state.pairs[seen] % len(state.words)])].sum() > 0.3


def test_triples_are_stored_once(spark, monkeypatch):
    """op9: words with numbers come back in order, merged triples keep the
    place of each chunk's own, and the texts are read once to be scored."""
    draw = np.random.default_rng(5)
    words = np.append(draw.integers(0, 1 << 62, 300, dtype=np.uint64)[draw.integers(0, 300, 2000)], pitman_yor._END)
    unique, v, x, w, doc = pitman_yor._triples(words, np.zeros(len(words), dtype=np.int64))
    first = np.flatnonzero(pitman_yor._is_first(v, x, w))
    runs = np.diff([*first, len(v)])
    plain = pitman_yor.pack_triples(unique, v[first], x[first], w[first], runs, runs, doc)
    coded = np.sort(np.append(draw.permutation(unique)[:200], np.uint64(12)))
    blob = pitman_yor.pack_triples(unique, v[first], x[first], w[first], runs, runs, doc, coded=coded)
    got = pitman_yor.unpack_tokens(blob, coded)
    assert len(blob) < len(plain) and all(np.array_equal(a, b) for a, b in zip(got, pitman_yor.unpack(plain, *pitman_yor.COUNTS, "u4", "u4")))
    part = [c[: len(c) // 2] for c in got[1:5]]
    merged, places = pitman_yor.merge_triples([[got[0], *part], got])
    for (_, *own), at in zip(([got[0], *part], got), places):
        assert all(np.array_equal(m[at], o) for m, o in zip(merged[1:4], own[:3]))

    read = []
    chunks = pitman_yor._stored_triples
    monkeypatch.setattr(pitman_yor, "_stored_triples", lambda *a: read.append(chunks(*a)) or read[-1])
    docs = spark.range(0, 40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b"), F.col("id") % 7, F.lit("c")).alias("text"))
    scored = pitman_yor.score_texts(docs, F.col("doc_id") % 4 == 1)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert len(read) == 1 and "Range (" not in plan and scored.count() == 40


def test_stored_triples_are_scored_where_they_lie(spark, monkeypatch):
    """op9: only what the root sends is shuffled to the buckets, and what
    shuffles grows with the text: no doubled number of ranges, no large
    numbers for words and scores."""
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 20_000)
    scored = pitman_yor.score_texts(read_table(spark, SMALL, "documents"), held_out("doc_id"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(bucket") == 1 and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if "hpy" in t.name]
    got = scored.collect()  # although the catalog has let go of the table
    assert len({r.doc_id for r in got}) == len(got) == read_table(spark, SMALL, "documents").count()

    words = np.arange(0, 1 << 64, 1 << 56, dtype=np.uint64)
    buckets, starts, ends = pitman_yor._bucket_cuts(words, 5)
    assert buckets == [0, 1, 2, 3, 4] and {b - a for a, b in zip(starts, ends)} == {51, 52}

    draw = np.random.default_rng(3)
    words = draw.integers(0, 1 << 62, 5000, dtype=np.uint64)[draw.integers(0, 5000, 20_000)]
    unique, v, x, w, doc = pitman_yor._triples(words, np.zeros(len(words), dtype=np.int64))
    ones = np.ones(len(v), dtype=np.int64)
    blob = pitman_yor.pack_triples(unique, v, x, w, ones, coded=unique)
    plain = pitman_yor.pack(unique, *[c.astype("u4") for c in (v, x, w, ones)])
    assert len(blob) < 0.7 * len(plain)
    assert all(np.array_equal(a, b) for a, b in zip(pitman_yor.unpack_tokens(blob, unique, pitman_yor.CODED_COUNTS), (unique, v, x, w, ones)))


def _held_mb() -> float:
    pages = [line for line in open("/proc/self/status") if line.startswith("RssAnon")]
    return int(pages[0].split()[1]) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs glibc")
def test_free_memory_goes_back_to_the_system():
    """pipeline, op9: what a task has freed does not stay with its worker."""
    before, parts = _held_mb(), [np.ones(8000) for _ in range(4000)]  # too small to be mapped each
    pinned = np.ones(8000)  # keeps the end of the heap
    assert _held_mb() > before + 200
    parts.clear()
    W.release_memory()
    assert _held_mb() < before + 100 and pinned.all()


def test_texts_are_split_in_small_chunks():
    batch = pa.RecordBatch.from_pydict({"text": ["a b " * 50_000] * 6})
    got = [p.num_rows for p in W.chunks(batch, "text")]
    assert got == [2, 2, 2]


def test_seats_of_single_customers_take_no_draw():
    """op9: only words with several customers in a restaurant are sampled."""
    n = np.array([1, 5, 0, 2, 40, 1], dtype=np.uint32)
    weight = np.array([0.0, 0.5, 0.0, 0.5, 0.5, 0.0])  # its log would warn
    with np.errstate(divide="raise"):
        t = pitman_yor.seat(n, weight, 0.5, pitman_yor.log_stirling(0.5), np.random.default_rng(1))
    assert t.dtype == np.uint32 and t[[0, 2, 5]].tolist() == [1, 0, 1] and (t <= n).all() and (t[[1, 3, 4]] > 0).all()
