import random

import pytest

from panelsmith.llm import jaccard_join
from panelsmith.llm.components import connected_components


def brute(rows, n, num, den):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            linked = sets[i] and den * x >= num * (len(sets[i]) + len(sets[j]) - x)
            if linked and None not in (rows[i][0], rows[j][0]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n_docs=160):
    """Families of near copies around the threshold, a passage that many
    share, and copies."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, d = [], 0
    while len(rows) < n_docs:
        base = [rng.choice(vocab) for _ in range(rng.choice([2, 5, 20, 60, 200]))]
        if rng.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab).upper()
            rows.append((d, " ".join(copy)))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,num,den", [(1, 3, 90, 100), (2, 5, 80, 100), (3, 3, 50, 100)])
def test_equals_brute_force(spark, monkeypatch, seed, n, num, den):
    monkeypatch.setattr(jaccard_join, "HEAVY", 2)  # so that both levels are used
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "SLACK", 2)
    rows = corpus(seed)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, n, num, den)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = jaccard_join.jaccard_components(odd_docs, 3, 90, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows, 3, 90, 100)
    assert jaccard_join.jaccard_components(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (100, 101)]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}
