import collections
import os
import random
import shutil
import subprocess
import sys
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelsmith.llm import decontaminate, mixing, queries
from panelsmith.session import cut_lineage, read_table
from test_jaccard_join import brute
from test_secrets_and_surrogates import brute as secret_spans

SMALL = "/root/testdata/sf0.001"


def edf(parts):
    """One round by simulation."""
    total, done, out = sum(parts), [0] * len(parts), []
    for t in range(total):
        ready = [(-(-(done[i] + 1) * total // a), i) for i, a in enumerate(parts) if done[i] * total // a <= t]
        i = min(ready)[1]
        done[i] += 1
        out.append(i)
    return out


def test_rounds_follow_earliest_deadline(spark):
    weights = {"a": 5, "b": 3, "c": 3, "d": 1}
    rows = [(i, s, "x" * 10) for i, s in enumerate(("a" * 50 + "b" * 30 + "c" * 21 + "d" * 9))]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights, 10).collect()
    slots = {r.slot: r for r in out}
    assert len(slots) == len(out) == len(rows)
    names = sorted(weights)
    for rounds in range(7):  # c gives out in its eighth round
        assert [names.index(slots[12 * rounds + t].mix_source) for t in range(12)] == edf([5, 3, 3, 1])
    for name, w in weights.items():
        share, seen = Fraction(w, 12), 0
        for t in range(84):
            seen += slots[t].mix_source == name
            assert abs(seen - share * (t + 1)) < 1
    for r in out:
        assert r.release <= r.slot < r.deadline and r.on_target == (r.slot < 84)


def test_mix_keeps_all_rows(spark, odd_docs, no_docs):
    out = mixing.mix_sources(odd_docs, {"src0": 2, "src1": 1}, 100, keep=("kept", "n", "text"))
    assert sorted(str((r.doc_id, r.source, r.kept, r.n, r.text)) for r in out.collect()) == sorted(
        str((r.doc_id, r.source, r.kept, r.n, r.text)) for r in odd_docs.collect()
    )
    assert mixing.mix_sources(no_docs, {"src0": 2}, 100).count() == 0
    for bad in ({}, {"a": 0}, {"a": 1.5}, {mixing.OTHER: 1}, {"a": mixing.MAX_PERIOD}):
        with pytest.raises(ValueError):
            mixing.mix_sources(odd_docs, bad, 100)


def test_mix_query_on_documents(spark):
    out = queries.QUERIES["op10_mix_sources"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: (r.source, len(r.text or "")) for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert len(out) == len(texts)
    per = collections.defaultdict(list)
    for r in out:
        per[r.mix_source].append(r)
    for name, rows in per.items():
        at = 0
        for r in sorted(rows, key=lambda r: (r.offset_chars, texts[r.doc_id][1])):
            assert r.offset_chars == at and r.slot >= r.release
            at += texts[r.doc_id][1]


def shingles(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_containment_equals_brute_force(spark):
    docs, items = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "benchmark")
    texts = {r.item_id: r.text for r in items.collect()}
    long = " ".join(f"w{i}" for i in range(20_000))
    planted = [(10_000 + i, f"{long} {t.upper()} {long}") for i, t in texts.items()]
    planted += [(20_000 + i, " ".join(t.split()[: max(1, len(t.split()) * 9 // 10)])) for i, t in texts.items()]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.contaminated(docs, items).collect()}
    want = {}
    sets = {i: shingles(t) for i, t in texts.items()}
    for r in docs.collect():
        s = shingles(r.text)
        for i, x in sets.items():
            if x and len(s & x) >= 0.8 * len(x):
                want[r.doc_id, i] = (len(s & x), len(x))
    assert got == want and len(want) > len(texts)


def test_short_items_equal_brute_force(spark):
    """Items of one to seven words, with repeats, at ends and inside."""
    rng = random.Random(5)
    word = lambda: rng.choice("what is the answer to it all ok".split())
    docs = [(i, " ".join(word() for _ in range(rng.randrange(0, 40)))) for i in range(200)]
    docs += [(900, None), (901, "What is\tthe ANSWER?"), (902, "whatis theanswer")]
    items = [(i, " ".join(word() for _ in range(i % 7 + 1))) for i in range(60)] + [(70, "what is the answer"), (71, ""), (72, None), (73, "xyz")]
    tables = [spark.createDataFrame(rows, f"{c} long, text string") for rows, c in ((docs, "doc_id"), (items, "item_id"))]

    def grams(text, n):
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    def found(least):
        want = set()
        for i, text in items:
            size = len((text or "").split())
            x = grams(text, min(size, 5)) if size else set()
            want |= {(d, i) for d, t in docs if size >= least and x and len(grams(t, min(size, 5)) & x) >= 0.8 * len(x)}
        return want

    for least in (1, 3):
        got = decontaminate.contaminated(*tables, least_words=least).collect()
        assert {(r.doc_id, r.item_id) for r in got} == found(least) and len(got) == len(found(least))
    assert (901, 70) in found(1) and (902, 70) not in found(1)


def test_containment_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "three four five six seven"), (1, "words of the other kind are here"), (None, "one two three four five"), (2, "two words"), (3, None)], "item_id long, text string").withColumn("h", F.lit(1))
    got = decontaminate.contaminated(odd_docs, items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted([(a, b) for a in (1, 2, None) for b in (1, None)] + [(8, 2)], key=str)
    assert decontaminate.contaminated(no_docs, items).count() == decontaminate.contaminated(odd_docs, items.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = read_table(spark, SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "secrets", "mix"]
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r for r in read_table(spark, SMALL, "labels").collect()}
    good = cut_lineage(stages["quality"](spark, docs, SMALL), "t")
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert len(kept & set(clean)) >= 0.97 * len(clean) and good.columns == docs.columns

    single = cut_lineage(stages["near_duplicates"](spark, good, SMALL), "t")
    left = [(i, rows[i].text) for i in kept]
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _, c in brute(left, 5, 80, 100) if c == d)

    pure = cut_lineage(stages["decontamination"](spark, single, SMALL), "t")
    items = [shingles(r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    leaks = lambda t: any(x and len(shingles(t) & x) >= 0.8 * len(x) for x in items)
    assert sorted(r.doc_id for r in pure.collect()) == sorted(r.doc_id for r in single.collect() if not leaks(r.text))

    safe = cut_lineage(stages["secrets"](spark, pure, SMALL), "t")
    assert safe.count() == pure.count() and safe.columns == docs.columns
    for r in safe.collect():
        assert not secret_spans(r.text) and r.n_chars == len(r.text)
        assert secret_spans(rows[r.doc_id].text) or r.text == rows[r.doc_id].text

    mixed = stages["mix"](spark, safe, SMALL)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in safe.collect())


def test_pipeline_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "kept", "n")
    left = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    # one of the exact repeats stays; the null ids and the texts without words do
    assert sorted(((r.doc_id, str(r.text)[:3]) for r in left), key=str) == sorted(
        [(1, "one"), (1, "ano"), (3, "Non"), (4, ""), (None, "one"), (None, "Non"), (5, "w0x"), (7, " \t\n"), (8, "two")], key=str
    )
    for docs in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, SMALL), "odd")


def test_repository_works_without_the_subpackage(tmp_path):
    """The working tree without this subpackage, its tests and the pipeline:
    queries register, and the other tests collect and their contract holds."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json", ".pytest_cache", ".hypothesis")
    shutil.copytree(repo, tmp_path / "repo", ignore=left_out)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'panel' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)
    pytest_run = [sys.executable, "-m", "pytest", "-q", "-x", "-p", "no:cacheprovider"]
    subprocess.run([*pytest_run, "tests", "--collect-only"], cwd=tmp_path / "repo", check=True, timeout=300)
    subprocess.run([*pytest_run, "tests/test_functions.py", "tests/test_contract.py"], cwd=tmp_path / "repo", check=True, timeout=600)
