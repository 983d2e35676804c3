import random
import re

import pytest
from pyspark.sql import functions as F

from panelsmith.llm import license_scan, queries
from panelsmith.llm.license_scan import Template

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def brute(text, templates, phrases, num, den):
    words = words_of(text)
    places = [(label, i) for label, p in phrases for i in range(len(words)) if words_of(p) and words[i : i + len(words_of(p))] == words_of(p)]
    met = []
    for k, t in enumerate(templates):
        own = set(words_of(t.text))
        if not own:
            continue
        step = 8
        while step < len(words_of(t.text)):
            step *= 2
        for b in range(0, len(words), step):
            shared = len(own & set(words[b : b + 2 * step]))
            if den * shared >= num * len(own):
                met.append((k, b, t.label, shared, len(own)))
    return len(words), sorted(places), sorted(met)


def answer(docs, *args):
    found = license_scan.scan_licenses(docs, *args).collect()
    return [(r.doc_id, r.n_words, sorted(map(tuple, r.phrases)), [tuple(b) for b in r.blocks]) for r in found]


def same(docs, templates=license_scan.TEMPLATES, phrases=license_scan.PHRASES, num=90, den=100):
    want = [(r.doc_id, *brute(r.text, templates, phrases, num, den)) for r in docs.collect()]
    got = answer(docs, templates, phrases, num, den)
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_every_block_by_brute_force(spark):
    """Random words around whole, cut, torn and repeated notices."""
    draw = random.Random(5)
    vocabulary = ["the", "of", "and", "license", "is", "software", "cc", "by", "all", "rights", "reserved", "été", "日本", "x1", "general", "public"]
    rows = []
    for i in range(160):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([0, 3, 30, 200]))]
        notice = draw.choice(license_scan.TEMPLATES).text.split()
        drop = draw.choice([0, 0, 1, 2, 5])
        for _ in range(min(drop, len(notice) - 1)):
            notice.pop(draw.randrange(len(notice)))
        at = draw.randrange(len(words) + 1)
        rows.append((i % 150, draw.choice([" ", "\n", "-", " / "]).join([*words[:at], *notice * draw.choice([0, 1, 1, 3]), *words[at:]]).upper() if i % 3 else " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for num in (60, 90, 100):
        got = same(docs, num=num)
        assert any(r[3] for r in got) and any(r[2] for r in got)


def test_notice_across_blocks(spark):
    """A notice is met wherever it begins."""
    notice = license_scan.TEMPLATES[1].text
    docs = spark.createDataFrame([(i, "word " * i + notice + " word" * (300 - i)) for i in range(0, 300, 7)], "doc_id long, text string")
    got = answer(docs)
    assert all(any(b[2] == "mit" and b[3] == b[4] for b in r[3]) for r in got)
    same(docs)


def test_own_templates_and_phrases(spark):
    templates = (Template("a", "a b a b a b a b a"), Template("b", "b"), Template("none", " .. "), Template("long", " ".join(f"w{i}" for i in range(90))))
    phrases = (("aa", "a a"), ("none", "-"), ("b", "b"))
    texts = ["a a a", "b", "c", "", " ".join(f"W{i}" for i in range(85)), " ".join(f"w{i}" for i in range(80)), "a.b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    same(docs, templates, phrases)
    with pytest.raises(ValueError):
        license_scan.scan_licenses(docs, num=101)


def test_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("row", F.lit(1)).withColumn("blocks", F.lit("x")).withColumn("label", F.lit("x"))
    same(odd)
    assert same(no_docs) == []


def test_query_is_the_operator(spark, tmp_path):
    texts = ["Released under the MIT License. All rights reserved.", None, "CC BY and cc-by", "nothing here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in queries.QUERIES["op12_license_scans"](spark, str(tmp_path)).collect())
    assert got == [
        (0, 8, 1, 5, 5, "reserved", "mit,reserved", 1.0),
        (1, 0, 0, None, None, "", "", 0.0),
        (2, 5, 2, 0, 3, "cc-by", "cc-by", 0.0),
        (3, 2, 0, None, None, "", "", 0.0),
    ]
