import random

import pytest
from pyspark.sql import functions as F

from panelsmith.llm import token_spans as T


def brute(text, sections, rule, encoding):
    """Character span of each token, from the bytes of the tokens alone."""
    spans, at = [], 0
    data = text.encode()
    char = [len(data[:i].decode(errors="ignore")) for i in range(len(data) + 1)]
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        lo = max(i for i in range(at + 1) if i == 0 or (data[i:] and (data[i] & 0xC0) != 0x80)) if at < len(data) else at
        hi = at + size
        while hi < len(data) and (data[hi] & 0xC0) == 0x80:
            hi += 1
        spans.append((char[lo], len(data[:hi].decode())))
        at += size
    out = []
    for s, e in sections:
        s, e = min(max(s, 0), len(text)), min(max(e, 0), len(text))
        e = max(s, e)
        if rule == "first":
            n = sum(s <= a < e for a, b in spans)
        elif rule == "last":
            n = sum(s <= b - 1 < e for a, b in spans)
        else:
            n = sum(max(0, min(b, e) - max(a, s)) / (b - a) for a, b in spans)
        out.append((n, sum(a < s < b or a < e < b for a, b in spans)))
    return out, len(spans)


@pytest.mark.parametrize("rule", T.RULES)
def test_equals_brute_force(spark, rule):
    rng = random.Random(5)
    encoding, _ = T.load_encoding(T.VOCABULARY, T.PATTERN)
    alphabet = "abc  thé ing\nü😀漢字1 23.,"
    rows = []
    for i in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 7, 60])))
        spans = [(f"s{k}", a, a + rng.randrange(30)) for k, a in enumerate(rng.randrange(-3, 70) for _ in range(5))]
        rows.append((i if i % 7 else None, text, spans))
    docs = spark.createDataFrame(rows, f"doc_id long, body string, spans {T.SECTIONS}")
    got = T.count_section_tokens(docs, F.col("body"), F.col("spans"), rule).collect()
    assert len(got) == 5 * len(rows)
    want = []
    for i, text, spans in rows:
        counts, n = brute(text, [(a, b) for _, a, b in spans], rule, encoding)
        want += [(i if i % 7 else None, k, round(c, 6), x, n) if i is not None else (None, k, round(c, 6), x, n) for k, (c, x) in enumerate(counts)]
    assert sorted(((r.doc_id, r.section_no, round(float(r.n_tokens), 6), r.n_crossing, r.doc_tokens) for r in got), key=str) == sorted(
        ((a, b, float(c), d, e) for a, b, c, d, e in want), key=str
    )


def test_fields_and_lines(spark, odd_docs, no_docs):
    record, fields = T.field_record(["source", "lang", "text"])
    got = T.count_section_tokens(odd_docs, record, fields).collect()
    assert len(got) == 3 * odd_docs.count()
    for r in got:
        assert 0 <= r.n_tokens <= r.doc_tokens
    assert T.count_section_tokens(no_docs, record, fields).count() == 0
    docs = spark.createDataFrame([(1, "a\nbc\n"), (2, ""), (3, None)], "doc_id long, text string")
    lines = T.count_section_tokens(docs, F.col("text"), T.line_sections(F.col("text")))
    assert sorted((r.doc_id, r.section, r.start, r.end) for r in lines.collect()) == [
        (1, "line0", 0, 2), (1, "line1", 2, 5), (1, "line2", 5, 5), (2, "line0", 0, 0), (3, "line0", 0, 0),
    ]
    nulls = spark.createDataFrame([(1, "a b", None), (2, "a b", [None, ("x", None, 2), ("y", 0, 9)])], f"doc_id long, text string, s {T.SECTIONS}")
    assert [(r.doc_id, r.section, r.end) for r in T.count_section_tokens(nulls, F.col("text"), F.col("s")).collect()] == [(2, "y", 3)]
