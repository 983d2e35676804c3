import random

import numpy as np

from panelsmith.llm import inner_topk, url_rules

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(inner_topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(inner_topk, "CANDIDATE_BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 32]) for i in rng.permutation(150)]
    rows += [(200, None), (220, [1.0, None]), (240, [float("nan")] * 6), (260, [float("inf")] * 6), (280, []), (300, [0.5, 1e12]), (None, [1.0]), rows[0]]
    got = inner_topk.inner_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i % 20 == 0, k=7)
    good = {i: [int(np.floor(np.float64(np.float32(x)) * 64)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:7]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == sorted(want)


def test_topk_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, score int")
    assert inner_topk.inner_topk(empty, lambda i: i % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert inner_topk.inner_topk(one, lambda i: i % 20 == 0).count() == 0


def brute_url(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for h, p, v in rules:
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            k = (len(h + p), len(h), h + p, v)
            best = k if best is None or k > best else best
    return host, path, best[2] if best else None, best[3] if best else default


def test_urls_equal_brute_force(spark):
    rng = random.Random(3)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "EXAMPLE.com", "xexample.com", "net", "m.net", "org", "example.com.", "", "a..net"]
    paths = ["", "/", "/en/", "/en/1", "/en", "/es/x", "/fr/", "/fr?x=/es/", "#/en/", "?q", "/fr/é", "/es//"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(600)]
    urls += [None, "", "example.com/en/", "http:/example.com/en/", "a://b://com/", "x://com/\n/en/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://m.net/es/"), (None, "http://m.net/es/"), (3, urls[3])]
    more = RULES + [("net", "/", "allow"), ("m.net", "/es/", "allow"), ("net", "/es/x", "block"), ("net", "/es/x", "allow"), (None, "/", "block"), ("org", None, "block"), ("", "/", "block")]
    for rules in (RULES, more):
        got = url_rules.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(rules, url_rules.RULES_SCHEMA))
        usable = [r for r in rules if r[0] and r[1] is not None]
        want = [(i, *brute_url(u, usable)) for i, u in rows]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_urls_no_rows(spark):
    rules = spark.createDataFrame(RULES, url_rules.RULES_SCHEMA)
    assert url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string, host string"), rules).count() == 0
    none = url_rules.judge_urls(spark.createDataFrame([(1, "a://b.c/d")], "page_id long, url string"), rules.limit(0))
    assert [tuple(r) for r in none.collect()] == [(1, "b.c", "/d", None, "allow")]
