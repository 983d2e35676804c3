import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelsmith.llm import merkle, queries
from panelsmith.session import cut_lineage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(level):
    """All levels of a tree over ``level``, the leaves first."""
    levels = [level]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest(*now[i : i + 16]) for i in range(0, len(now), 16)])
    return levels


def climb(levels, i, claimed):
    """Siblings on the way up from leaf i, and the digest its claim folds to."""
    proof, up = [], claimed
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        proof += run[: i % 16] + run[i % 16 + 1 :]
        up = digest(*run[: i % 16], up, *run[i % 16 + 1 :])
        i //= 16
    return proof, up


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> the expected rows of the query."""
    by_source = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        other = text.translate(str.maketrans(UPPER, UPPER.lower())) if hit else text
        leaf, claimed = (digest(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, other))
        by_source["" if source is None else "=" + source].append((doc_id is not None, doc_id or 0, leaf, doc_id, claimed))
    trees = {}
    for key in sorted(by_source, key=lambda k: k.encode()):
        by_source[key].sort(key=lambda x: x[:3])
        trees[key] = grow([x[2] for x in by_source[key]])
    top = grow([t[-1][0] for t in trees.values()])
    out = []
    for k, (key, levels) in enumerate(trees.items()):
        for i, (_, _, leaf, doc_id, claimed) in enumerate(by_source[key]):
            inner, up = climb(levels, i, claimed)
            outer, root = climb(top, k, up)
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], digest(*inner, *outer), root, root == top[-1][0]))
    return sorted(out, key=str)


def answer(docs, **kw):
    lower = F.translate("text", UPPER, UPPER.lower())
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower).otherwise(F.col("text"))
    manifest = merkle.build_manifest(docs, claimed={"text": claimed})
    got = merkle.verify(manifest, **kw).select(
        "id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified"
    )
    return manifest, sorted((tuple(r) for r in got.collect()), key=str)


def inputs(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("limit", [merkle.BROADCAST_NODES, 3])
def test_trees_of_many_heights(spark, limit):
    """Sources of 1, 16, 17, 256, 257 and 700 rows: whole and short runs, lone
    nodes above whole levels, few and all levels climbed by key."""
    sizes = {None: 1, "a": 16, "B": 17, "é": 256, "z": 257, "a/b": 700, "": 2}
    rows = [(i * 7 % 5003 + k * 10_000, f"Text {i} É of {s}", "en", s, i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    manifest, got = answer(docs, broadcast_nodes=limit)
    assert got == brute(rows) and any(not r[-1] for r in got) and any(r[-1] for r in got)
    assert manifest.root == got[0][3]
    # each node's digest is that of its children, and its parent holds it
    n, p = manifest.nodes.alias("n"), manifest.nodes.alias("p")
    at_parent = (F.col("n.up_tree") == F.col("p.tree")) & (F.col("n.up_level") == F.col("p.level")) & (F.col("n.up_pos") == F.col("p.pos"))
    held = n.join(p, at_parent).select((F.get("p.children", F.col("n.slot")) == F.col("n.hash")).alias("held"))
    assert manifest.nodes.where("hash <> sha2(array_join(children, ''), 256)").isEmpty()
    assert held.count() == manifest.nodes.count() - 1 and held.where("NOT held").isEmpty()


def test_one_source_and_one_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([(1, "A", "en", "s", 1)], [(i, f"T{i}", None, "s", None) for i in range(40)]):
        assert answer(spark.createDataFrame(rows, schema))[1] == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"Text {i}", "en", f"site{i % 300}", 1) for i in range(640)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert answer(docs)[1] == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    assert answer(odd_docs)[1] == brute(inputs(odd_docs))
    manifest, got = answer(no_docs)
    assert got == [] and manifest.root is None


def test_large_source_is_spread(spark):
    """The positions of one source come from many partitions."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        docs = spark.range(5000).select(F.lit("=s").alias("tree"), (F.col("id") * 7919 % 5000).alias("id"))
        dealt = docs.repartitionByRange("tree", "id").select(F.spark_partition_id().alias("p")).distinct().count()
        placed = merkle.positions(docs, [F.col("id")])
        assert dealt > 1 and placed.where("pos <> id OR n <> 5000").isEmpty() and placed.count() == 5000
    finally:
        spark.conf.set(coalesce, "true")


def test_query_is_the_operator(spark, tmp_path):
    rows = [(i, f"Text {i}", "en", f"s{i % 3}", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = cut_lineage(queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)), "t").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
