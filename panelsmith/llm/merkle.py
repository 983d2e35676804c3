"""Merkle manifest of a table: one tree per source, one tree over their roots.

A leaf is the hash of a row's fields. The leaves of a source stand in the order
of their id; every ``FANOUT`` consecutive nodes become the hash of their joined
digests, until one node, the source's root, remains. The sources' roots, in the
order of the sources, are the leaves of the last tree.

Levels are built from the bottom by one aggregate each and stored as node rows
that carry their children and the key of their parent. A row is verified by a
recursive query over the stored nodes: each leaf ascends from its run to the
root, takes the digests of its siblings on the way and folds its own, claimed,
digest into the node above. The leaves of one run have the same nodes above
them, so they ascend as one row that holds a folded digest for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelsmith.session import cut_lineage

#: Children of a node.
FANOUT = 16
#: Key of the tree over the sources' roots. A source's key is "=" and its
#: name, a null source's is empty, so that keys sort as the sources do.
TOP = "/"
#: Nodes (of about 1 KB each) up to which the upper levels are broadcast; the
#: levels below are joined by key.
BROADCAST_NODES = 4096
#: Low bits of monotonically_increasing_id that count rows inside a partition.
PLACE_BITS = 33
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field_text(value: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its length in UTF-8
    bytes, a colon and the value (integers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


@dataclass
class Manifest:
    """``runs``: tree, run, members (array of id, leaf, claimed by position),
    is_lone and the key of the run's parent. ``nodes``: one row per inner
    node above the runs: tree, level, pos, hash, children, subroot (the hash,
    in the topmost node of a source), up_tree, up_level, up_pos, slot (the key
    of the parent and the place in it; null in the root)."""

    runs: DataFrame
    nodes: DataFrame
    root: str | None


def positions(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 inside their ``tree``, and
    ``n``, the rows of the tree.

    Rows are dealt to range partitions of (tree, order) and numbered inside
    them; what precedes a partition comes from a table of counts per tree and
    partition, so that a large tree is spread over many tasks."""
    keys = [F.col("tree"), *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__place", F.monotonically_increasing_id())
    dealt = cut_lineage(dealt, "merkle-order")
    part, place = F.shiftright("__place", PLACE_BITS), F.col("__place").bitwiseAND((1 << PLACE_BITS) - 1)
    dealt = dealt.withColumns({"__part": part, "__place": place})
    per_part = dealt.groupBy("tree", "__part").agg(F.min("__place").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        "tree",
        "__part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    starts = cut_lineage(starts, "merkle-starts")
    return (
        dealt.join(starts, ["tree", "__part"]).withColumn("pos", F.col("__place") + F.col("shift")).drop("__part", "__place", "shift")
    )


def _levels_above(bottom: DataFrame, largest: int, level: int) -> list[DataFrame]:
    """Tables of nodes (tree, level, pos, hash, children, n) above ``bottom``
    (tree, pos, hash, n), whose largest tree has ``largest`` nodes; n is the
    number of nodes of the tree in that level. Trees of one node rest."""
    out = []
    while largest > 1:
        level += 1
        up = bottom.where("n > 1").groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"))
        up = up.agg(F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("c"), F.first("n").alias("n"))
        up = up.withColumn("children", F.col("c.hash"))
        bottom = cut_lineage(
            up.select(
                "tree",
                F.lit(level).alias("level"),
                "pos",
                F.sha2(_joined(F.col("children")), 256).alias("hash"),
                "children",
                F.ceil(F.col("n") / FANOUT).alias("n"),
            ),
            "merkle-level",
        )
        out.append(bottom)
        largest = -(-largest // FANOUT)
    return out


def _link(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """Parent keys of ``nodes`` (tree, level, pos, n): the run of 16 in the
    level above, or for the only node of a source its run in the tree of the
    roots, from ``places`` (tree, top_pos, n_top)."""
    only, leads = F.col("n") == 1, F.col("n_top") > 1
    place = F.when(~only, F.col("pos")).when(leads, F.col("top_pos"))
    linked = nodes.join(places, "tree", "left")
    return linked.withColumns(
        {
            "up_tree": F.when(~only, F.col("tree")).when(leads, F.lit(TOP)),
            "up_level": F.when(~only, F.col("level") + 1).when(leads, F.lit(1)),
            "up_pos": F.floor(place / FANOUT),
            "slot": (place % FANOUT).cast("int"),
        }
    ).drop("top_pos", "n_top")


def build_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    tree_col: str = "source",
) -> Manifest:
    """The stored trees of ``docs``. A row's leaf is the hash of ``fields``;
    ``claimed`` replaces fields (by expressions over the columns of ``docs``)
    in a second digest per row, the one to be verified.

    Nulls in any column have their own digest; null ids come first in their
    source, and the null source comes first. Rows that repeat an id stand by
    their leaf digest; repeated rows are leaves each. Texts are hashed whole,
    whatever their length. Columns that are not named are not read, and names
    cannot clash. An empty table has no runs, no nodes and no root."""
    own = [F.col(f) for f in fields]
    other = [(claimed or {}).get(f, F.col(f)) for f in fields]
    source = F.col(tree_col).cast("string")
    leaves = docs.select(
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf_hash(own).alias("leaf"),
        leaf_hash(other).alias("claimed"),
    )
    # the texts are read once: what follows works on the digests
    leaves = leaves.withColumn("claimed", F.when(F.col("claimed") != F.col("leaf"), F.col("claimed")))
    leaves = positions(cut_lineage(leaves, "merkle-leaves"), [F.col("id").asc_nulls_first(), F.col("leaf")])

    member = F.struct("pos", "id", "leaf", F.coalesce("claimed", "leaf").alias("claimed"))
    runs = leaves.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("run"))
    runs = runs.agg(F.sort_array(F.collect_list(member)).alias("members"), F.first("n").alias("n_leaves"))
    runs = cut_lineage(runs.withColumn("is_lone", F.col("n_leaves") == 1), "merkle-runs")
    digests = F.col("members.leaf")
    bottom = runs.select(
        "tree",
        F.lit(1).alias("level"),
        F.col("run").alias("pos"),
        F.when(F.col("is_lone"), digests[0]).otherwise(F.sha2(_joined(digests), 256)).alias("hash"),
        F.ceil(F.col("n_leaves") / FANOUT).alias("n"),
    )
    most = bottom.agg(F.max("n")).first()[0]
    levels = _levels_above(bottom, most or 0, 1)
    per_source = [b.where("n = 1").select("tree", "hash") for b in [bottom, *levels]]
    subroots = per_source[0]
    for s in per_source[1:]:
        subroots = subroots.unionByName(s)

    # the tree of the sources' roots, in the order of the sources
    tops = positions(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "hash"), [F.col("of")])
    tops = cut_lineage(tops, "merkle-tops")
    n_tops = tops.count()
    top_levels = _levels_above(tops.select("tree", "pos", "hash", "n"), n_tops, 0)
    places = tops.select(F.col("of").alias("tree"), F.col("pos").alias("top_pos"), F.col("n").alias("n_top"))

    columns = ("tree", "level", "pos", "hash", "children", "subroot", "up_tree", "up_level", "up_pos", "slot")
    tables = [
        _link(t, places).withColumn("subroot", F.when((F.col("n") == 1) & (F.col("tree") != TOP), F.col("hash"))).select(*columns)
        for t in [*levels, *top_levels]
    ]
    nodes = tables[0] if tables else _link(bottom, places).withColumns({"children": F.array(F.col("hash")), "subroot": F.col("hash")}).select(*columns).limit(0)
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    nodes = cut_lineage(nodes, "merkle-nodes")
    last = top_levels[-1] if top_levels else tops
    found = last.select("hash").first()
    linked = _link(bottom, places).select(
        "tree", F.col("pos").alias("run"), "hash", F.when(F.col("n") == 1, F.col("hash")).alias("subroot"), "up_tree", "up_level", "up_pos", "slot"
    )
    return Manifest(runs.join(linked, ["tree", "run"]), nodes, found[0] if found else None)


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree, run, members, folded, above, subroot, here, up_tree, up_level, up_pos, slot, is_last FROM {below}
  UNION ALL
  SELECT c.tree, c.run, c.members,
    transform(c.folded, f -> sha2(concat(array_join(slice(n.children, 1, c.slot), ''), f, array_join(slice(n.children, c.slot + 2, {fanout}), '')), 256)),
    concat(c.above, array_join(slice(n.children, 1, c.slot), ''), array_join(slice(n.children, c.slot + 2, {fanout}), '')),
    coalesce(c.subroot, n.subroot), n.hash, n.up_tree, n.up_level, n.up_pos, n.slot, n.is_last
  FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos
  WHERE NOT c.is_last
)
SELECT * FROM climb WHERE is_last
"""


def _climb(below: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ascend every row of ``below`` through ``nodes`` up to the node marked
    ``is_last``."""
    spark = below.sparkSession
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")  # rows grow with the table, rounds with its logarithm
    try:
        return cut_lineage(spark.sql(_CLIMB, below=below, nodes=nodes, fanout=FANOUT), "merkle-climb")
    finally:
        spark.conf.set(ROW_LIMIT, limit)


def verify(manifest: Manifest, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """One row per row of the table: id, leaf, subroot, root, siblings (the
    joined digests of the proof, level by level from the leaf's run to the
    root, left to right), folded_root (the root recomputed from the claimed
    digest and the siblings) and verified (whether it is the root).

    The lowest levels are joined by key. Above the level from which at most
    ``broadcast_nodes`` nodes remain, many runs meet in few nodes: those are
    broadcast, so that no key gathers rows."""
    runs, nodes = manifest.runs, manifest.nodes
    leaves, claims = F.col("members.leaf"), F.col("members.claimed")
    own = F.sequence(F.lit(0), F.size("members") - 1)
    fold = F.transform(own, lambda i: F.sha2(F.concat(_joined(F.slice(leaves, 1, i)), claims[i], _joined(F.slice(leaves, i + 2, FANOUT))), 256))
    below = runs.select(
        "tree",
        "run",
        "members",
        F.when(F.col("is_lone"), claims).otherwise(fold).alias("folded"),
        F.lit("").alias("above"),
        "subroot",
        F.col("hash").alias("here"),
        "up_tree",
        "up_level",
        "up_pos",
        "slot",
    )
    # node counts by level: a few rows; the tree of the roots is above all
    height = F.when(F.col("tree") == TOP, F.col("level") + 1000).otherwise(F.col("level"))
    counts = sorted((r[0], r[1]) for r in nodes.groupBy(height).count().collect())
    cut, upper = 0, 0
    for level, n in reversed(counts):
        if upper + n > broadcast_nodes:
            cut = level + 1
            break
        upper += n
    next_up = F.when(F.col("up_tree") == TOP, F.col("up_level") + 1000).otherwise(F.col("up_level"))
    if cut:
        last = F.coalesce(next_up >= cut, F.lit(True))
        below = _climb(below.withColumn("is_last", last), nodes.where(height < cut).withColumn("is_last", last))
        nodes = nodes.where(height >= cut)
    done = F.col("up_tree").isNull()
    top = _climb(below.withColumn("is_last", done), F.broadcast(nodes.withColumn("is_last", done)))
    each = top.select("members", "folded", "above", "subroot", "here", F.posexplode("members").alias("i", "m"))
    return each.select(
        F.col("m.id").alias("id"),
        F.col("m.leaf").alias("leaf"),
        "subroot",
        F.col("here").alias("root"),
        F.concat(_joined(F.slice(leaves, 1, F.col("i"))), _joined(F.slice(leaves, F.col("i") + 2, FANOUT)), "above").alias("siblings"),
        F.get("folded", F.col("i")).alias("folded_root"),
        (F.get("folded", F.col("i")) == F.col("here")).alias("verified"),
    )
