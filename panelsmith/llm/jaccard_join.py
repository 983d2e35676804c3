"""N-gram Jaccard join with adaptive multi-match prefixes, and its components.

Each text is the set of its distinct word n-grams, in the order of their
64-bit hashes. Two sets with Jaccard similarity of at least t share at least
l elements of their first |x| - ceil(t |x|) + l ones, for every l up to the
overlap. A document takes the l that is cheapest by the postings its prefix
would read and the candidates they would give: elements that occur in many
components ("heavy") are not read at all, and each heavy element in the
prefix is paid for by one more element of prefix, so that l less the heavy
ones still must be shared. A pair becomes a candidate when it shares what the
document with the shorter prefix requires; candidates are verified on the
whole sets. Documents whose prefix has too many heavy elements are compared
among themselves by prefixes of their whole sets in the order of how many
components hold an element, the rarest first. Those who share an element of
that prefix meet in blocks of bounded size and are verified there by counting,
so no pairs are written but a forest of the links found. Every linked pair of
components is found at one of the two levels.

Equal sets are one class from the start. Then classes are linked, where that
verifies, to the class among those that share one of their lowest elements
whose own elements are the most shared (of near copies, the original), so
most of a large group is one component before pairs are enumerated: only
pairs of classes from different components are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelsmith.llm import words as W
from panelsmith.llm.components import connected_components
from panelsmith.session import cut_lineage

#: An element in more components than this is heavy at first.
HEAVY = 16
#: Elements of prefix beyond the shortest, at first, and one more for so many
#: elements of the set; then the whole set.
SLACK, SLACK_STEP = 6, 32
#: Lengths of prefix that a document chooses from.
CHOICES = 16
#: Lowest elements that tie a class to one class that has them too.
ANCHORS = 4
#: Cost of verifying a candidate pair, in postings.
VERIFY_COST = 20
#: Sets of one element that meet in a block at most, from either side.
BLOCK = 256
#: Rows up to which a list of class ids (16 bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000


def _needed(n, num: int, den: int):
    """ceil(n * num / den): the least overlap of a set of n with a linked one."""
    return (n * num + den - 1) // den


def _set_id(values: np.ndarray) -> int:
    salted = W.mix(values ^ np.uint64(0x5851F42D4C957F2D))
    total = np.array([salted.sum(dtype=np.uint64) + np.uint64(len(values))], dtype=np.uint64)
    return int(W.mix(total).view(np.int64)[0])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _sets(docs: DataFrame, n: int, keep, schema: str) -> DataFrame:
    """Rows (id, set_id, n_shingles, elements) with the elements cut by
    ``keep(size)``; docs has columns id and text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                ids, sizes, cut = [], [], []
                for s in W.shingle_sets(W.split_words(part.column("text")), n):
                    ids.append(_set_id(s))
                    sizes.append(len(s))
                    cut.append(s[: keep(len(s))])
                rest = [part.column(c) for c in part.schema.names if c != "text"]
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), _lists(cut)],
                    names=[*names, "node", "n", "elements"],
                )
                ids = cut = None
        W.release_memory()

    return docs.mapInArrow(work, schema)


def forest(comp: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> tuple[list[int], list[int]]:
    """Linked pairs of sets that join different components, less those that
    join what earlier ones have joined."""
    if len(sets) < 2 or (comp == comp[0]).all():
        return [], []
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1, 8192):  # elements at a time
        cut = slice(np.searchsorted(column, lo), np.searchsorted(column, lo + 8192))
        held = np.zeros((len(sets), 8192), dtype=np.float32)
        held[row[cut], column[cut] - lo] = 1
        shared += held @ held.T
    linked = den * shared.astype(np.int64) >= num * (sizes[:, None] + sizes[None, :] - shared.astype(np.int64))
    root, out = {int(c): int(c) for c in comp}, ([], [])

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    for i, j in zip(*np.nonzero(np.triu(linked, 1) & (comp[:, None] != comp[None, :]))):
        a, b = find(int(comp[i])), find(int(comp[j]))
        if a != b:
            root[a] = b
            out[0].append(int(i))
            out[1].append(int(j))
    return out


class _Join:
    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs, self.n, self.num, self.den = docs, n, num, den

    def base(self) -> Column:
        n = F.col("n")
        return n - F.floor((n * self.num + (self.den - 1)) / self.den)

    def usable(self) -> Column:
        """The largest l to choose: every set that can be linked has as much
        slack, and l goes up to the least overlap."""
        least = F.floor(F.floor(F.col("n") * self.num / self.den) / SLACK_STEP) + SLACK
        return F.least(least, F.col("n") - self.base())

    def members(self) -> DataFrame:
        num, den = self.num, self.den
        return cut_lineage(
            _sets(self.docs, self.n, lambda s: s - _needed(s, num, den) + SLACK + s // SLACK_STEP, "id long, text_key long, node long, n long, elements array<long>"),
            "jaccard-members",
        )

    def sets_of(self, nodes: DataFrame, size) -> DataFrame:
        """(node, n, elements) of the given classes (node, id), read again
        from one text of each."""
        nodes = cut_lineage(nodes, "jaccard-nodes")
        few = nodes.count() <= BROADCAST_ROWS
        wanted = nodes.select(F.col("node").alias("want"), "id")
        texts = self.docs.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), "id")
        found = _sets(texts.select("want", "text"), self.n, size, "want long, node long, n long, elements array<long>")
        return found.where("want = node").dropDuplicates(["node"]).select("node", "n", "elements")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar enough."""
        pairs = cut_lineage(pairs.select("a", "b").distinct(), "jaccard-pairs")
        both = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        sets = cut_lineage(self.sets_of(both.join(self.one_id, "node"), lambda s: s), "jaccard-sets")
        left, right = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("elements").alias(f"e{c}")) for c in "ab")
        shared = F.size(F.array_intersect("ea", "eb"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", shared.alias("shared"))
        return joined.where(F.col("shared") * self.den >= self.num * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")

    def shared_elements(self, nodes: DataFrame) -> DataFrame:
        """(node, n, pos, token) of the elements that several classes hold."""
        postings = nodes.select("node", F.col("n").cast("int").alias("n"), F.posexplode("elements").alias("pos", "token"))
        several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
        return cut_lineage(postings.join(several, "token"), "jaccard-shared")

    def anchored(self, shared: DataFrame) -> DataFrame:
        """Pairs of a class and the class with most shared elements among
        those that hold one of its lowest."""
        commons = shared.groupBy("node").agg((F.count(F.lit(1)) / F.max(self.base() + SLACK + F.floor(F.col("n") / SLACK_STEP))).alias("common"))
        low = shared.where(F.col("pos") < ANCHORS).select("token", "node", "n").join(commons, "node")
        first = low.groupBy("token").agg(F.max(F.struct("common", "node", "n")).alias("f"))
        tied = low.join(first, "token").where("f.node <> node").select(F.col("f.node").alias("a"), F.col("node").alias("b"), "n", F.col("f.n").alias("m"))
        fits = F.least("n", "m") * self.den >= F.greatest("n", "m") * self.num
        return tied.where(fits).groupBy("a", "b").count().where("count > 1").select("a", "b")

    def spread(self, shared: DataFrame, comps: DataFrame) -> DataFrame:
        """``shared`` with the component of each class, and the number of
        components (n_comps > 1) and classes (df) that hold each element."""
        rows = shared.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        per_comp = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
        stats = per_comp.groupBy("token").agg(F.count(F.lit(1)).alias("n_comps"), F.sum("c").alias("df")).where("n_comps > 1")
        return cut_lineage(rows.join(stats, "token"), "jaccard-rows")

    def candidates(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of classes in different components to verify, and the
        classes (node) whose prefix must become longer."""
        rows = rows.withColumn("is_heavy", F.col("n_comps") > HEAVY)
        # the shortest prefix that holds the element, counted in l
        rows = rows.withColumn("level", F.greatest(F.col("pos") - self.base() + 1, F.lit(1)).cast("int"))
        aggs = []
        for i in range(CHOICES):
            step = F.lit(1) + F.floor((self.usable() - 1) * i / (CHOICES - 1))
            inside = F.col("level") <= step
            h = F.sum(F.when(inside & F.col("is_heavy"), 1).otherwise(0))
            light = F.sum(F.when(inside & ~F.col("is_heavy"), F.col("df")).otherwise(0))
            need = F.max(step) - h
            cost = light * (1 + VERIFY_COST / F.greatest(need, F.lit(1)))
            aggs.append(F.when(need >= 1, F.struct(cost.alias("cost"), F.max(step).alias("l"), need.alias("need"))).alias(f"l{i}"))
        best = F.least(*[F.col(f"l{i}") for i in range(CHOICES)])
        choice = rows.groupBy("node").agg(*aggs).select("node", best.alias("b")).select("node", "b.l", "b.need")
        choice = cut_lineage(choice, "jaccard-choice")
        light = rows.where(~F.col("is_heavy")).join(choice, "node").where(F.col("l").isNull() | (F.col("level") <= F.col("l")))
        read = cut_lineage(light.select("token", "comp", "node"), "jaccard-read")
        ends = read.select("token", "comp").distinct()
        cross = ends.join(ends.withColumnRenamed("comp", "other"), "token").where("comp < other")
        x, y = read.withColumnRenamed("node", "a"), read.select("token", F.col("comp").alias("other"), F.col("node").alias("b"))
        met = cross.join(x, ["token", "comp"]).join(y, ["token", "other"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
        sizes = choice.join(rows.groupBy("node").agg(F.max("n").alias("n")), "node")
        met = met.join(sizes.toDF("a", "x_l", "x_need", "x_n"), "a").join(sizes.toDF("b", "y_l", "y_need", "y_n"), "b")
        fits = F.least("x_n", "y_n") * self.den >= F.greatest("x_n", "y_n") * self.num
        longest = F.lit(1 << 60)
        xl, yl = F.coalesce("x_l", longest), F.coalesce("y_l", longest)
        need = F.when(xl < yl, F.col("x_need")).when(yl < xl, F.col("y_need")).otherwise(F.greatest("x_need", "y_need"))
        # without a need on either side, both go on to their whole sets
        return met.where(fits & (F.col("c") >= need)).select("a", "b"), choice.where("l is null").select("node")

    def met_in_blocks(self, left: DataFrame, comps: DataFrame) -> DataFrame:
        """Links (a, b) between different components of the classes ``left``;
        of those one element brings together in a block, a spanning forest."""
        sets = cut_lineage(self.sets_of(left.join(self.one_id, "node"), lambda s: s), "jaccard-whole")
        rows = self.spread(self.shared_elements(sets), comps)
        # with base() + 1 elements of the whole set in the prefix, linked sets
        # share one; the elements that no other component holds come first
        order = Window.partitionBy("node").orderBy("n_comps", "token")
        everyone = Window.partitionBy("node")
        alone = F.col("n") - F.count(F.lit(1)).over(everyone)
        rows = rows.withColumn("place", F.row_number().over(order) + alone).where(F.col("place") <= self.base() + 1)
        rows = cut_lineage(rows.select("token", "comp", "node"), "jaccard-prefixes")
        # elements that the same classes hold bring together the same pairs: one
        # of them is enough, and none whose classes are of one component
        groups = rows.groupBy("token").agg(
            F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("who"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("also"),
            (F.min("comp") != F.max("comp")).alias("several"),
        )
        groups = groups.where("several").groupBy("members", "who", "also").agg(F.min("token").alias("token"))
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        rows = rows.join(groups, "token").select(
            "token", "comp", "node", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
        )
        rows = rows.select("token", "comp", "node", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        num, den = self.num, self.den

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b = forest(pdf["comp"].to_numpy(), [np.asarray(e, dtype=np.int64) for e in pdf["elements"]], num, den)
            nodes = pdf["node"].to_numpy()
            return pd.DataFrame({"a": nodes[a], "b": nodes[b]})

        met = rows.join(sets.select("node", "elements"), "node")
        return met.groupBy("token", "lo", "hi").applyInPandas(work, "a long, b long").distinct()

    def run(self) -> DataFrame:
        members = self.members()
        usable = members.where("id is not null and n > 0")
        self.one_id = cut_lineage(usable.groupBy("node").agg(F.min("id").alias("id")), "jaccard-ids")
        few = self.one_id.count() <= BROADCAST_ROWS
        chosen = F.broadcast(self.one_id) if few else self.one_id
        nodes = usable.join(chosen, ["node", "id"]).select("node", "n", "elements")
        shared = self.shared_elements(nodes)
        links = cut_lineage(self.verified(self.anchored(shared)), "jaccard-links")
        comps = cut_lineage(connected_components(links), "jaccard-comps")
        pairs, left = self.candidates(self.spread(shared, comps))
        links = links.unionByName(cut_lineage(self.verified(pairs), "jaccard-links"))
        if left.count():
            comps = cut_lineage(connected_components(links), "jaccard-comps")
            links = links.unionByName(cut_lineage(self.met_in_blocks(left, comps), "jaccard-links"))
        comps = connected_components(links)
        labelled = members.select("id", "text_key", "n", "node").join(comps, "node", "left")
        # a text without words is linked with nothing: its label is its own id
        labelled = cut_lineage(labelled.withColumn("label", F.coalesce("comp", "node")), "jaccard-labels")
        smallest = labelled.where("id is not null and n > 0").groupBy("label").agg(F.min("id").alias("least_id"))
        return labelled.join(smallest, "label", "left").select(
            "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("least_id"))).otherwise(F.col("id")).alias("component_id"), "text_key", F.col("label").alias("component_key")
        )


def jaccard_components(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (the
    smallest id that links reach, its own included), text_key (xxhash64 of the
    text) and component_key, which tells components apart where ids repeat. Two rows link when
    den * |intersection| >= num * |union| of their n-word shingle sets.

    A text with fewer than n words is one shingle, its whole sequence; a null
    or empty text has no shingle and links with nothing. Rows with a null id
    have a null component and link nothing. Rows that repeat an id take part
    each with their own text. Other columns are not read; an empty table gives
    an empty result. Ids must be integers.
    """
    if not (0 < num <= den) or not 1 <= n <= 5:
        raise ValueError("need 0 < num <= den and n from 1 to 5")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    return _Join(rows, n, num, den).run().withColumnRenamed("id", id_col)
