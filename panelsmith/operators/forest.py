"""Regression forests as tables: grown for all groups in one job, scored for all
groups by one join.

A forest is a row (group, fold, subset, trees): trees is an array of nodes held
in arrays, the root first. Stopping at a given depth or after the first trees
scores every smaller setting of the same forest: a forest of 75 trees of depth
30 holds all grids below it. Forests of up to ``BROADCAST_BYTES`` go to the
tasks, which score rows of any groups a batch at a time where they lie; larger
ones meet their rows by one join, where ``walk`` follows them.

Groups are dealt to tasks as (group, subset, block of trees) and grown there
level by level in numpy, up to ``LOCAL_ROWS`` rows a group. The rows of larger
groups are binned once, rows of equal bins together, and stay where they are:
a job per level sums the histograms of the open nodes of all their forests. Forests too deep for that
are fitted by MLlib and their stored nodes are read as the same kind of row.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelsmith.session import cut_lineage, shared_dir

#: Training rows of a group up to which one task grows a block of its trees.
LOCAL_ROWS = 20_000
#: Trees a task grows at once, for every fold.
TREE_BLOCK = 25
#: Steps after which a walk looks whether it has ended.
LEG = 5
#: Rows that meet a forest at once.
CHUNK_ROWS = 256
#: Bytes of packed forests up to which they are broadcast to the rows.
BROADCAST_BYTES = 64 << 20
#: Rows of a group stored together when binned, and rows a task sorts at once.
BIN_ROWS, SORTED_ROWS = 1 << 16, 1 << 20
#: Ranges of a hash of the bins by which rows of equal bins meet.
RANGES = 256
#: Sums of rows of equal bins, over trees, that go down the trees at once.
HELD_CELLS = 1 << 17
#: Values by which a task describes how a feature is distributed.
SUMMARY = 1 << 10
#: Open nodes of a group, over its forests, up to which tasks hold a level's histograms.
LEVEL_NODES = 1 << 14
#: Bytes of histograms a task holds before it passes them on.
HELD_BYTES = 64 << 20

#: child holds the left and the right child of node i at 2 i and 2 i + 1.
NODES = "feature:array<int>,threshold:array<double>,child:array<int>,value:array<double>,gain:array<double>"
SCORES = [StructField("subset", StringType()), StructField("n_trees", IntegerType()), StructField("depth", IntegerType())]
PREDICTION = StructField("prediction", DoubleType())
ERRORS = [StructField("n", LongType()), StructField("error", DoubleType())]
FOREST = f"fold int, subset string, trees array<struct<tree:int,{NODES}>>"


def subset_size(strategy: str, n_features: int) -> int:
    """Features tried per node, by MLlib's names."""
    sizes = {
        "all": n_features,
        "sqrt": math.ceil(math.sqrt(n_features)),
        "log2": max(1, math.ceil(math.log2(n_features))),
        "onethird": math.ceil(n_features / 3),
        "auto": math.ceil(n_features / 3),
    }
    if strategy not in sizes:
        raise ValueError(f"featureSubsetStrategy {strategy!r} is not one of {', '.join(sizes)}")
    return sizes[strategy]


# ------------------------------------------------------------------ growing


def bin_edges(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds between the distinct values, at most max_bins - 1, by rank."""
    seen = np.unique(values)
    if len(seen) > max_bins:
        ranked = np.sort(values)
        at = np.arange(1, max_bins) * len(ranked) // max_bins
        seen = np.unique(np.concatenate([ranked[at], seen[:1], seen[-1:]]))
    return (seen[:-1] + seen[1:]) / 2


def _best_splits(node: np.ndarray, n_nodes: int, binned: np.ndarray, w: np.ndarray, wy: np.ndarray, n_bins: int):
    """Per node the bin after which a split gains most, and the gain (the
    decrease of the weighted sum of squares; -1 where there is no split)."""
    key = node * n_bins + binned
    order = np.argsort(key)
    key, cw, cs = key[order], np.cumsum(w[order]), np.cumsum(wy[order])
    end = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    of, bin_ = key[end] // n_bins, key[end] % n_bins
    last = np.append(of[1:] != of[:-1], True)
    first = np.append(0, np.flatnonzero(last)[:-1] + 1)
    before = np.append(0, end[last][:-1] + 1) - 1
    w0, s0 = np.where(before >= 0, cw[before], 0), np.where(before >= 0, cs[before], 0.0)
    total = np.cumsum(last) - last
    tw, ts = cw[end[last]] - w0, cs[end[last]] - s0
    lw, ls = cw[end] - w0[total], cs[end] - s0[total]
    rw, rs = tw[total] - lw, ts[total] - ls
    gain = np.where(last, -1.0, ls**2 / np.maximum(lw, 1) + rs**2 / np.maximum(rw, 1) - (ts**2 / tw)[total])
    high = np.maximum.reduceat(gain, first)
    where = np.flatnonzero(gain == high[total])
    where = where[np.append(True, total[where][1:] != total[where][:-1])]
    best, at = np.full(n_nodes, -1.0), np.zeros(n_nodes, dtype=np.int64)
    best[of[last]], at[of[last]] = high, bin_[where]
    return best, at


def grow(binned: np.ndarray, y: np.ndarray, weights: np.ndarray, max_depth: int, tried: int, draw: np.random.Generator) -> list[dict]:
    """One tree per row of ``weights`` (trees x rows, whole numbers), grown
    together level by level; features and splits are given as bin numbers."""
    n_trees, n_features, n_bins = len(weights), binned.shape[1], int(binned.max(initial=0)) + 1
    tree, row = np.nonzero(weights)
    w = weights[tree, row].astype(np.float64)
    wy = w * y[row]
    node = tree.astype(np.int64)  # place in the level
    ids, owner = np.arange(n_trees), np.arange(n_trees)
    out = {k: [] for k in ("id", "tree", "feature", "bin", "left", "right", "value", "gain")}
    n_ids = n_trees
    for depth in range(max_depth + 1):
        m = len(ids)
        tw, ts = np.bincount(node, w, m), np.bincount(node, wy, m)
        squares = np.bincount(node, wy * y[row], m)
        mean = ts / np.maximum(tw, 1)
        spread = squares - ts * mean
        gain, feature, at = np.full(m, -1.0), np.full(m, -1), np.zeros(m, dtype=np.int64)
        open_ = (tw > 1) & (spread > 1e-9 * np.maximum(squares, 1e-300)) if depth < max_depth else np.zeros(m, dtype=bool)
        if open_.any():
            keep = open_[node]
            node, row, w, wy = node[keep], row[keep], w[keep], wy[keep]
            place = np.cumsum(open_) - 1
            small, k = place[node], int(open_.sum())
            chosen = np.argpartition(draw.random((k, n_features), dtype=np.float32), tried - 1, axis=1)[:, :tried]
            best, best_at, best_f = np.full(k, -1.0), np.zeros(k, dtype=np.int64), np.full(k, -1)
            for j in range(tried):
                f = chosen[small, j]
                g, b = _best_splits(small, k, binned[row, f].astype(np.int64), w, wy, n_bins)
                better = g > best
                best[better], best_at[better], best_f[better] = g[better], b[better], chosen[better, j]
            split = best > 1e-9 * spread[open_]
            gain[open_], at[open_], feature[open_] = best, best_at, np.where(split, best_f, -1)
        inner = feature >= 0
        left, right = np.full(m, -1), np.full(m, -1)
        left[inner] = n_ids + 2 * np.arange(int(inner.sum()))
        right[inner] = left[inner] + 1
        for k, v in zip(out, (ids, owner, feature, at, left, right, mean, np.where(inner, gain, 0.0))):
            out[k].append(v)
        if not inner.any():
            break
        keep = inner[node]
        node, row, w, wy = node[keep], row[keep], w[keep], wy[keep]
        child = 2 * (np.cumsum(inner) - 1)
        node = child[node] + (binned[row, feature[node]] > at[node])
        ids = n_ids + np.arange(2 * int(inner.sum()))
        owner = np.repeat(owner[inner], 2)
        n_ids += len(ids)
    flat = {k: np.concatenate(v) for k, v in out.items()}
    # nodes by tree, in the order of levels, the root first; ids become places
    order = np.argsort(flat["tree"], kind="stable")
    bounds = np.searchsorted(flat["tree"][order], np.arange(n_trees + 1))
    place = np.full(n_ids + 1, -1, dtype=np.int32)  # the last one for no child
    place[flat["id"][order]] = np.arange(len(order)) - bounds[flat["tree"][order]]
    for side in ("left", "right"):
        flat[side] = place[flat[side]]
    flat = {k: flat[k][order] for k in ("feature", "bin", "left", "right", "value", "gain")}
    return [{k: v[a:b] for k, v in flat.items()} for a, b in zip(bounds[:-1], bounds[1:])]


def _grow_block(seed: int, max_bins: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group, subset, block = (k.as_py() for k in key)
        get = lambda c: table.column(c).combine_chunks()
        order = np.argsort(get("row_key").to_numpy(), kind="stable")  # the same trees whatever the order of arrival
        width = len(table.column("x")[0])
        x = get("x").flatten().to_numpy().reshape(-1, width)[order]
        y, fold = get("y").to_numpy()[order], get("fold").to_numpy()[order]
        head = table.slice(0, 1).to_pylist()[0]
        cols, depth, n_trees, by_fold = head["cols"], head["depth"], head["n_trees"], head["by_fold"]
        x = x[:, cols]
        edges = [bin_edges(x[:, j], max_bins) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int16)
        rows = []
        for f in sorted(set(fold.tolist())) if by_fold else [-1]:
            own = np.flatnonzero(fold != f)
            at = zlib.crc32(f"{seed}|{group}|{subset}|{block}|{f}".encode())
            draw = np.random.default_rng(at)
            weights = draw.poisson(1.0, (n_trees, len(own)))
            weights[weights.sum(axis=1) == 0] = 1
            trees = grow(binned[own], y[own], weights, depth, subset_size(subset, len(cols)), draw)
            packed = []
            for t, nodes in enumerate(trees):
                threshold = [float(edges[j][b]) if j >= 0 else None for j, b in zip(nodes["feature"].tolist(), nodes["bin"].tolist())]
                feature = [cols[j] if j >= 0 else -1 for j in nodes["feature"].tolist()]
                child = np.stack([nodes["left"], nodes["right"]], axis=1).ravel().tolist()
                rest = {k: nodes[k].tolist() for k in ("value", "gain")}
                packed.append({"tree": block * TREE_BLOCK + t, "feature": feature, "threshold": threshold, "child": child, **rest})
            rows.append((f, packed))
        kind = pa.list_(
            pa.struct(
                [
                    ("tree", pa.int32()),
                    ("feature", pa.list_(pa.int32())),
                    ("threshold", pa.list_(pa.float64())),
                    ("child", pa.list_(pa.int32())),
                    ("value", pa.list_(pa.float64())),
                    ("gain", pa.list_(pa.float64())),
                ]
            )
        )
        return pa.table(
            {
                "g": pa.array([group] * len(rows), key[0].type),
                "fold": pa.array([f for f, _ in rows], pa.int32()),
                "subset": pa.array([subset] * len(rows), pa.string()),
                "trees": pa.array([t for _, t in rows], kind),
            }
        )

    return run


def grow_groups(rows: DataFrame, plans: list[tuple], group_type: str, seed: int, max_bins: int) -> DataFrame:
    """Forests (g, fold, subset, trees in blocks) of ``rows`` (g, fold, y, x).

    ``plans``: (group, columns of x used, subset, trees, depth, by_fold), where
    by_fold asks for one forest per fold, grown without that fold's rows;
    else fold is -1. One job, whatever the number of plans."""
    spark = rows.sparkSession
    tasks = [
        (g, list(cols), subset, b, min(TREE_BLOCK, trees - b * TREE_BLOCK), depth, by_fold)
        for g, cols, subset, trees, depth, by_fold in plans
        for b in range(-(-trees // TREE_BLOCK))
    ]
    schema = f"g {group_type}, cols array<int>, subset string, block int, n_trees int, depth int, by_fold boolean"
    asked = F.broadcast(spark.createDataFrame(tasks, schema))  # a few rows per group
    keyed = rows.withColumn("row_key", F.xxhash64("x", "y", "fold"))
    dealt = _spread(keyed.join(asked, "g"), ["g", "subset", "block"])
    return dealt.groupBy("g", "subset", "block").applyInArrow(_grow_block(seed, max_bins), f"g {group_type}, {FOREST}")


# ---------------------------------------------------- growing, large groups


def _summary(values: np.ndarray, weights: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and their weights (by default 1 each); beyond
    ``size`` of them, that many by rank, the ends included."""
    if weights is None:
        seen, w = np.unique(values, return_counts=True)
        w = w.astype(np.float64)
    else:
        seen, at = np.unique(values, return_inverse=True)
        w = np.bincount(at, weights, len(seen))
    if len(seen) <= size:
        return seen, w
    total = w.sum()
    ranked = np.searchsorted(np.cumsum(w), np.linspace(0, total, size), side="left")
    return seen[np.minimum(ranked, len(seen) - 1)], np.full(size, total / size)


def summary_edges(values: np.ndarray, weights: np.ndarray, max_bins: int) -> np.ndarray:
    """``bin_edges`` of weighted values."""
    seen, at = np.unique(values, return_inverse=True)
    if len(seen) > max_bins:
        reached = np.cumsum(np.bincount(at, weights, len(seen)))
        ranked = np.searchsorted(reached, np.arange(1, max_bins) * reached[-1] / max_bins, side="right")
        seen = np.unique(np.concatenate([seen[np.minimum(ranked, len(seen) - 1)], seen[:1], seen[-1:]]))
    return (seen[:-1] + seen[1:]) / 2


def _features(x: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a table of numbers (null: NaN)."""
    width = len(x[0])
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)


def _by_group(batch: pa.RecordBatch):
    """(group, rows of the batch) for every group in it."""
    code = batch.column("g").dictionary_encode()
    of = code.indices.to_numpy(zero_copy_only=False)
    for i, g in enumerate(code.dictionary.to_pylist()):
        yield g, np.flatnonzero(of == i)


def group_edges(rows: DataFrame, cols: dict, group_type: str, max_bins: int) -> dict:
    """{group: the bin edges of each of its columns}, from all rows: every task
    describes its rows by ranks, and the descriptions are merged."""
    size = max(SUMMARY, 8 * max_bins)

    def describe(batches):
        held: dict = {}
        raw: dict = {}  # values not yet described

        def merge(key):
            own = _summary(np.concatenate(raw.pop(key)), None, size)
            if key in held:
                own = _summary(*(np.concatenate(part) for part in zip(held[key], own)), size)
            held[key] = own

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _features(batch.column("x"))
            for g, at in _by_group(batch):
                for j, c in enumerate(cols[g]):
                    v = x[at, c]
                    v = v[~np.isnan(v)]
                    parts = raw.setdefault((g, j), [])
                    parts.append(v)
                    if len(parts) > 64:
                        merge((g, j))
        for key in list(raw):
            merge(key)
        for key, (v, w) in held.items():
            out = [[key[0]], [key[1]], [v.tolist()], [w.tolist()]]
            yield pa.RecordBatch.from_pydict(dict(zip(("g", "j", "v", "w"), out)), schema=kind)

    def join(key: tuple, table: pa.Table) -> pa.Table:
        v, w = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("v", "w"))
        edges = summary_edges(v, w, max_bins).tolist()
        return pa.Table.from_pydict({"g": [key[0].as_py()], "j": [key[1].as_py()], "edges": [edges]}, schema=found)

    g_kind = _arrow_type(rows)
    kind = pa.schema([("g", g_kind), ("j", pa.int32()), ("v", pa.list_(pa.float64())), ("w", pa.list_(pa.float64()))])
    found = pa.schema([("g", g_kind), ("j", pa.int32()), ("edges", pa.list_(pa.float64()))])
    parts = rows.select("g", "x").mapInArrow(describe, f"g {group_type}, j int, v array<double>, w array<double>")
    edges = parts.groupBy("g", "j").applyInArrow(join, f"g {group_type}, j int, edges array<double>")
    out = {g: [np.zeros(0)] * len(c) for g, c in cols.items()}
    for r in edges.collect():  # fewer than max_bins numbers per group and column
        out[r.g][r.j] = np.array(r.edges)
    return out


def _arrow_type(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["g"].dataType)


def _ranges(bins: np.ndarray) -> np.ndarray:
    """The range of each row of bins."""
    odd = 2 * np.random.default_rng(1).integers(0, 1 << 62, bins.shape[1], dtype=np.uint64) + np.uint64(1)
    mixed = (bins.astype(np.uint64) + np.uint64(1)) @ odd
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * odd[0]) >> np.uint64(32)) % np.uint64(RANGES)


def binned_rows(rows: DataFrame, cols: dict, edges: dict, group_type: str, n_bins: int) -> DataFrame:
    """``rows`` stored as (chunk, g, fold, y, bins): up to BIN_ROWS rows of a
    group together, each column as bytes, dealt evenly over the files. Rows of
    equal bins stand together, by fold and target, whatever the order of
    arrival: tasks send their rows in blocks, one per group and range, and
    the blocks of a range are sorted where they meet."""
    small = np.uint8 if n_bins <= 256 else np.uint16
    g_kind, names = _arrow_type(rows), ("fold", "y", "bins")
    block = pa.schema([("g", g_kind), ("range", pa.int32()), *[(c, pa.binary()) for c in names]])
    schema = pa.schema([("chunk", pa.int64()), ("g", g_kind), *[(c, pa.binary()) for c in names]])

    def bin_(batches):
        held: dict = {}

        def passed_on():
            for g, parts in held.items():
                part = [np.concatenate(c) for c in zip(*parts)]
                of = _ranges(part[2]).astype(np.uint16)
                order = np.argsort(of, kind="stable")
                ends = np.cumsum(np.bincount(of, minlength=RANGES))
                part = [c[order] for c in part]
                cuts = [(r, a, b) for r, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
                out = [[g] * len(cuts), [r for r, _, _ in cuts], *[[c[a:b].tobytes() for _, a, b in cuts] for c in part]]
                yield pa.RecordBatch.from_pydict(dict(zip(block.names, out)), schema=block)
            held.clear()

        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _features(batch.column("x"))
            fold, y = batch.column("fold").to_numpy().astype(np.int32), batch.column("y").to_numpy(zero_copy_only=False)
            for g, at in _by_group(batch):
                own = np.stack([np.searchsorted(e, x[at, c], side="left").astype(small) for c, e in zip(cols[g], edges[g])], axis=1)
                held.setdefault(g, []).append((fold[at], y[at], own))
            n += batch.num_rows
            if n >= SORTED_ROWS:
                yield from passed_on()
                n = 0
        yield from passed_on()

    def pack(batches):
        made, ready, part, of, n = TaskContext.get().partitionId() << 32, [], [], None, 0

        def sort():  # the blocks of a range
            nonlocal part, n
            if part:
                fold, y, bins = (np.concatenate(c) for c in zip(*part))
                order = np.lexsort((y, fold, *bins.T))
                ready.append((fold[order], y[order], bins[order]))
            part, n = [], 0

        def chunks(least):
            nonlocal made, ready
            while ready and sum(len(p[0]) for p in ready) >= least:
                whole = [np.concatenate(c) for c in zip(*ready)]
                row = [made], [of[0]], *[[c[:BIN_ROWS].tobytes()] for c in whole]
                ready = [tuple(c[BIN_ROWS:] for c in whole)] if len(whole[0]) > BIN_ROWS else []
                made += 1
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, row)), schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column("g")[i].as_py(), batch.column("range")[i].as_py()
                if here != of or n >= SORTED_ROWS:
                    sort()
                    yield from chunks(BIN_ROWS if of is not None and here[0] == of[0] else 1)
                    of = here
                fold, y, bins = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in zip(names, (np.int32, np.float64, small)))
                part.append((fold, y, bins.reshape(len(fold), -1)))
                n += len(fold)
        sort()
        yield from chunks(1)

    blocks = rows.mapInArrow(bin_, f"g {group_type}, range int, fold binary, y binary, bins binary")
    # rebalanced, so that one very frequent cell is spread over tasks
    met = blocks.hint("rebalance", "g", "range").sortWithinPartitions("g", "range")
    packed_rows = met.mapInArrow(pack, f"chunk long, g {group_type}, fold binary, y binary, bins binary")
    return cut_lineage(_spread(packed_rows, []), "binned")


def _poisson() -> np.ndarray:
    """How often a row is drawn into a tree's rows, for each of 65536 equally
    likely numbers: Poisson with mean 1."""
    chance = np.exp(-1.0) / np.array([math.factorial(k) for k in range(12)])
    return np.searchsorted(np.cumsum(chance), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


class _Level:
    """The states of a forest's growing trees, one after the other."""

    def __init__(self, states: dict):
        self.trees = list(states)
        feature, bin_, child, place, self.chosen = (list(c) for c in zip(*states.values()))
        self.nodes = np.cumsum([0, *[len(f) for f in feature]])
        self.opens = np.cumsum([0, *[len(c) for c in self.chosen]])
        self.feature, self.bin, self.chosen = np.concatenate(feature), np.concatenate(bin_), np.concatenate(self.chosen)
        self.child = np.concatenate([c + n for c, n in zip(child, self.nodes)])
        self.place = np.concatenate([np.where(p < 0, -1, p + n) for p, n in zip(place, self.opens)])


def level_histograms(asked: dict, level: int, seed: int, n_bins: int):
    """Per task and open tree, (weight, weighted target) by open node, tried
    feature and bin, and each node's weighted squares, as bytes.

    ``asked``: {group: [(forest, fold, features, {tree: (feature, bin, child,
    place, chosen)})]}; a tree's leaves are their own children, place is a
    node's number among the open ones, chosen their features to try. Every row
    is drawn for every tree; the sums of neighbouring rows of equal bins then
    go down the trees together."""
    small, drawn = (np.uint8 if n_bins <= 256 else np.uint16), _poisson().astype(np.float64)
    asked = {g: [(no, f, width, _Level(states)) for no, f, width, states in forests] for g, forests in asked.items()}

    def run(batches):
        held: dict = {}
        levels = {no: of for forests in asked.values() for no, _, _, of in forests}

        def passed_on():
            rows = []
            for no, (h, squares) in held.items():
                of = levels[no]
                for t, a, b in zip(of.trees, of.opens, of.opens[1:]):
                    rows.append((no, t, np.concatenate([h[:, a:b].ravel(), squares[a:b]]).tobytes()))
            held.clear()
            for f, t, h in rows:
                yield pa.RecordBatch.from_pydict({"forest": [f], "tree": [t], "h": [h]}, schema=kind)

        kind = pa.schema([("forest", pa.int32()), ("tree", pa.int32()), ("h", pa.binary())])
        for batch in batches:
            for row in range(batch.num_rows):
                g, number = batch.column("g")[row].as_py(), batch.column("chunk")[row].as_py()
                read = lambda c, t: np.frombuffer(batch.column(c)[row].as_buffer(), t)  # noqa: B023, E731
                fold, y, bins = read("fold", np.int32), read("y", np.float64), read("bins", small)
                kept: dict = {}
                for no, left_out, width, of in asked.get(g, ()):
                    if left_out not in kept:
                        own = np.flatnonzero(fold != left_out)
                        cell = bins.reshape(-1, width)[own]
                        first = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]).any(axis=1))) if len(own) else own
                        kept = {left_out: (y[own], first, cell[first].ravel().astype(np.int64))}
                    own_y, first, flat = kept[left_out]
                    if not len(own_y):
                        continue
                    if no not in held:
                        k, tried = of.chosen.shape
                        held[no] = np.zeros((2 * tried, k, n_bins)), np.zeros(k)
                    step = max(1, HELD_CELLS // len(first))
                    for a in range(0, len(of.trees), step):
                        some = range(a, min(a + step, len(of.trees)))
                        sums = np.empty((3, len(some), len(first)))
                        for i, t in enumerate(some):
                            draw = np.random.SFC64([seed, number, no, of.trees[t]]).random_raw(len(own_y) // 4 + 1)
                            w = drawn.take(draw.view(np.uint16)[: len(own_y)])
                            for power in range(3):
                                sums[power, i] = w if len(first) == len(w) else np.add.reduceat(w, first)
                                if power < 2:
                                    w *= own_y
                        _histogram(flat, sums, width, of, some, level, n_bins, *held[no])
            if sum(h.nbytes for h, _ in held.values()) > HELD_BYTES:
                yield from passed_on()
        yield from passed_on()

    return run


def _histogram(flat: np.ndarray, sums: np.ndarray, width: int, of: _Level, some: range, level: int, n_bins: int, h: np.ndarray, squares: np.ndarray) -> None:
    """Adds cells (bins in ``flat``), with their weights, weighted targets and
    weighted squares in each of ``some`` trees, to the nodes they reach."""
    cells = sums.shape[2]
    w, wy, wyy = sums.reshape(3, -1)
    at = np.flatnonzero(w)
    base, node = at % cells * width, of.nodes[some.start : some.stop][at // cells]
    for _ in range(level):
        right = flat.take(base + of.feature.take(node)) > of.bin.take(node)
        node = of.child.take(2 * node + right)
    node = of.place.take(node)
    keep = np.flatnonzero(node >= 0)
    if len(keep) < len(node):
        node, base, at = node[keep], base[keep], at[keep]
    w, wy, wyy = w[at], wy[at], wyy[at]
    low, high = of.opens[some.start], of.opens[some.stop]
    node = node - low
    chosen, k, first = of.chosen[low:high], high - low, node * n_bins
    for j in range(chosen.shape[1]):
        key = first + flat.take(base + chosen[:, j].take(node))
        h[2 * j, low:high] += np.bincount(key, w, k * n_bins).reshape(k, n_bins)
        h[2 * j + 1, low:high] += np.bincount(key, wy, k * n_bins).reshape(k, n_bins)
    squares[low:high] += np.bincount(node, wyy, k)


def _level_splits(n_open: dict, n_bins: int):
    """The best split of every open node of a tree from its summed histograms."""
    names = ("tried", "bin", "gain", "w", "s", "left_w", "left_s")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        f, t = (k.as_py() for k in key)
        h = sum(np.frombuffer(b.as_buffer(), np.float64) for b in table.column("h"))
        k = n_open[f, t]
        squares, h = h[-k:], h[:-k].reshape(-1, 2, k, n_bins).transpose(2, 0, 3, 1)  # node, feature, bin, (weight, sum)
        low = np.cumsum(h, axis=2)
        total = low[:, :1, -1:, :]
        lw, ls = low[..., 0], low[..., 1]
        rw, rs = total[..., 0] - lw, total[..., 1] - ls
        tw, ts = total[:, 0, 0, 0], total[:, 0, 0, 1]
        whole = ts * ts / np.maximum(tw, 1)
        gain = ls**2 / np.maximum(lw, 1) + rs**2 / np.maximum(rw, 1) - whole[:, None, None]
        gain = np.where((lw > 0) & (rw > 0), gain, -1.0).reshape(k, -1)
        best, each = gain.argmax(axis=1), np.arange(k)
        spread = squares - whole
        open_ = (tw > 1) & (spread > 1e-9 * np.maximum(squares, 1e-300)) & (gain[each, best] > 1e-9 * spread)
        out = (np.where(open_, best // n_bins, -1), best % n_bins, gain[each, best], tw, ts, lw.reshape(k, -1)[each, best], ls.reshape(k, -1)[each, best])
        return pa.table({"forest": pa.array([f], pa.int32()), "tree": pa.array([t], pa.int32())} | {c: [v.tolist()] for c, v in zip(names, out)})

    lists = ", ".join(f"{c} array<{'long' if c in ('tried', 'bin') else 'double'}>" for c in names)
    return run, f"forest int, tree int, {lists}"


class _Growing:
    """The nodes of a tree while it grows, as lists, and its open ones."""

    def __init__(self):
        self.feature, self.bin, self.child, self.value, self.gain = [-1], [0], [-1, -1], [0.0], [0.0]
        self.open, self.chosen = [0], None

    def state(self, n_bins: int) -> tuple:
        own = np.arange(len(self.feature))
        inner = np.array(self.feature) >= 0
        child = np.where(np.repeat(inner, 2), np.array(self.child), np.repeat(own, 2))
        place = np.full(len(own), -1)
        place[self.open] = np.arange(len(self.open))
        return np.where(inner, self.feature, 0), np.where(inner, self.bin, n_bins), child, place, self.chosen

    def split(self, r) -> None:
        below = []
        for p, node in enumerate(self.open):
            if node == 0:
                self.value[0] = r.s[p] / max(r.w[p], 1.0)
            if r.tried[p] < 0:
                continue
            self.feature[node], self.bin[node], self.gain[node] = int(self.chosen[p, r.tried[p]]), r.bin[p], r.gain[p]
            for side, (w, s) in enumerate(((r.left_w[p], r.left_s[p]), (r.w[p] - r.left_w[p], r.s[p] - r.left_s[p]))):
                self.child[2 * node + side] = len(self.feature)
                below.append(len(self.feature))
                self.feature.append(-1), self.bin.append(0), self.child.extend((-1, -1)), self.value.append(s / w), self.gain.append(0.0)
        self.open = below


def level_nodes(plan: tuple, folds: int) -> int:
    """Nodes that may be open at once in the last level of a plan's forests."""
    _, _, _, trees, depth, by_fold = plan
    return trees * (folds if by_fold else 1) << max(depth - 1, 0)


def bin_large(rows: DataFrame, cols: dict, group_type: str, max_bins: int, folds: dict | None = None) -> tuple:
    """What ``grow_large`` reads of ``rows`` (g, fold, y, x): columns, folds
    (counted, unless they are given) and bin edges of each group, and the
    stored bins."""
    rows = rows.where(F.col("fold").isNotNull())
    if folds is None:
        folds = {r.g: sorted(r.f) for r in rows.groupBy("g").agg(F.collect_set("fold").alias("f")).collect()}
    edges = group_edges(rows, cols, group_type, max_bins)
    n_bins = max((len(e) + 1 for of in edges.values() for e in of), default=1)
    return cols, folds, edges, n_bins, binned_rows(rows, cols, edges, group_type, n_bins)


def grow_large(binned: tuple, plans: list[tuple], group_type: str, seed: int) -> DataFrame:
    """The forests of ``plans`` in the form of ``grow_groups``, for groups
    beyond one task's rows: one job per level for all of them. Tasks hold
    histograms, the driver the nodes (see LEVEL_NODES)."""
    cols, folds, edges, n_bins, stored = binned
    spark, seed = stored.sparkSession, seed % (1 << 32)
    forests = []
    for g, used, subset, trees, depth, by_fold in plans:
        own = [cols[g].index(c) for c in used]
        forests += [(g, f, subset, own, depth, [_Growing() for _ in range(trees)]) for f in (folds[g] if by_fold else [-1])]
    for level in range(max((f[4] for f in forests), default=0)):
        asked, n_open = {}, {}
        for no, (g, fold, subset, own, depth, trees) in enumerate(forests):
            going = {}
            for t, tree in enumerate(trees):
                if level >= depth or not tree.open:
                    continue
                draw = np.random.default_rng([seed, no, t, level])
                tried = subset_size(subset, len(own))
                tree.chosen = np.array(own)[np.argsort(draw.random((len(tree.open), len(own))), axis=1)[:, :tried]]
                going[t], n_open[no, t] = tree.state(n_bins), len(tree.open)
            if going:
                asked.setdefault(g, []).append((no, fold, len(cols[g]), going))
        if not asked:
            break
        parts = stored.mapInArrow(level_histograms(asked, level, seed, n_bins), "forest int, tree int, h binary")
        split, kind = _level_splits(n_open, n_bins)
        for r in _spread(parts, ["forest", "tree"]).groupBy("forest", "tree").applyInArrow(split, kind).collect():
            forests[r.forest][5][r.tree].split(r)
    out = []
    for g, fold, subset, _, _, trees in forests:
        packed_trees = []
        for t, tree in enumerate(trees):
            threshold = [float(edges[g][j][b]) if j >= 0 else None for j, b in zip(tree.feature, tree.bin)]
            packed_trees.append((t, [cols[g][j] if j >= 0 else -1 for j in tree.feature], threshold, tree.child, tree.value, tree.gain))
        out.append((g, fold, subset, packed_trees))
    return spark.createDataFrame(out, f"g {group_type}, {FOREST}")


# ---------------------------------------------------------- forests of MLlib


def stored_trees(spark: SparkSession, path: str, cols: Sequence[int]) -> DataFrame:
    """The trees of a saved MLlib forest as one row; feature i of the model is
    column cols[i]."""
    data = spark.read.parquet(f"{path}/data")
    n = F.col("nodeData")
    own = F.array(*[F.lit(int(c)) for c in cols])
    leaf = F.col("n.split.featureIndex") < 0
    nodes = data.select(F.col("treeID").cast("int").alias("tree"), n.alias("n")).select(
        "tree",
        F.struct(
            F.col("n.id").alias("id"),
            F.when(leaf, -1).otherwise(F.get(own, F.col("n.split.featureIndex"))).alias("feature"),
            F.when(~leaf, F.get("n.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.array("n.leftChild", "n.rightChild").alias("child"),
            F.col("n.prediction").alias("value"),
            F.when(leaf, 0.0).otherwise(F.col("n.gain") * F.get("n.impurityStats", F.lit(0))).alias("gain"),
        ).alias("node"),
    )
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list("node")).alias("n"))
    arrays = [(F.flatten("n.child") if c == "child" else F.col(f"n.{c}")).alias(c) for c in ("feature", "threshold", "child", "value", "gain")]
    return trees.select(F.struct("tree", *arrays).alias("t")).agg(F.sort_array(F.collect_list("t")).alias("trees"))


def fit_large(rows: DataFrame, plans: list[tuple], group_type: str, seed: int, max_bins: int, threads: int) -> DataFrame:
    """The forests of ``plans`` by one MLlib fit each (per fold where asked),
    in the form of ``grow_groups``. For groups beyond one task's rows."""
    spark = rows.sparkSession
    folds = {g: sorted(f) for g, f in rows.groupBy("g").agg(F.collect_set("fold")).collect()}
    jobs = [(*p, f) for p in plans for f in (folds[p[0]] if p[5] else [-1])]

    def fit(job):
        g, cols, subset, trees, depth, _, fold = job
        own = rows.where((F.col("g") == F.lit(g)) & (F.col("fold") != fold)).select("y", *[F.get("x", F.lit(c)).alias(f"x{c}") for c in cols])
        features = VectorAssembler(inputCols=[f"x{c}" for c in cols], outputCol="features").transform(own)
        rf = RandomForestRegressor(labelCol="y", numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, maxBins=max_bins, seed=seed)
        path = shared_dir(spark, "models", uuid.uuid4().hex)
        rf.fit(features).write().save(path)
        return stored_trees(spark, path, cols).select(F.lit(g).cast(group_type).alias("g"), F.lit(fold).alias("fold"), F.lit(subset).alias("subset"), "trees")

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        found = list(pool.map(fit, jobs))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ scoring


def merge_blocks(blocks: DataFrame) -> DataFrame:
    """One row per (g, fold, subset) with all its trees in order."""
    return blocks.groupBy("g", "fold", "subset").agg(F.sort_array(F.flatten(F.collect_list("trees"))).alias("trees"))


def _steps(x: Column, tree: Column, node: Column, n: Column) -> Column:
    """The node reached from ``node`` in n steps, or the leaf before; null
    where a feature on the way is missing."""

    def step(at: Column, _: Column) -> Column:
        goes_right = F.get(x, F.get(tree["feature"], at)) > F.get(tree["threshold"], at)
        return F.when(F.get(tree["feature"], at) < 0, at).otherwise(F.get(tree["child"], 2 * at + goes_right.cast("int")))

    walked = F.aggregate(F.sequence(F.lit(1), n), node, step)
    return F.when(F.get(tree["feature"], node) < 0, node).otherwise(walked)


def walk(x: Column, tree: Column, depths: Sequence[int]) -> Column:
    """Values of ``tree`` for ``x`` at each of the rising ``depths``, by
    stopping there, as an array."""
    gaps = F.array(*[F.lit(b - a) for a, b in zip([0, *depths], depths)])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<double>").alias("seen"))

    def stop(state: Column, gap: Column) -> Column:
        reached = F.array(_steps(x, tree, state["at"], gap))  # bound, so that it is walked once
        seen = lambda s, n: F.concat(s["seen"], F.array(F.get(tree["value"], n)))
        return F.aggregate(reached, state, lambda s, n: F.struct(n.alias("at"), seen(s, n).alias("seen")))

    return F.aggregate(gaps, start, stop, lambda s: s["seen"])


def _spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Few bytes, much work: as many partitions as the session asks for, which
    adaptive execution would merge by their size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def chunked(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` packed into arrays of about CHUNK_ROWS rows of one key, so that
    a join with large rows meets each of them once per chunk, and a large
    group is spread over many chunks."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("__chunks"))
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).join(sizes, list(keys))
    dealt = dealt.withColumn("__chunk", F.pmod(F.xxhash64("__row"), F.col("__chunks")))
    dealt = _spread(dealt, [*keys, "__chunk"])
    return dealt.groupBy(*keys, "__chunk").agg(F.collect_list(F.struct(*columns)).alias("rows")).drop("__chunk")


def _flat(table: pa.Table, keys: Sequence[str]) -> dict:
    """Forests as flat arrays; a leaf is its own child, node 0 a leaf of value
    0 for trees that a forest does not have."""
    forests = table.column("trees").combine_chunks()
    trees = forests.flatten()
    lengths = np.concatenate([[1], trees.field("feature").value_lengths().to_numpy(zero_copy_only=False)]).astype(np.int64)
    start = np.cumsum(lengths) - lengths
    flat = lambda c: trees.field(c).flatten().to_numpy(zero_copy_only=False)
    feature = np.append(-1, flat("feature"))
    leaf, n = feature < 0, np.arange(len(feature))
    child = np.append([-1, -1], flat("child")).astype(np.int64) + np.repeat(np.repeat(start, lengths), 2)
    n_trees = forests.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    roots = np.zeros((len(forests), max(n_trees.max(initial=0), 1)), dtype=np.int64)
    roots[np.arange(roots.shape[1]) < n_trees[:, None]] = start[1:]
    return {
        "leaf": leaf,
        "feature": np.where(leaf, 0, feature).astype(np.int64),
        "threshold": np.where(leaf, np.inf, np.append(np.nan, flat("threshold").astype(np.float64))),
        "child": np.where(np.repeat(leaf, 2), np.repeat(n, 2), child),
        "value": np.append(0.0, flat("value")),
        "n_trees": n_trees,
        "roots": roots,
        "of": {k: i for i, k in enumerate(zip(*(table.column(c).to_pylist() for c in keys)))},
    }


class _Held:
    """The arrays of ``_flat`` in a task."""

    def __init__(self, arrays: dict):
        self.__dict__.update(arrays)

    def met(self, rows: pa.RecordBatch, *rest) -> np.ndarray:
        """The forest of each row, by its group, or by its group, its fold and
        the subset in ``rest``; -1 for none."""
        code = rows.column("g").dictionary_encode()
        groups = code.dictionary.to_pylist()
        of = code.indices.fill_null(len(groups)).to_pylist()
        if not rest:
            at = [self.of.get((g,), -1) for g in groups] + [-1]
            return np.array([at[i] for i in of], dtype=np.int64)
        keys = [*zip(of, rows.column("fold").to_pylist())]
        at = {(i, f): self.of.get((groups[i], f, *rest), -1) if i < len(groups) and f is not None else -1 for i, f in {*keys}}
        return np.array([at[k] for k in keys], dtype=np.int64)

    def values(self, x: pa.Array, at: np.ndarray, depths: Sequence[int]):
        """Per tree, the values of the rows' nodes at each of the rising
        ``depths``, NaN and False where a feature on the way is missing."""
        width = len(x[0])
        numbers = x.flatten()
        lacks = numbers.is_null().to_numpy(zero_copy_only=False) if numbers.null_count else None
        numbers = numbers.to_numpy(zero_copy_only=False).astype(np.float64)
        assert len(numbers) == len(x) * width, "arrays of features differ in length"
        nan = np.isnan(numbers) if np.isnan(numbers).any() else None  # larger than any threshold
        base = np.arange(len(x)) * width
        for t in range(self.roots.shape[1]):
            node, known, done, seen = self.roots[at, t], np.ones(len(x), dtype=bool), 0, []
            for d in depths:
                for step in range(done, d):
                    if step and step % LEG == 0 and self.leaf.take(node).all():
                        break
                    cell = base + self.feature.take(node)
                    right = numbers.take(cell) > self.threshold.take(node)
                    if nan is not None:
                        right |= nan.take(cell)
                    if lacks is not None:
                        known = known & (self.leaf.take(node) | ~lacks.take(cell))
                    node = self.child.take(2 * node + right)
                done = d
                seen.append((self.value.take(node), known))
            yield seen


def held(forests: DataFrame, keys: Sequence[str]) -> dict | None:
    """``forests`` in the driver's hands, to be sent to the tasks, where they
    are few enough."""
    if _bytes(forests) > BROADCAST_BYTES:
        return None
    return _flat(forests.select(*keys, "trees").toArrow(), keys)


def _as_column(total: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(total, pa.float64(), mask=None if known.all() else ~known)


def nested_scores(rows: DataFrame, forests: DataFrame, counts: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """(g, fold, subset, n_trees, depth, y, prediction) of every row of ``rows``
    (g, fold, y, x) by the forests of its group and fold (g, fold, subset,
    trees), for the first ``counts`` trees stopped at each of ``depths``."""
    depths, counts = sorted(depths), sorted(counts)
    few = held(forests, ["g", "fold", "subset"])
    if few is not None:
        return _nested(rows, few, counts, depths, summed=False)
    met = chunked(rows, ["g", "fold"], ["y", "x"]).join(forests, ["g", "fold"])
    each = F.transform("rows", lambda r: F.struct(r["y"].alias("y"), F.transform("trees", lambda t: walk(r["x"], t, depths)).alias("v")))
    values = met.select("g", "fold", "subset", F.inline(each))
    settings = []
    for n in counts:
        first = F.slice("v", 1, n)
        for k, d in enumerate(depths):
            total = F.aggregate(F.transform(first, lambda v: F.get(v, F.lit(k))), F.lit(0.0), lambda a, v: a + v)  # noqa: B023
            settings.append(F.struct(F.lit(n).alias("n_trees"), F.lit(d).alias("depth"), (total / F.size(first)).alias("prediction")))
    return values.select("g", "fold", "subset", "y", F.inline(F.array(*settings)))


def nested_errors(rows: DataFrame, forests: DataFrame, counts: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """(g, fold, subset, n_trees, depth, mse) of ``nested_scores``: the mean
    squared error of all rows of a fold, summed in the tasks that score them."""
    keys = ["g", "fold", "subset", "n_trees", "depth"]
    few = held(forests, ["g", "fold", "subset"])
    if few is None:
        scores = nested_scores(rows, forests, counts, depths)
        return scores.groupBy(*keys).agg(F.avg((F.col("y") - F.col("prediction")) ** 2).alias("mse"))
    parts = _nested(rows, few, sorted(counts), sorted(depths), summed=True)
    return parts.groupBy(*keys).agg(F.try_divide(F.sum("error"), F.sum("n")).alias("mse"))


def binned_errors(binned: tuple, forests: DataFrame, counts: Sequence[int], depths: Sequence[int]) -> DataFrame | None:
    """``nested_errors`` of the rows stored by ``bin_large``, by forests grown
    on them: rows of equal bins reach the same leaves, so that each of a
    chunk's cells goes down the trees once. None where the forests are too
    large to be sent to the tasks."""
    cols, _, edges, n_bins, stored = binned
    few = held(forests, ["g", "fold", "subset"])
    if few is None:
        return None
    counts, depths = sorted(counts), sorted(depths)
    small, width = (np.uint8 if n_bins <= 256 else np.uint16), 1 + max(c for own in cols.values() for c in own)
    # a value of each bin; splits are at the edges
    values = {g: [np.append(e, np.inf) for e in of] for g, of in edges.items()}
    sent = stored.sparkSession.sparkContext.broadcast(few)
    subsets = sorted({k[2] for k in few["of"]})
    kinds = [stored.schema["g"], StructField("fold", IntegerType()), *SCORES, *ERRORS]

    def score(batches):
        few = _Held(sent.value)
        for batch in batches:
            for row in range(batch.num_rows):
                g = batch.column("g")[row].as_py()
                fold, y, bins = (np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in (("fold", np.int32), ("y", np.float64), ("bins", small)))
                bins = bins.reshape(len(fold), -1)
                first = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]).any(axis=1) | (fold[1:] != fold[:-1])))
                size = np.diff(np.append(first, len(fold)))
                x = np.zeros((len(first), width))
                for j, c in enumerate(cols[g]):
                    x[:, c] = values[g][j][bins[first, j]]
                x = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
                of_fold, code = np.unique(fold[first], return_inverse=True)
                of_row, n = np.repeat(code, size), np.bincount(code, size, len(of_fold)).astype(np.int64)
                for subset in subsets:
                    forest = np.array([few.of.get((g, f, subset), -1) for f in of_fold.tolist()])
                    if (forest < 0).any():
                        continue
                    at, total = forest[code], [np.zeros(len(first)) for _ in depths]
                    for t, seen in enumerate(few.values(x, at, depths), 1):
                        for k, (v, _) in enumerate(seen):
                            total[k] += v
                        for trees in [c for c in counts if c == t or (c > t and t == few.roots.shape[1])]:
                            for k, d in enumerate(depths):
                                mean = np.repeat(total[k] / np.minimum(trees, few.n_trees[at]), size)
                                error = np.bincount(of_row, (y - mean) ** 2, len(of_fold))
                                out = [[g] * len(of_fold), of_fold, *[[v] * len(of_fold) for v in (subset, trees, d)], n, error]
                                yield pa.RecordBatch.from_pydict(dict(zip(made.names, out)), schema=made)

    made = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kinds])
    keys = ["g", "fold", "subset", "n_trees", "depth"]
    parts = stored.mapInArrow(score, StructType(kinds))
    return parts.groupBy(*keys).agg(F.try_divide(F.sum("error"), F.sum("n")).alias("mse"))


def _fold_errors(part: pa.RecordBatch, total: np.ndarray, known: np.ndarray):
    """Rows and squared errors by group and fold, of rows that have both values."""
    y = part.column("y").to_numpy(zero_copy_only=False)
    known = known & part.column("y").is_valid().to_numpy(zero_copy_only=False)
    fold = part.column("fold").to_numpy(zero_copy_only=False)
    folds, of_fold = np.unique(fold, return_inverse=True)
    group = part.column("g").dictionary_encode()
    key = group.indices.to_numpy(zero_copy_only=False) * len(folds) + of_fold
    size = len(group.dictionary) * len(folds)
    n = np.bincount(key, known, size)
    error = np.bincount(key, np.where(known, (y - total) ** 2, 0.0), size)
    at = np.unique(key)
    return group.dictionary.take(pa.array(at // len(folds))), pa.array(folds[at % len(folds)], pa.int32()), n[at].astype(np.int64), error[at]


def _nested(rows: DataFrame, few: dict, counts: list, depths: list, summed: bool) -> DataFrame:
    """``nested_scores`` where the rows lie, a row each or, ``summed``, as
    (n, error) by batch."""
    sent = rows.sparkSession.sparkContext.broadcast(few)
    subsets = sorted({k[2] for k in few["of"]})
    head = [rows.schema["g"], rows.schema["fold"], SCORES[0]]
    kinds = [*head, *SCORES[1:], *ERRORS] if summed else [*head, rows.schema["y"], *SCORES[1:], PREDICTION]

    def score(batches):
        few = _Held(sent.value)
        for batch in batches:
            for subset in subsets if batch.num_rows else ():
                at = few.met(batch, subset)
                own = np.flatnonzero(at >= 0)
                if not len(own):
                    continue
                part, at = batch.take(pa.array(own)), at[own]
                total, known = [np.zeros(len(own)) for _ in depths], [np.ones(len(own), dtype=bool) for _ in depths]
                for t, seen in enumerate(few.values(part.column("x"), at, depths), 1):
                    for k, (v, k_known) in enumerate(seen):
                        total[k] += v
                        known[k] = known[k] & k_known
                    # counts beyond the trees that there are take them all
                    for n in [c for c in counts if c == t or (c > t and t == few.roots.shape[1])]:
                        for k, d in enumerate(depths):
                            mean = total[k] / np.minimum(n, few.n_trees[at])
                            if summed:
                                g, fold, rows_of, error = _fold_errors(part, mean, known[k])
                            else:
                                g, fold = part.column("g"), part.column("fold")
                            of, *setting = (pa.repeat(pa.scalar(v, kind), len(g)) for v, kind in ((subset, pa.string()), (n, pa.int32()), (d, pa.int32())))
                            out = [g, fold, of, *setting, pa.array(rows_of), pa.array(error)] if summed else [g, fold, of, part.column("y"), *setting, _as_column(mean, known[k])]
                            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in kinds])

    return rows.select("g", "fold", "y", "x").mapInArrow(score, StructType(kinds))


def forest_scores(rows: DataFrame, forests: DataFrame, keep: Sequence[str], max_depth: int) -> DataFrame:
    """``keep`` and prediction of every row of ``rows`` (g, x and ``keep``)
    whose group has a forest: the mean of its trees' leaves. Null where a tree
    asks for a missing feature."""
    few = held(forests, ["g"])
    if few is not None:
        sent = rows.sparkSession.sparkContext.broadcast(few)

        def leaves(batches):
            few = _Held(sent.value)
            for batch in batches:
                if not batch.num_rows:
                    continue
                at = few.met(batch)
                own = np.flatnonzero(at >= 0)
                if not len(own):
                    continue
                part, at = batch.take(pa.array(own)), at[own]
                total, known = np.zeros(len(own)), np.ones(len(own), dtype=bool)
                for ((v, t_known),) in few.values(part.column("x"), at, [max_depth]):
                    total += v
                    known = known & t_known
                mean = _as_column(total / few.n_trees[at], known)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), mean], names=[*keep, "prediction"])

        return rows.select("g", *keep, "x").mapInArrow(leaves, StructType([*(rows.schema[c] for c in keep), PREDICTION]))
    met = chunked(rows, ["g"], [*keep, "x"]).join(forests.select("g", "trees"), "g")

    def score(r: Column) -> Column:
        legs = F.array_repeat(F.lit(LEG), -(-max_depth // LEG))
        leaf = lambda t: F.aggregate(legs, F.lit(0), lambda at, n: _steps(r["x"], t, at, n))
        leaves = F.transform("trees", lambda t: F.get(t["value"], leaf(t)))
        return F.aggregate(leaves, F.lit(0.0), lambda a, v: a + v) / F.size(leaves)

    each = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in keep], score(r).alias("prediction")))
    return met.select(F.inline(each))


def packed(forests: DataFrame, name: str) -> DataFrame:
    """``forests`` written to the shared folder, marked for broadcast where
    their nodes are few enough (28 bytes and 8 for the gain each)."""
    stored = cut_lineage(forests, name)
    return F.broadcast(stored) if _bytes(stored) <= BROADCAST_BYTES else stored


def _bytes(forests: DataFrame) -> int:
    nodes = forests.agg(F.sum(F.aggregate("trees", F.lit(0).cast("long"), lambda a, t: a + F.size(t["feature"])))).first()[0] or 0
    return 36 * nodes


def importances(forest: DataFrame) -> DataFrame:
    """(g, feature index, importance): per tree the gains by feature, as shares
    of the tree's; their sum over trees, as a share of the forest's."""
    nodes = forest.select("g", F.explode("trees").alias("t")).select("g", "t.tree", F.explode(F.arrays_zip("t.feature", "t.gain")).alias("n"))
    by = nodes.where("n.feature >= 0").groupBy("g", "tree", F.col("n.feature").alias("feature")).agg(F.sum("n.gain").alias("gain"))
    of_tree = by.groupBy("g", "tree").agg(F.sum("gain").alias("total"))
    share = by.join(of_tree, ["g", "tree"]).groupBy("g", "feature").agg(F.sum(F.try_divide("gain", "total")).alias("share"))
    return share.join(share.groupBy("g").agg(F.sum("share").alias("all")), "g").select("g", "feature", F.try_divide("share", "all").alias("importance"))
