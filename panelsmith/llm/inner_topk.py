"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Every vector is a sparse row of integer weights floor(scale * x); a term is a
position. Candidates are dealt to blocks of bounded size by a hash, queries
to blocks likewise, and each pair of blocks is one task's cell: there the
candidates' postings of one term after the other are scattered, weighted by
the queries' entries, into dense score arrays (a row per query, a column per
candidate). Each cell selects its k best per query; a window merges the cells.
All pairs of a query and a candidate are scored; nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a block; they bound the memory of a cell, not what is searched.
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
_SLICE = 128


def _weights(vectors: pd.Series, scale: float) -> list[np.ndarray]:
    return [np.floor(np.asarray(v, dtype=np.float64) * scale) for v in vectors]


def _matrix(rows: list[np.ndarray], width: int, kind) -> np.ndarray:
    """Rows of different lengths have weight 0 beyond their end."""
    out = np.zeros((len(rows), width), dtype=kind)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r if kind is not object else [int(x) for x in r]
    return out


def score_cell(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    """The k best candidates of each query of one cell, ties to the smaller id."""
    qs, cs = _weights(queries["vec"], scale), _weights(candidates["vec"], scale)
    width = max(max(map(len, qs)), max(map(len, cs)))
    top = lambda rows: max((float(np.abs(r).max()) for r in rows if len(r)), default=0.0)
    bound = top(qs) * top(cs) * max(width, 1)
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
    ids = candidates["id"].to_numpy()
    by_id = np.argsort(ids, kind="stable")  # ties then go to the smaller column
    ids, post = ids[by_id], np.ascontiguousarray(_matrix(cs, width, kind)[by_id].T)
    weights, names, keys = _matrix(qs, width, kind), queries["id"].to_numpy(), queries["key"].to_numpy()
    out = []
    for lo in range(0, len(names), _SLICE):
        w = weights[lo : lo + _SLICE]
        scores = np.zeros((len(w), len(ids)), dtype=kind)
        for term in range(width):
            using = np.flatnonzero(w[:, term])
            if len(using):
                scores[using] += w[using, term, None] * post[term]
        for row, name, key in zip(scores, names[lo : lo + _SLICE], keys[lo : lo + _SLICE]):
            allowed = np.flatnonzero(ids != name)
            own = row[allowed]
            if len(own) > k:
                cut = np.partition(own, len(own) - k)[len(own) - k]
                sure = np.flatnonzero(own > cut)
                own_at = np.concatenate([sure, np.flatnonzero(own == cut)[: k - len(sure)]])
                allowed, own = allowed[own_at], own[own_at]
            out.append(pd.DataFrame({"query_id": name, "query_key": key, "vec_id": ids[allowed], "score": own}))
    return _long_scores(pd.concat(out) if out else pd.DataFrame({c: [] for c in ("query_id", "query_key", "vec_id", "score")}))


def _long_scores(found: pd.DataFrame) -> pd.DataFrame:
    if found["score"].dtype == object:  # beyond long: held at its ends
        found["score"] = [min(max(int(s), -(2**63)), 2**63 - 1) for s in found["score"]]
    return found.astype({"query_id": "int64", "query_key": "int64", "vec_id": "int64", "score": "int64"})


def inner_topk(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer inner
    products of each row for which ``is_query`` (a Column over ``id_col``)
    holds, over all rows with another id; ties go to the smaller id. All, if
    there are fewer than k.

    Vectors that are null, have null or non-finite components, or a null id
    take no part. Vectors of different lengths meet in the positions both
    have; an empty vector scores 0 with all. A repeated row (same id, same
    vector) counts once; an id with several vectors is a query, and a
    candidate, with each of them, and a query's results then come per vector.
    Scores beyond a long are held at its ends. Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull()
        & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    usable = usable.groupBy("id", "vec").agg(F.xxhash64("id", "vec").alias("key"))
    chosen = usable.where(is_query(F.col("id")))
    n_rows, n_queries = vectors.count(), vectors.where(is_query(F.col(id_col))).count()
    rows_blocks, query_blocks = -(-n_rows // CANDIDATE_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1

    def cells(df: DataFrame, own: int, other: int, by_query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("key", F.lit(by_query)), F.lit(own)).cast("int")
        meets = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        pair = (block.alias("q_block"), meets.alias("c_block")) if by_query else (meets.alias("q_block"), block.alias("c_block"))
        return df.select("id", "key", "vec", *pair)

    q = cells(chosen, query_blocks, rows_blocks, True)
    c = cells(usable, rows_blocks, query_blocks, False)
    schema = "query_id long, query_key long, vec_id long, score long"
    empty = pd.DataFrame({n: pd.Series(dtype="int64") for n in ("query_id", "query_key", "vec_id", "score")})

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return score_cell(left, right, k, scale) if len(left) and len(right) else empty

    found = q.groupBy("q_block", "c_block").cogroup(c.groupBy("q_block", "c_block")).applyInPandas(work, schema)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
