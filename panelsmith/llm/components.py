"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.session import cut_lineage


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, comp (the smallest node of its component) for every node of
    ``edges`` (a, b). Alternates the large-star and small-star steps until
    the edges stay the same; each round is written to the shared folder.
    Loops and repeated edges are allowed; no edges give no rows."""
    one_way = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, print_ = None, None
    while True:
        if state is not None:
            both = state.select("u", "v").unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            # large star: every larger neighbour of u is tied to u's smallest
            large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            # small star: u and its smaller neighbours are tied to the smallest
            small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            one_way = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        state = cut_lineage(one_way, name)
        seen = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == print_ or not seen[0]:
            break
        print_ = seen
    return state.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )
