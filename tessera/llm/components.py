"""Connected components of links by alternating stars; nothing is gathered at the driver but two sums a round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, batch, compact

#: Links that one task settles (16 bytes each); more go in rounds.
MOST_EDGES = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's larger neighbours go to the least of its neighbours and itself. Small: its smaller ones and itself do."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    out = both.join(least, both["a"] == least["node"]).select(F.col("m"), "a", "b")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _together(edges: DataFrame) -> DataFrame:
    """Components of few edges, by a task: each round hooks every root to the least root next to it and shortens all ways."""
    schema = pa.schema([("node", pa.int64()), ("component", pa.int64())])

    def run(batches):
        t = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        nodes, at = np.unique(np.concatenate([t.column(0).to_numpy(), t.column(1).to_numpy()]), return_inverse=True)
        a, b = at[: t.num_rows], at[t.num_rows :]
        root = np.arange(len(nodes))
        while len(a):
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            apart = low != high
            a, b = a[apart], b[apart]
            np.minimum.at(root, high[apart], low[apart])
            while (root[root] != root).any():
                root = root[root]
        yield batch(schema, nodes, nodes[root])

    return arrow_map(edges.coalesce(1), run, "node long, component long")


def components(links: DataFrame, most: int = MOST_EDGES) -> DataFrame:
    """(node, component) of the nodes of links (a, b), where component is the smallest node reachable. At most ``most`` links, as counted, are settled by a task; more by rounds of stars."""
    edges = compact(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if edges.count() <= most:
        return _together(edges)
    before = None
    while True:
        r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not r.n or before == tuple(r):
            break
        before = tuple(r)
        edges = compact(_star(_star(edges, True), False), "edges")
    # at the end every node hangs on its component's least node
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
