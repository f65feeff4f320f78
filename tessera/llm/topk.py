"""Exact top-k search by inner product with ball trees.

Candidates are read in shards, where they stand; each shard gets a ball tree:
nodes with a centre and a radius, so that q.centre + |q| * radius bounds every
inner product inside. Nodes are searched in order of that bound, and a subtree
whose bound is under a query's current kth score is left out. The kth scores
start from a bounded sample of candidates, searched when the queries are
blocked, and are shared by all shards that a task holds.

Queries are written to the shared folder in blocks of a bounded size. A task
holds the trees of a bounded number of its candidates and takes the blocks'
files one after another, so that candidates are read once, a task's memory is
that of some trees and a block, and no queries pass through the driver. (Where
Arrow has no file system for the shared folder, a few blocks at a time are broadcast.)
Components become floor(scale * x); products and sums of integers are exact
(float64 below 2**53, else int64).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import PACKED_DDL, Packer, arrow_groups, arrow_map, batch, bucket_of, compact, parts, prepare, unpack, written
from tessera.llm.wordcore import mix

LEAF = 64
SHARD = 8192
#: Bytes of candidates (as 64-bit numbers) whose trees a task holds.
HELD_BYTES = 48 << 20
QUERY_BLOCK = 16_384
#: Blocks that are broadcast together where Arrow can't read the shared folder.
WAVE = 4
SEED_ROWS = 4096
_HIT = np.dtype([("q", np.int32), ("id", np.int64), ("score", np.int64)])
#: A hit on its way to its query: block and place in it name the query.
_SENT = np.dtype([("block", np.int32), *_HIT.descr, ("query", np.int64)])


class BallTree:
    """Leaves of at most LEAF vectors; each split is at the median of the direction of largest spread."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right; leaves have left -1
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self._build(vectors, 0, len(vectors))
        self.centres = np.array(self.centre).reshape(len(self.nodes), -1)
        self.radii = np.array(self.radius)

    def _build(self, v: np.ndarray, a: int, z: int) -> int:
        own = v[self.order[a:z]]
        c = own.mean(0)
        me = len(self.nodes)
        self.nodes.append((a, z, -1, -1))
        self.centre.append(c)
        self.radius.append(float(np.sqrt(((own - c) ** 2).sum(1).max())) * (1 + 1e-9) + 1e-6)
        if z - a > LEAF:
            far = own[((own - c) ** 2).sum(1).argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            half = (z - a) // 2
            self.order[a:z] = self.order[a:z][np.argpartition(own @ (other - far), half)]
            self.nodes[me] = (a, z, self._build(v, a, a + half), self._build(v, a + half, z))
        return me


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id, and each query's kth score."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.hits = np.zeros(0, _HIT)
        self.pending: list[np.ndarray] = []
        self.size = 0

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        new = np.empty(len(q), _HIT)
        new["q"], new["id"], new["score"] = q, ids, scores
        self.pending.append(new)
        self.size += len(new)

    def settle(self) -> None:
        if not self.size:
            return
        h = np.concatenate([self.hits, *self.pending])
        self.pending, self.size = [], 0
        self.hits = best(h, self.k)
        rank = ranks(self.hits["q"])
        full = rank == self.k - 1
        self.floor[self.hits["q"][full]] = np.maximum(self.floor[self.hits["q"][full]], self.hits["score"][full])


def ranks(q: np.ndarray) -> np.ndarray:
    """Each row's place in its run of equal q."""
    new = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    return np.arange(len(q)) - np.repeat(new, np.diff(np.r_[new, len(q)]))


def best(h: np.ndarray, k: int) -> np.ndarray:
    h = h[np.lexsort((h["id"], -h["score"], h["q"]))]
    return h[ranks(h["q"]) < k]


def dots(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued arrays."""
    if q.dtype == np.int64:
        return q @ v.T
    return (q @ v.T).astype(np.int64)


def search(tree: BallTree, v: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, norms: np.ndarray, top: Best) -> None:
    """Depth first, the child of the higher bound first; a node is searched only for the queries whose bound reaches their kth score."""
    qf = q.astype(np.float64)
    slack = 1e-6
    stack = [(0, np.arange(len(q)))]
    while stack:
        node, own = stack.pop()
        bound = qf[own] @ tree.centres[node] + norms[own] * tree.radii[node]
        own = own[bound * (1 + np.sign(bound) * 1e-12) + slack >= top.floor[own]]
        if not len(own):
            continue
        a, z, left, right = tree.nodes[node]
        if left < 0:
            at = tree.order[a:z]
            s = dots(q[own], v[at])
            i, j = np.nonzero((s >= top.floor[own, None]) & (q_ids[own, None] != ids[at][None, :]))
            if len(i):
                top.add(own[i], ids[at[j]], s[i, j])
                if top.size > 200_000:
                    top.settle()
        else:
            b = [(qf[own] @ tree.centres[x] + norms[own] * tree.radii[x]).sum() for x in (left, right)]
            if top.size > 20 * len(q):
                top.settle()
            stack += [(left, own), (right, own)] if b[0] < b[1] else [(right, own), (left, own)]
    top.settle()


def quantised(df: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): v as longs in an array. Rows with a null id, or a vector that is null, empty or has null or non-finite components, take no part."""
    v = F.col(vec_col)
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(ok & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))


def same(*arrays: np.ndarray) -> list[np.ndarray]:
    """As float64 if all are, else as int64."""
    return list(arrays) if all(a.dtype == np.float64 for a in arrays) else [a.astype(np.int64) for a in arrays]


def whole(m: np.ndarray) -> np.ndarray:
    """Integers as float64 where their products and sums are exact in it."""
    return m if len(m) and np.abs(m).max() >= 2**22 else m.astype(np.float64)


def blocked(q: DataFrame, seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int, blocks: dict[int, tuple[int, int]]) -> DataFrame:
    """(width, block, ids, vectors, floor): queries (id, v) in blocks, with the kth scores that they have in their width's seeds. blocks: for each width its first block's number and the number of its blocks."""
    schema = pa.schema([("width", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("floor", pa.binary())])
    first, count = (F.create_map(*[F.lit(x) for w, b in blocks.items() for x in (w, b[i])]) for i in (0, 1))
    width = F.size("v")
    numbered = q.withColumn("block", (F.element_at(first, width) + F.pmod(F.xxhash64("id", "v"), F.element_at(count, width))).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        ids = t.column("id").to_numpy()
        v = np.stack(t.column("v").to_pandas().to_numpy()).astype(np.int64)
        floor = np.full(len(ids), np.iinfo(np.int64).min)
        if v.shape[1] in seeds:  # the kth score of a part is a lower bound of the whole's
            s_ids, s = seeds[v.shape[1]]
            a, z = same(whole(v), whole(s))
            top = Best(len(ids), k, floor)
            search(BallTree(s.astype(np.float64)), z, s_ids, a, ids, np.sqrt((v.astype(np.float64) ** 2).sum(1)), top)
            floor = top.floor
        return pa.Table.from_batches([batch(schema, [v.shape[1]], [t.column("block")[0].as_py()], [ids.tobytes()], [v.tobytes()], [floor.tobytes()])])

    return arrow_groups(numbered.groupBy("block"), pack, "width int, block int, ids binary, vectors binary, floor binary")


def opened(name: str):
    """(file system, path) of a file that Spark has named."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(f"s3{name[3:]}" if name.startswith("s3a:") else name)


def read_blocks(files: list[str]):
    """The blocks of the files in the shared folder, one at a time: (width, block, ids, vectors, floor)."""
    import pyarrow.parquet as pq

    for name in files:
        system, path = opened(name)
        with system.open_input_file(path) as f:
            for b in pq.ParquetFile(f).iter_batches(batch_size=1):
                yield from map(unpacked, b.to_pylist())


def unpacked(r) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    return r["width"], r["block"], np.frombuffer(r["ids"], np.int64), whole(np.frombuffer(r["vectors"], np.int64).reshape(-1, r["width"])), np.frombuffer(r["floor"], np.int64)


def readable(files: list[str]) -> bool:
    """Whether Arrow knows the shared folder's file system."""
    try:
        return all(opened(f) for f in files[:1])
    except Exception:  # noqa: BLE001  a scheme that Arrow has not, or was not built with
        return False


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), id_col, score: the k highest inner products of each row of queries over all candidates but those of its own id.

    Fewer candidates than k give all of them; ties go to the smaller id.
    Repeated queries are answered once, repeated candidates count each. Vectors
    of another length than a query's aren't its candidates. Null ids, and
    vectors that are null, empty or hold null or non-finite components, take no
    part. Empty tables give no rows; other columns are not read. Components should
    stay below 2**28 after scaling, for scores to fit in 64 bits.
    """
    spark = candidates.sparkSession
    prepare(spark)
    q = quantised(queries, scale, id_col, vec_col).distinct()
    c = quantised(candidates, scale, id_col, vec_col)
    width = F.size("v").alias("width")
    sizes = {r.width: r["count"] for r in q.groupBy(width).count().collect()}
    if not sizes:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    rows = {r.width: r["count"] for r in c.where(F.size("v").isin(list(sizes))).groupBy(width).count().collect()}
    blocks, seeds, at = {}, {}, 0
    for w, n in sorted(sizes.items()):
        blocks[w] = (at, -(-n // block))
        at += -(-n // block)
        step = max(1, rows.get(w, 0) // SEED_ROWS)
        got = c.where((F.size("v") == w) & (F.pmod(F.xxhash64("id"), F.lit(step)) == 0)).limit(2 * SEED_ROWS).toArrow()
        if got.num_rows:
            seeds[w] = got.column("id").to_numpy(), np.stack(got.column("v").to_pandas().to_numpy()).astype(np.int64)
    sent = written(blocked(q, seeds, k, blocks), "queries")
    files = sent.inputFiles()
    buckets = 2 * parts(spark)

    def run(batches, blocks_of):
        held: dict[int, list] = {}
        size = 0
        for b in batches:
            if b.num_rows:
                widths = b.column(1).value_lengths().to_numpy()
                for w in np.unique(widths).tolist():
                    own = b.filter(pa.array(widths == w))
                    held.setdefault(w, []).append((own.column(0).to_numpy(zero_copy_only=False), matrix(own.column(1), w)))
                    size += own.num_rows * w * 8
            if size >= HELD_BYTES:
                yield from answered(held, blocks_of)
                held, size = {}, 0
        if held:
            yield from answered(held, blocks_of)

    def answered(held, blocks_of):
        trees = {}
        for w, own in held.items():
            ids, v = np.concatenate([x for x, _ in own]), np.concatenate(same(*[m for _, m in own]))
            trees[w] = [(ids[i : i + SHARD], v[i : i + SHARD], BallTree(v[i : i + SHARD].astype(np.float64))) for i in range(0, len(ids), SHARD)]
        held.clear()
        pack = Packer(buckets)
        for w, number, q_ids, q, floor in blocks_of():
            top = Best(len(q_ids), k, floor)
            norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
            for ids, v, tree in trees.get(w, ()):
                a, z = same(q, v)
                search(tree, z, ids, a, q_ids, norms, top)
            out = np.empty(len(top.hits), _SENT)
            out["block"], out["query"] = number, q_ids[top.hits["q"]]
            for name in _HIT.names:
                out[name] = top.hits[name]
            yield from pack.add(bucket_of(mix(out["block"].astype(np.uint64) << np.uint64(32) | out["q"].astype(np.uint64)), buckets), out)
        yield from pack.flush()

    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def merge(t: pa.Table) -> pa.Table:
        h = unpack(t, _SENT)
        h = h[np.lexsort((h["id"], -h["score"], h["q"], h["block"]))]
        rank = ranks(h["block"].astype(np.int64) << 32 | h["q"])
        h, rank = h[rank < k], rank[rank < k]
        return pa.Table.from_batches([batch(schema, h["query"], (rank + 1).astype(np.int32), h["id"], h["score"])])

    c = c.where(F.size("v").isin(list(sizes)))
    if readable(files):
        hits = arrow_map(c, lambda batches: run(batches, lambda: read_blocks(files)), PACKED_DDL)
    else:  # the blocks are broadcast a few at a time, each time over all candidates
        hits = None
        for first in range(0, at, WAVE):
            some = spark.sparkContext.broadcast([r.asDict() for r in sent.where(F.col("block").between(first, first + WAVE - 1)).collect()])
            found = compact(arrow_map(c, lambda batches, some=some: run(batches, lambda: map(unpacked, some.value)), PACKED_DDL), "hits", 5_000)
            some.unpersist()
            hits = found if hits is None else hits.unionByName(found)
    return arrow_groups(hits.groupBy("bucket"), merge, "query_id long, rank int, id long, score long").withColumnRenamed("id", id_col)
