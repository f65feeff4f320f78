"""Where long repeats can be: the stages that substring and passage deduplication share.

A window is a fixed number of units (bytes or words). Of the short grams inside
a window, the one of the least hash is its anchor. Equal windows have equal
anchors, and neighbouring windows mostly share theirs, so a text falls into runs
of windows with one anchor. Windows of runs whose anchor occurs once can't
repeat and go no further. Runs of equal content are collapsed: their windows
all repeat, and one of them stands for all. What is left (few regions: a run
with its windows' units) is shipped to shards by anchor, where equal windows
must meet. Only anchors with very many different regions are dealt over
several shards, whose results are merged in a second step.

Anchors whose runs alone would be too many for one task are told by a count
sketch of a fixed size. Their runs are not gathered: those of equal content are
collapsed where they were found, and all others are shipped as they are, dealt
over as many shards as their number needs.

Texts that are equal as a whole are counted first; one row of each takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_BYTES, Held, PACKED_DDL, Packer, arrow_groups, arrow_map, batch, bucket_of, compact, small_join, starts, unpack
from tessera.llm.wordcore import mix

RUN = np.dtype([("m", np.uint64), ("f", np.uint64), ("g", np.uint64), ("doc", np.int64), ("t", np.int64), ("s", np.int32), ("n", np.int32), ("own", np.int8)])
#: Kinds of rows of runs().
FULL, PENDING, PARTNER = 0, 1, 2
#: Copied texts, and the spans found, are broadcast up to so many bytes, else joined by an exchange.
MOST_COPIES = BROADCAST_BYTES
#: The runs to ship are sent to the texts by broadcast up to so many bytes, else joined by an exchange.
MOST_SENT = 32 << 20
_SENT_BYTES = 64
#: Runs of one anchor (of one class of the sketch) that are gathered in a task at most, or eight times the mean of all classes if that is more.
MOST_RUNS = 250_000
SKETCH_BITS = 20
_PIECE_BITS = 14


def marked(docs: DataFrame, id_col: str, text_col: str, nulls: bool) -> DataFrame:
    """(id, doc, t, text, rep): doc is the id, or a hash of the text where that is null.

    rep is the least doc of all rows with this text if there are several, else
    null. With nulls, rows without an id are such rows too; else rep is the least id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("u"), text.alias("text"))
    rows = rows.withColumn("doc", F.coalesce("id", "u"))
    copied = compact(rows.groupBy("t", "u").agg(F.min("doc" if nulls else "id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("t", "u", "rep"), "copies")
    return small_join(rows, copied, ["t", "u"], "left", MOST_COPIES).drop("u")


def exchange_runs(texts: DataFrame, find, buckets: int) -> DataFrame:
    """find(doc, t, column) gives arrays of RUN; they are packed by anchor."""

    def run(batches):
        pack = Packer(buckets, 16 << 20)
        for b in batches:
            doc, t = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for r in find(doc, t, b.column(2)):
                yield from pack.add(bucket_of(mix(r["m"]), buckets), r)
        yield from pack.flush()

    return arrow_map(texts.select("doc", "t", "text"), run, PACKED_DDL)


def live_runs(packed: DataFrame, smaller: bool, limit: int, most: int | None = None) -> DataFrame:
    """(doc, t, s, n, m, blocks, kind) of the runs that may hold repeated windows.

    smaller: a window counts as repeated only if it is in a smaller doc too.
    limit: units of different regions of one anchor that fit a shard; blocks is the number of shards for it.
    """
    most = MOST_RUNS if most is None else most
    with Held() as held:
        packed = held(packed)
        sizes = class_counts(packed, RUN, "m")
        common = sizes > common_size(sizes, most)
        if not common.any():
            return compact(_gathered(packed, smaller, limit), "runs")
        every = packed.sparkSession.sparkContext.broadcast(np.where(common, sizes, 0))
        return compact(_gathered(_split(packed, every, hot=False), smaller, limit).unionByName(_ungathered(_split(packed, every, hot=True), smaller, limit, every)), "runs")


def common_size(sizes: np.ndarray, most: int) -> float:
    """Above which a class counts as very common: most, or eight times the mean, as many classes fill in a large corpus without any common value."""
    return max(most, 8 * sizes.mean())


def class_of(m: np.ndarray) -> np.ndarray:
    return (mix(m ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def class_counts(packed: DataFrame, kind: np.dtype, field: str) -> np.ndarray:
    """The number of records in each of 2**SKETCH_BITS classes of a field's values: eight megabytes, at any size of input."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for body in b.column("body").to_pylist():
                total += np.bincount(class_of(np.frombuffer(body, kind)[field]), minlength=len(total))
        for k, x in enumerate(total.reshape(-1, 1 << _PIECE_BITS)):
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.astype(np.uint32 if x.max() < 2**32 else np.int64).tobytes()], pa.binary())], names=["bucket", "body"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << _PIECE_BITS, np.int64)
        for body in t.column("body").to_pylist():
            total += np.frombuffer(body, np.uint32 if len(body) == 4 << _PIECE_BITS else np.int64)
        return pa.table({"bucket": t.column("bucket")[:1], "body": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((1 << (SKETCH_BITS - _PIECE_BITS), 1 << _PIECE_BITS), np.int64)
    for r in arrow_groups(arrow_map(packed, run, PACKED_DDL).groupBy("bucket"), add, PACKED_DDL).collect():
        out[r.bucket] = np.frombuffer(r.body, np.int64)
    return out.ravel()


def _split(packed: DataFrame, sizes, hot: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            bodies = []
            for body in b.column("body").to_pylist():
                r = np.frombuffer(body, RUN)
                bodies.append(r[(sizes.value[class_of(r["m"])] > 0) == hot].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("bucket"), pa.array(bodies, pa.binary())], schema=b.schema)

    return arrow_map(packed, run, PACKED_DDL)


LIVE = pa.schema([("doc", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("m", pa.int64()), ("blocks", pa.int32()), ("kind", pa.int8())])
LIVE_DDL = "doc long, t long, s int, n int, m long, blocks int, kind tinyint"


def _ungathered(packed: DataFrame, smaller: bool, limit: int, sizes) -> DataFrame:
    """The runs of very common anchors: of equal ones in one body, one stands for all; every other is pending, in one of two shards at least."""

    def run(batches):
        for b in batches:
            for body in b.column("body").to_pylist():
                r = np.frombuffer(body, RUN)
                r = r[np.lexsort((r["s"], r["t"], r["doc"], r["g"], r["f"], r["m"]))]
                r = r[starts(r["m"], r["f"], r["g"], r["doc"], r["t"], r["s"])]
                if not len(r):
                    continue
                at = starts(r["m"], r["f"], r["g"])
                size = np.diff(np.r_[at, len(r)])
                least = np.repeat(r["doc"][at], size)
                # bytes: a region found twice repeats wherever it is, and its first place stands for it
                full = r["doc"] > least if smaller else np.repeat(size > 1, size)
                kind = np.where(full, FULL, PENDING).astype(np.int8)
                if not smaller:
                    kind[at[size > 1]] = PENDING
                blocks = np.maximum(2, sizes.value[class_of(r["m"])] * int(r["n"].mean() + 1) // limit * 2).astype(np.int32)
                yield batch(LIVE, r["doc"], r["t"], r["s"], r["n"], r["m"].view(np.int64), blocks, kind)
                if not smaller and (size > 1).any():  # it repeats itself, too
                    own = r[at[size > 1]]
                    yield batch(LIVE, own["doc"], own["t"], own["s"], own["n"], own["m"].view(np.int64), np.full(len(own), 2, np.int32), np.full(len(own), FULL, np.int8))

    return arrow_map(packed, run, LIVE_DDL)


def _gathered(packed: DataFrame, smaller: bool, limit: int) -> DataFrame:
    schema = LIVE

    def group(t: pa.Table) -> pa.Table:
        r = unpack(t, RUN)
        # anchors of one run that holds its anchor once are dropped before anything is sorted by more
        order = np.argsort(r["m"], kind="stable")
        m = r["m"][order]
        at = starts(m)
        size = np.diff(np.r_[at, len(m)])
        r = r[order[np.repeat(size > 1, size) | (r["own"][order] > 0)]]
        order = np.lexsort((r["s"], r["t"], r["doc"], r["g"], r["f"], r["m"]))
        r = r[order]
        r = r[starts(r["m"], r["f"], r["g"], r["doc"], r["t"], r["s"])]  # repeated rows of the input
        if not len(r):
            return pa.Table.from_batches([], schema)
        am, ac = starts(r["m"]), starts(r["m"], r["f"], r["g"])
        sm, sc = np.diff(np.r_[am, len(r)]), np.diff(np.r_[ac, len(r)])
        first = np.zeros(len(r), np.bool_)
        first[ac] = True
        classes = np.repeat(np.add.reduceat(first, am), sm)  # different regions of the anchor
        if smaller:
            least_m = np.repeat(np.minimum.reduceat(r["doc"], am), sm)
            least_c = np.repeat(r["doc"][ac], sc)
            full = r["doc"] > least_c
            pending = ~full & (least_c > least_m)
            partner = ~full & ~pending & first & (np.repeat(np.maximum.reduceat(pending, am), sm))
        else:
            full = np.repeat(sc > 1, sc)
            pending = ~full & ((classes > 1) | (r["own"] > 0))
            partner = full & first & np.repeat(np.maximum.reduceat(pending, am), sm)
        units = np.repeat(np.add.reduceat(np.where(pending | partner, r["n"], 0).astype(np.int64), am), sm)
        blocks = np.where(units > limit, -(-units // limit) * 2, 1)
        out = []
        for keep, kind in ((full, FULL), (pending, PENDING), (partner, PARTNER)):
            k = np.flatnonzero(keep)
            out.append(batch(schema, r["doc"][k], r["t"][k], r["s"][k], r["n"][k], r["m"][k].view(np.int64), blocks[k].astype(np.int32), np.full(len(k), kind, np.int8)))
        return pa.Table.from_batches(out)

    return arrow_groups(packed.groupBy("bucket"), group, LIVE_DDL)


def regions(texts: DataFrame, live: DataFrame, sent: int, shards: int, cut) -> DataFrame:
    """(shard, cross, doc, t, s, pending, body): the units of the runs to ship. cut(column, row, s, n) gives their bodies."""
    plan = live.where(F.col("kind") != FULL).groupBy("doc", "t").agg(F.collect_list(F.struct("s", "n", "m", "blocks", "kind")).alias("runs"))
    joined = small_join(texts.select("doc", "t", "text"), plan, ["doc", "t"], "inner", MOST_SENT, sent * _SENT_BYTES)
    schema = pa.schema([("shard", pa.int64()), ("cross", pa.bool_()), ("doc", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("pending", pa.bool_()), ("body", pa.binary())])

    def run(batches):
        for b in batches:
            runs = b.column(3)
            flat = runs.flatten()
            row = np.repeat(np.arange(b.num_rows), runs.value_lengths().to_numpy(zero_copy_only=False))
            s, n, m, blocks, kind = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            doc, t = (b.column(i).to_numpy(zero_copy_only=False)[row] for i in (0, 1))
            h = mix(m.view(np.uint64))
            salt = mix(doc.view(np.uint64) * np.uint64(31) + s.astype(np.uint64)) % blocks.astype(np.uint64)
            cross = blocks > 1
            # below shards: a plain shard; others: the block of one anchor
            shard = np.where(cross, ((h ^ mix(salt + np.uint64(7))) >> np.uint64(2)).astype(np.int64) + shards, bucket_of(h, shards))
            bodies = cut(b.column(2), row, s, n)
            yield batch(schema, shard, cross, doc, t, s, kind == PENDING, bodies)

    return arrow_map(joined, run, "shard long, cross boolean, doc long, t long, s int, pending boolean, body binary")


def spans(live: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, t, starts, ends): the repeated spans of each text, from full runs and from what the shards found (doc, t, s, e)."""
    every = live.where(F.col("kind") == FULL).select("doc", "t", "s", (F.col("s") + F.col("n")).alias("e")).unionByName(found.select("doc", "t", "s", "e"))
    return every.groupBy("doc", "t").agg(F.collect_list("s").alias("starts"), F.collect_list("e").alias("ends"))


def merged(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans as disjoint maximal ones, ascending; touching spans become one."""
    order = np.argsort(s, kind="stable")
    s, e = s[order].astype(np.int64), np.maximum.accumulate(e[order].astype(np.int64))
    new = np.r_[True, s[1:] > e[:-1]]
    at = np.flatnonzero(new)
    return s[at], e[np.r_[at[1:], len(s)] - 1]


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edge[::2], edge[1::2]
