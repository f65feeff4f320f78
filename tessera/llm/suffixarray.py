"""Substring deduplication with suffix arrays.

Regions that may hold repeated strings (see anchors) are dealt to shards. Each
shard sorts its suffixes by Larsson-Sadakane refinement in numpy: an order by
the first symbols, then doublings in which only groups of equal ranks are
sorted on. Common prefixes of neighbours follow Kasai's recurrence in its
vectorised form: a position whose left symbol equals that of its predecessor in
order has one less than the position before it; only the others are compared.
A window of ``width`` bytes repeats if a neighbour shares its first width bytes.

One string's regions can be too many for a shard. These are dealt over several
shards; each sends its classes of equal windows as a sorted run of
fingerprints, parted by range, and the runs are merged by binary search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import anchors
from tessera.llm.anchors import RUN, merged, runs_of
from tessera.llm.common import Packer, arrow_groups, arrow_map, batch, bucket_of, compact, parts, prepare, small_join, starts, unpack
from tessera.llm.wordcore import BASE, BASE_INV, BYTE_VALUE, chunks, column_bytes, digests, mix, powers, sliding_min

GRAM = 32
SHARD_BYTES = 3 << 20
CROSS_BYTES = 6 << 20
_CHUNK = 1 << 18
_CROSS = np.dtype([("h", np.uint64), ("g", np.uint64), ("doc", np.int64), ("t", np.int64), ("s", np.int32), ("n", np.int8)])


def suffix_array(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes of x, symbols of at most 9 bits; what lies beyond the end is least."""
    n = len(x)
    pad = np.zeros(n + 7, np.int64)
    pad[:n] = x
    key = np.zeros(n, np.int64)
    for i in range(7):
        key <<= 9
        key |= pad[i : i + n]
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    new = np.ones(n, np.bool_)
    new[1:] = key[1:] != key[:-1]
    del key
    head = np.flatnonzero(new).astype(np.int32)
    size = np.diff(np.r_[head, n])
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(head, size)
    open_ = np.flatnonzero(np.repeat(size > 1, size))  # places in order whose group isn't sorted out
    h = 7
    while len(open_):
        own = order[open_]
        ahead = own.astype(np.int64) + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0).astype(np.int64)
        key = rank[own].astype(np.int64) << 32 | second
        by = np.argsort(key, kind="stable")
        key, own = key[by], own[by]
        order[open_] = own
        new = np.ones(len(key), np.bool_)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.r_[at, len(key)])
        rank[own] = np.repeat(open_[at], size)
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return order, rank


def common_prefixes(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The common prefix of each suffix, by position, with its predecessor in order (Kasai's values)."""
    n = len(x)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    left = np.where((i > 0) & (before > 0), x[np.maximum(i - 1, 0)] == x[np.maximum(before - 1, 0)], False)
    own = np.flatnonzero(~left)
    a, b = own, before[own]
    length = np.zeros(len(own), np.int64)
    active = np.flatnonzero(b >= 0)
    pad = np.zeros(n + 8, x.dtype)
    pad[:n] = x + 1  # beyond the end nothing is equal: the two suffixes end at different places
    while len(active):
        p, q = a[active] + length[active], b[active] + length[active]
        same = np.ones(len(active), np.bool_)
        step = np.zeros(len(active), np.int64)
        for k in range(8):
            same &= (pad[np.minimum(p + k, n)] == pad[np.minimum(q + k, n)]) & (p + k < n) & (q + k < n)
            step += same
        length[active] += step
        active = active[same]
    out = np.zeros(n, np.int64)
    last = np.zeros(n, np.int64)
    last[own] = np.arange(len(own))
    np.maximum.accumulate(last, out=last)
    out = length[last] - (i - own[last])
    return np.maximum(out, 0)


def find_runs(width: int, gram: int):
    """RUN arrays of texts taken as bytes."""

    def find(doc, t, column):
        data, offsets = column_bytes(column)
        for i, j in chunks(offsets, _CHUNK):
            o = offsets[i : j + 1]
            x, o = data[o[0] : o[-1]], o - o[0]
            n = len(x)
            if n < width:
                continue
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE_VALUE[x] * powers(BASE, n), out=total[1:])
            g = mix((total[gram:] - total[:-gram]) * powers(BASE_INV, n - gram + 1))
            span = width - gram + 1
            m = sliding_min(g, span)  # by window start
            sizes = np.maximum(np.diff(o) - width + 1, 0)
            row = np.repeat(np.arange(j - i), sizes)
            if not len(row):
                continue
            s = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(o[:-1], sizes)
            value = m[s]
            at = starts(value, row)
            s0, e = s[at], s[np.r_[at[1:], len(s)] - 1] + width
            # grams that are some window's anchor, to see which runs hold their anchor twice
            ext = np.concatenate([np.zeros(span - 1, np.uint64), m, np.zeros(span - 1, np.uint64)])
            top = ~sliding_min(~ext, span)
            place = np.flatnonzero(g == top[: len(g)])
            a, z = np.searchsorted(place, s0), np.searchsorted(place, e - gram, "right")
            k = z - a
            owner = np.repeat(np.arange(len(at)), k)
            hit = g[place[np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(a, k)]] == value[at][owner]
            r = np.empty(len(at), RUN)
            r["m"], r["doc"], r["t"] = value[at], doc[i:j][row[at]], t[i:j][row[at]]
            r["f"], r["g"] = digests(x, s0, e)
            r["s"], r["n"], r["own"] = s0 - o[row[at]], e - s0, np.bincount(owner[hit], minlength=len(at)) > 1
            yield r

    return find


def cut_bytes(column, row, s, n) -> pa.Array:
    data, offsets = column_bytes(column)
    a = offsets[row] + s
    return pa.array([data[i : i + k].tobytes() for i, k in zip(a.tolist(), n.tolist(), strict=True)], pa.binary())


class Shard:
    """The regions of a shard as one string with a least symbol after each region, and its suffix array."""

    def __init__(self, bodies: list[bytes], width: int):
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.base = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        x = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int16) + 1
        x[self.base + sizes] = 0
        self.x, self.sizes, self.width = x, sizes, width
        self.order, self.rank = suffix_array(x)
        self.prefix = common_prefixes(x, self.order)
        starts_ = np.maximum(sizes - width + 1, 0)
        self.region = np.repeat(np.arange(len(sizes)), starts_)
        self.at = np.arange(len(self.region)) - np.repeat(np.cumsum(starts_) - starts_, starts_) + self.base[self.region]

    def repeated(self) -> np.ndarray:
        """Of the windows self.at: whether a neighbour shares the first width bytes."""
        r = self.rank[self.at]
        after = np.minimum(r + 1, len(self.order) - 1)
        return (self.prefix[self.at] >= self.width) | ((self.prefix[self.order[after]] >= self.width) & (r + 1 < len(self.order)))

    def classes(self) -> np.ndarray:
        """The windows that stand first in order of those equal to them, as indexes into self.at, in suffix order."""
        first = np.flatnonzero(self.prefix[self.at] < self.width)
        return first[np.argsort(self.rank[self.at[first]])]


def resolve(shipped: DataFrame, width: int, buckets: int) -> DataFrame:
    """(doc, t, s, e): the repeated spans of pending regions; windows of dealt-over anchors are merged across shards."""
    schema = pa.schema([("doc", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), *[pa.field(n, k) for n, k in (("bucket", pa.int32()), ("body", pa.binary()))]])
    ddl = "doc long, t long, s int, e int, bucket int, body binary"

    def rows(doc, t, s, e):
        n = len(doc)
        return batch(schema, doc, t, s.astype(np.int32), e.astype(np.int32), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()))

    def group(t: pa.Table) -> pa.Table:
        doc, text, s0, pending = (t.column(c).to_numpy() for c in ("doc", "t", "s", "pending"))
        key = starts(*(a := [x[np.lexsort((s0, text, doc))] for x in (doc, text, s0)]))
        keep = np.lexsort((s0, text, doc))[key]  # repeated rows of the input ship a region each
        del a
        bodies = t.column("body").take(pa.array(keep)).to_pylist()
        doc, text, s0, pending = doc[keep], text[keep], s0[keep], pending[keep]
        shard = Shard(bodies, width)
        twice = shard.repeated()
        out = []
        hit = twice & pending[shard.region]
        flags = np.zeros(len(shard.x) + 1, np.bool_)
        flags[shard.at[hit]] = True
        a, z = runs_of(flags[:-1])
        if len(a):
            region = np.searchsorted(shard.base, a, "right") - 1
            off = a - shard.base[region]
            out.append(rows(doc[region], text[region], s0[region] + off, s0[region] + (z - 1 - shard.base[region]) + width))
        if t.column("cross")[0].as_py() and len(shard.at):
            c = shard.classes()
            at, region = shard.at[c], shard.region[c]
            rec = np.empty(len(c), _CROSS)
            rec["h"], rec["g"] = digests(np.maximum(shard.x - 1, 0).astype(np.uint8), at, at + width)
            # a class that repeats here, or of a partner, only answers; the others ask too
            rec["doc"], rec["t"], rec["s"], rec["n"] = doc[region], text[region], s0[region] + (at - shard.base[region]), np.where(twice[c] | ~pending[region], 0, 1)
            pack = Packer(buckets, 1 << 62)
            list(pack.add(bucket_of(rec["h"], buckets), rec))
            for b in pack.flush():
                n = b.num_rows
                none = [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
                out.append(batch(schema, *none, *b.columns))
        return pa.Table.from_batches(out, schema)

    found = compact(arrow_groups(shipped.groupBy("shard"), group, ddl), "repeats")
    plain = pa.schema([schema.field(i) for i in range(4)])

    def merge(t: pa.Table) -> pa.Table:
        r = unpack(t, _CROSS)
        r = r[np.lexsort((r["g"], r["h"]))]
        asks = r[r["n"] == 1]
        # each asking class searches the merged runs: the stretch of its fingerprint holds it and its equals of other shards
        lo, hi = np.searchsorted(r["h"], asks["h"]), np.searchsorted(r["h"], asks["h"], "right")
        many = np.flatnonzero(hi - lo > 1)
        asks, lo, hi = asks[many], lo[many], hi[many]
        k = hi - lo
        owner = np.repeat(np.arange(len(asks)), k)
        there = np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo, k)
        hits = asks[np.bincount(owner[r["g"][there] == asks["g"][owner]], minlength=len(asks)) > 1]
        return pa.Table.from_batches([batch(plain, hits["doc"], hits["t"], hits["s"], (hits["s"] + width).astype(np.int32))])

    crossed = arrow_groups(found.where("body is not null").select("bucket", "body").groupBy("bucket"), merge, "doc long, t long, s int, e int")
    return found.where("body is null").select("doc", "t", "s", "e").unionByName(crossed)


def repeated_spans(texts: DataFrame, width: int, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, cross_bytes: int = CROSS_BYTES) -> DataFrame:
    """(doc, t, starts, ends) of the texts of marked() rows that take part."""
    n = parts(texts.sparkSession)
    live = anchors.live_runs(anchors.exchange_runs(texts, find_runs(width, min(gram, width)), 2 * n), False, cross_bytes)
    size = live.where(F.col("kind") != anchors.FULL).agg(F.count("*").alias("n"), F.sum("n").alias("bytes")).first()
    shards = max(1, -(-(size.bytes or 0) // shard_bytes))
    found = resolve(anchors.regions(texts, live, size.n, shards, cut_bytes), width, 2 * n)
    return anchors.spans(live, found)


def remove(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if wanted, of each row of docs.

    Each byte covered by a string of width bytes that also starts anywhere else
    is removed; overlaps count; strings are judged on the input. Null and empty
    texts have no bytes; texts shorter than width lose none; rows that repeat a text of width bytes or more lose
    all. Rows without an id take part like others. Texts of any length are read whole. An empty table
    gives no rows; other columns are not read. The kept bytes need not be UTF-8.
    """
    prepare(docs.sparkSession)
    rows = anchors.marked(docs, id_col, text_col, True)
    spans = repeated_spans(rows.where("octet_length(text) >= %d and (rep is null or rep = doc)" % width), width)
    spans = compact(spans, "spans")
    every = small_join(rows, spans, ["doc", "t"], "left", anchors.MOST_COPIES)
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *[("kept", pa.binary())] * keep])

    def run(batches):
        for b in batches:
            data, offsets = column_bytes(b.column(1))
            lose = b.column(2).to_pylist()
            out = []
            for i, (s, e) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                body = data[offsets[i] : offsets[i + 1]].tobytes()
                n, k = len(body), 0
                if lose[i] and n >= width:
                    body, k = b"", 1
                elif s:
                    s, e = merged(np.array(s), np.array(e))
                    k = len(s)
                    body = b"".join(body[a:z] for a, z in zip([0, *e.tolist()], [*s.tolist(), n], strict=True))
                out.append((n, n - len(body), k, hashlib.sha256(body).hexdigest(), body)[: 4 + keep])
            yield batch(schema, b.column(0), *zip(*out, strict=True)) if out else batch(schema, *[[]] * len(schema))

    return arrow_map(every.select("id", "text", F.col("rep").isNotNull().alias("copied"), "starts", "ends"), run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep).withColumnRenamed("id", id_col)
