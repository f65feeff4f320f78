"""N-gram Jaccard join with grouped prefixes.

A text's set is its distinct shingles. Shingles have one global order, rare ones
first, by a count sketch of a fixed size over all texts. Two sets of sufficient similarity
share a shingle among the first n - ceil(t n) + 1 of each (the prefix), so only
texts that share a prefix shingle are candidates, less those whose sizes or
places rule it out.

Equal sets are one class, and classes with equal prefixes and sizes one group;
only groups have postings. The join goes in two rounds, as components are wanted and not all pairs:
first each group is compared with one centre, the one that shares most of its
prefix, and links join components. Then the candidate pairs between different
components are formed, of groups parted by component and expanded into members, filtered by an upper
bound of their overlap (the sum of least counts of 256 hash classes), and compared.
No link between components is lost; links inside one need not be made. A
centre's members are compared in blocks of a bounded number.

Shingles with very many postings are told by a count sketch. Theirs are not
gathered: each meets the shingle's least group, found by a minimum that is
taken map-side first, and in the second round tiles of them meet in pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import anchors
from tessera.llm.common import BROADCAST_BYTES, PACKED_DDL, Held, Packer, arrow_groups, arrow_map, batch, bucket_of, bytes_of, compact, parts, prepare, small_join, starts, unpack
from tessera.llm.components import components
from tessera.llm.wordcore import LOWER, SPACE, Words, chunks, column_bytes, inside_rows, mix, window_hashes

SKETCH_BITS = 22
_PIECE_BITS = 14
BINS = 256
MEMBERS = 256
#: Broadcast up to so many bytes.
MOST = MOST_PAIRS = BROADCAST_BYTES
_CHUNK = 1 << 18
_POST = np.dtype([("tok", np.uint64), ("gid", np.int64), ("n", np.int32), ("pos", np.int32)])
#: Groups that share a shingle with so many others bring their counts along, so that their pairs are bounded where they are formed.
DENSE = 16
_EDGE = np.dtype([("b", np.int64), ("a", np.int64), ("k", np.int32)])
#: A shingle of more groups is dealt into tiles of about so many, which meet in pairs in different tasks.
SPLIT = 512
#: side: 1 and 2 of a pair of tiles, whose entries meet those of the other side only; else 0.
_LIVE = np.dtype([("tok", np.uint64), ("gid", np.int64), ("n", np.int32), ("pos", np.int32), ("comp", np.int64), ("side", np.int8)])
_INFO = np.dtype([("gid", np.int64), ("comp", np.int64), ("sub", np.int64), ("n", np.int64), ("bins", np.uint8, BINS)])
_SHARED = np.dtype([*_POST.descr, ("df", np.int32)])
#: Postings of one shingle (of one class of a count sketch) that are gathered in a task at most, or eight times the mean of all classes if that is more.
MOST_POSTS = 250_000


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the shingles of each text. A text of fewer words, but not none, has its whole sequence as one."""
    words = Words(data, offsets, LOWER, SPACE)
    h = words.hashes()
    row, at = inside_rows(words.first, width)
    value = window_hashes(h, width)[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for k in range(1, width):
            own = np.flatnonzero(n[short] == k)
            if len(own):
                extra[own] = mix(window_hashes(h, k)[words.first[short[own]]] + np.uint64(k))
        row, value = np.concatenate([row, short]), np.concatenate([value, extra])
    return row, value


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, by row and hash."""
    row, value = shingles(data, offsets, width)
    order = np.argsort(value)
    order = order[by_row(row[order], len(offsets) - 1)]
    row, value = row[order], value[order]
    new = starts(row, value)
    return row[new], value[new]


def by_row(row: np.ndarray, rows: int) -> np.ndarray:
    """The stable order by row. Few rows fit in 16 bits, which numpy sorts in linear time."""
    return np.argsort(row.astype(np.uint16) if rows < 1 << 16 else row, kind="stable")


def sketch(texts: DataFrame, width: int) -> np.ndarray:
    """The order class of each of 2**SKETCH_BITS hash classes: the bits of the number of its shingles in all texts. Four megabytes, at any size of input."""
    pieces = 1 << (SKETCH_BITS - _PIECE_BITS)

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        held, size = [], 0

        def count():
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            total[seen] += n.astype(np.uint32)

        for b in batches:
            data, offsets = column_bytes(b.column(0))
            for i, j in chunks(offsets, _CHUNK):
                o = offsets[i : j + 1]
                _, value = shingles(data[o[0] : o[-1]], o - o[0], width)
                held.append((value >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
                size += len(value)
                if size > 1 << 20:
                    count()
                    held, size = [], 0
        if held:
            count()
        for k, x in enumerate(total.reshape(pieces, -1)):
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.astype(np.uint8 if x.max() < 256 else np.uint32).tobytes()], pa.binary())], names=["bucket", "body"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << _PIECE_BITS, np.int64)
        for body in t.column("body").to_pylist():
            total += np.frombuffer(body, {1: np.uint8, 4: np.uint32}[len(body) >> _PIECE_BITS])
        bits = np.ceil(np.log2(total + 1)).astype(np.uint8)
        return pa.table({"bucket": t.column("bucket")[:1], "body": pa.array([bits.tobytes()], pa.binary())})

    out = np.zeros((pieces, 1 << _PIECE_BITS), np.uint8)
    for r in arrow_groups(arrow_map(texts.select("text"), run, PACKED_DDL).groupBy("bucket"), add, PACKED_DDL).collect():
        out[r.bucket] = np.frombuffer(r.body, np.uint8)
    return out.ravel()


def described(texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc, n, f, g, p, prefix, bins): size, fingerprints of the set (f, g) and of its prefix (p), the prefix shingles in order, counts by hash class."""
    order_of = texts.sparkSession.sparkContext.broadcast(sketch(texts, width))
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("f", pa.int64()), ("g", pa.int64()), ("p", pa.int64()), ("prefix", pa.binary()), ("bins", pa.binary())])

    def run(batches):
        rarity = order_of.value
        for b in batches:
            data, offsets = column_bytes(b.column(1))
            for i, j in chunks(offsets, _CHUNK):
                o = offsets[i : j + 1]
                m = j - i
                row, value = shingle_sets(data[o[0] : o[-1]], o - o[0], width)
                n = np.bincount(row, minlength=m)
                first = np.cumsum(n) - n
                f, g, p = (np.zeros(m, np.uint64) for _ in range(3))
                some = np.flatnonzero(n)
                bins = np.zeros((m, BINS), np.int64)
                prefix = [b""] * m
                if len(some):
                    f[some] = np.add.reduceat(mix(value), first[some])
                    g[some] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), first[some])
                    bins = np.bincount(row * BINS + (value >> np.uint64(8)).astype(np.int64) % BINS, minlength=m * BINS).reshape(m, BINS)
                    order = np.argsort(rarity[(value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                    value = value[order[by_row(row[order], m)]]
                    length = n - -(-n * num // den) + 1
                    pos = np.arange(len(value)) - np.repeat(first, n)
                    h = np.where(pos < np.repeat(length, n), mix(value + pos.astype(np.uint64)), np.uint64(0))
                    p[some] = np.add.reduceat(h, first[some])
                    prefix = [value[a : a + k].tobytes() if k > 0 and c else b"" for a, k, c in zip(first.tolist(), length.tolist(), n.tolist(), strict=True)]
                yield batch(schema, b.column(0).slice(i, m), n, f.view(np.int64), g.view(np.int64), p.view(np.int64), prefix, [x.tobytes() for x in np.minimum(bins, 255).astype(np.uint8)])

    return arrow_map(texts, run, "doc long, n long, f long, g long, p long, prefix binary, bins binary")


def fits(na, pa_, nb, pb, num: int, den: int) -> np.ndarray:
    """Whether sizes and the places of a first common shingle allow a similarity of num / den."""
    need = -(-num * (na + nb) // (num + den))
    return (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) & (1 + np.minimum(na - pa_, nb - pb) - 1 >= need)


def postings(groups: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        pack = Packer(buckets, 16 << 20)
        for b in batches:
            n = b.column(1).to_numpy(zero_copy_only=False)
            data, offsets = column_bytes(b.column(2))
            tok = np.frombuffer(data.tobytes(), np.uint64)
            size = np.diff(offsets) // 8
            r = np.empty(len(tok), _POST)
            r["tok"], r["gid"], r["n"] = tok, np.repeat(b.column(0).to_numpy(zero_copy_only=False), size), np.repeat(n, size)
            r["pos"] = np.arange(len(tok)) - np.repeat(np.cumsum(size) - size, size)
            yield from pack.add(bucket_of(mix(tok), buckets), r)
        yield from pack.flush()

    return arrow_map(groups.select("doc", "n", "prefix"), run, PACKED_DDL)


def very_common(packed: DataFrame):
    """The classes of shingles with too many postings for a task, as a broadcast of a bit for each class; None if there are none."""
    sizes = anchors.class_counts(packed, _POST, "tok")
    common = sizes > anchors.common_size(sizes, MOST_POSTS)
    return packed.sparkSession.sparkContext.broadcast(common) if common.any() else None


def headed(packed: DataFrame, common) -> DataFrame:
    """(tok, gid, n, pos, head, df) of the postings of very common shingles, each beside the shingle's least group (head: gid, n, pos). Nothing is gathered by shingle but that minimum."""
    schema = pa.schema([("tok", pa.int64()), ("gid", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches):
        for b in batches:
            r = unpack(pa.Table.from_batches([b]), _POST)
            r = r[common.value[anchors.class_of(r["tok"])]]
            yield batch(schema, r["tok"].copy().view(np.int64), r["gid"], r["n"], r["pos"])

    rows = arrow_map(packed, run, "tok long, gid long, n int, pos int")
    heads = compact(rows.groupBy("tok").agg(F.min(F.struct("gid", "n", "pos")).alias("head"), F.count("*").alias("df")).where("df > 1"), "heads", 500_000)
    return compact(small_join(rows, heads, "tok").select("tok", "gid", "n", "pos", F.col("head.gid").alias("gid0"), F.col("head.n").alias("n0"), F.col("head.pos").alias("pos0"), F.least("df", F.lit(1 << 30)).cast("int").alias("df")), "headed", 500_000)


def repacked(rows: DataFrame, kind: np.dtype, make, by: str, buckets: int) -> DataFrame:
    """Records of a kind, made of headed() rows (as arrays by name), packed by a field."""

    def run(batches):
        pack = Packer(buckets, 16 << 20)
        for b in batches:
            r = make({n: b.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(b.schema.names)})
            yield from pack.add(bucket_of(mix(r[by].copy().view(np.uint64)), buckets), r)
        yield from pack.flush()

    return arrow_map(rows, run, PACKED_DDL)


def as_shared(x: dict) -> np.ndarray:
    r = np.empty(len(x["tok"]), _SHARED)
    r["tok"] = x["tok"].view(np.uint64)
    for name in ("gid", "n", "pos", "df"):
        r[name] = x[name]
    return r


def as_edges(num: int, den: int):
    def make(x: dict) -> np.ndarray:
        ok = (x["gid0"] < x["gid"]) & fits(x["n0"].astype(np.int64), x["pos0"], x["n"].astype(np.int64), x["pos"], num, den)
        e = np.empty(int(ok.sum()), _EDGE)
        e["a"], e["b"], e["k"] = x["gid0"][ok], x["gid"][ok], 1
        return e

    return make


def shared_postings(packed: DataFrame, buckets: int, common=None) -> DataFrame:
    """The postings of shingles that several groups have, packed by group; without those of very common classes."""

    def group(t: pa.Table) -> pa.Table:
        r = unpack(t, _POST)
        if common is not None:
            r = r[~common.value[anchors.class_of(r["tok"])]]
        r = r[np.argsort(r["tok"], kind="stable")]
        at = starts(r["tok"])
        size = np.diff(np.r_[at, len(r)])
        keep = np.repeat(size > 1, size)
        out = np.empty(int(keep.sum()), _SHARED)
        for name in _POST.names:
            out[name] = r[name][keep]
        out["df"] = np.minimum(np.repeat(size, size)[keep], 1 << 30)
        pack = Packer(buckets, 1 << 62)
        list(pack.add(bucket_of(mix(out["gid"].view(np.uint64)), buckets), out))
        return pa.Table.from_batches(list(pack.flush()), pa.schema([("bucket", pa.int32()), ("body", pa.binary())]))

    return arrow_groups(packed.groupBy("bucket"), group, PACKED_DDL)


def centres(live: DataFrame, buckets: int, num: int, den: int, common=None, more: DataFrame | None = None) -> DataFrame:
    """(a, b): for each group b the group a < b that shares most shingles with it, of those that are the least group of a shared shingle. more: the edges of very common shingles, which aren't gathered here."""

    def by_token(batches):
        pack = Packer(buckets, 16 << 20)
        for b in batches:
            r = unpack(pa.Table.from_batches([b]), _SHARED)
            if common is not None:
                r = r[~common.value[anchors.class_of(r["tok"])]]
            yield from pack.add(bucket_of(mix(r["tok"]), buckets), r)
        yield from pack.flush()

    def edges(t: pa.Table) -> pa.Table:
        r = unpack(t, _SHARED)
        r = r[np.lexsort((r["gid"], r["tok"]))]
        at = starts(r["tok"])
        first = np.repeat(at, np.diff(np.r_[at, len(r)]))
        c = r[first]
        ok = (c["gid"] < r["gid"]) & fits(c["n"].astype(np.int64), c["pos"], r["n"].astype(np.int64), r["pos"], num, den)
        a, b = c["gid"][ok], r["gid"][ok]
        order = np.lexsort((a, b))
        a, b = a[order], b[order]
        new = starts(b, a)
        e = np.empty(len(new), _EDGE)
        e["a"], e["b"], e["k"] = a[new], b[new], np.diff(np.r_[new, len(a)])
        pack = Packer(buckets, 1 << 62)
        list(pack.add(bucket_of(mix(e["b"].view(np.uint64)), buckets), e))
        return pa.Table.from_batches(list(pack.flush()), pa.schema([("bucket", pa.int32()), ("body", pa.binary())]))

    def best(t: pa.Table) -> pa.Table:
        e = unpack(t, _EDGE)
        e = e[np.lexsort((e["a"], e["b"]))]
        new = starts(e["b"], e["a"])
        if not len(new):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        k = np.add.reduceat(e["k"].astype(np.int64), new)
        e = e[new]
        e = e[np.lexsort((e["a"], -k, e["b"]))]
        e = e[starts(e["b"])]
        return pa.table({"a": pa.array(e["a"], pa.int64()), "b": pa.array(e["b"], pa.int64())})

    found = arrow_groups(arrow_map(live, by_token, PACKED_DDL).groupBy("bucket"), edges, PACKED_DDL)
    return arrow_groups((found if more is None else found.unionByName(more)).groupBy("bucket"), best, "a long, b long")


def reachable(u: np.ndarray, v: np.ndarray, na: np.ndarray, nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the overlap can reach the need: the sum of the lesser counts of each hash class bounds it. Counts of 255 stand for any number."""
    least = np.minimum(u, v)
    return (least == 255).any(1) | (least.sum(1, dtype=np.int64) >= -(-num * (na + nb) // (num + den)))


def parted(r: np.ndarray) -> np.ndarray:
    """One record for each group's members in one component, a part: the least of them (sub) and the greatest of their counts, which bound each member's overlap."""
    r = r[np.lexsort((r["sub"], r["comp"], r["gid"]))]
    at = starts(r["gid"], r["comp"])
    out = r[at]
    if len(at) < len(r):
        out["bins"] = np.maximum.reduceat(r["bins"], at)
    return out


def tiled(live: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(live, place of each in the input): the entries of very common shingles, once for each pair of tiles that theirs is in, under a shingle of the pair's own."""
    tiles = -(-df // SPLIT)
    some = np.flatnonzero(tiles > 1)
    if not len(some):
        return live, np.arange(len(live))
    own = (mix(live["gid"][some].view(np.uint64)) % tiles[some].astype(np.uint64)).astype(np.int64)
    at = np.repeat(some, tiles[some])
    other = np.arange(len(at)) - np.repeat(np.cumsum(tiles[some]) - tiles[some], tiles[some])
    own = np.repeat(own, tiles[some])
    out = live[at]
    low, high = np.minimum(own, other), np.maximum(own, other)
    out["tok"] = mix(out["tok"] ^ mix((low << 32 | high).astype(np.uint64)))
    out["side"] = np.where(low == high, 0, np.where(own == low, 1, 2))
    few = np.flatnonzero(tiles <= 1)
    return np.concatenate([live[few], out]), np.concatenate([few, at])


def cross_pairs(live: DataFrame, sets: DataFrame, buckets: int, num: int, den: int) -> DataFrame:
    """(a, b), a < b: the candidate pairs of parts of groups in different components, by their least members. sets: doc, leader, comp, n, bins."""

    def by_group(batches):
        pack = Packer(buckets, 16 << 20)
        for b in batches:
            r = np.empty(b.num_rows, _INFO)
            r["gid"], r["comp"], r["sub"], r["n"] = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            r["bins"] = np.frombuffer(column_bytes(b.column(4))[0].tobytes(), np.uint8).reshape(-1, BINS)
            r = parted(r)
            yield from pack.add(bucket_of(mix(r["gid"].view(np.uint64)), buckets), r)
        yield from pack.flush()

    kinds = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])

    def packed(kind: int, bucket: np.ndarray, records: np.ndarray):
        pack = Packer(buckets, 1 << 62)
        list(pack.add(bucket, records))
        for b in pack.flush():
            yield batch(kinds, b.column(0), np.full(b.num_rows, kind, np.int32), b.column(1))

    def label(left: pa.Table, right: pa.Table) -> pa.Table:
        r, g = unpack(left, _SHARED), unpack(right, _INFO)
        if not len(r):
            return pa.Table.from_batches([], kinds)
        g = parted(g)
        lo, hi = (np.searchsorted(g["gid"], r["gid"], side) for side in ("left", "right"))
        size = hi - lo  # a group has postings for each of its parts
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        r = r[np.repeat(np.arange(len(r)), size)]
        out = np.empty(len(r), _LIVE)
        for name in _POST.names:
            out[name] = r[name]
        out["gid"], out["comp"], out["side"] = g["sub"][k], g["comp"][k], 0
        out, at = tiled(out, r["df"])
        k = k[at]
        bucket = bucket_of(mix(out["tok"]), buckets)
        dense = np.flatnonzero(r["df"][at] >= DENSE)
        both = np.unique(np.column_stack([bucket[dense].astype(np.int64), k[dense]]), axis=0)
        return pa.Table.from_batches([*packed(0, bucket, out), *packed(1, both[:, 0].astype(np.int32), g[both[:, 1]])], kinds)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bounded(p: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The pairs less those that the counts at hand rule out."""
        if not len(p) or not len(g):
            return p
        ok = np.ones(len(p), np.bool_)
        i, j = (np.minimum(np.searchsorted(g["sub"], p[:, c]), len(g) - 1) for c in (0, 1))
        known = np.flatnonzero((g["sub"][i] == p[:, 0]) & (g["sub"][j] == p[:, 1]))
        for at in range(0, len(known), 50_000):
            k = known[at : at + 50_000]
            u, v = g[i[k]], g[j[k]]
            ok[k] = reachable(u["bins"], v["bins"], u["n"], v["n"], num, den)
        return p[ok]

    def pairs(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        r = unpack(t.filter(pa.array(kind == 0)), _LIVE)
        g = unpack(t.filter(pa.array(kind == 1)), _INFO)
        g = g[np.argsort(g["sub"], kind="stable")]
        own = np.where(r["side"] == 0, r["comp"], r["side"])
        order = np.lexsort((own, r["tok"]))
        r, own = r[order], own[order]
        at, run = starts(r["tok"]), starts(r["tok"], own)
        end = np.repeat(np.r_[at[1:], len(r)], np.diff(np.r_[at, len(r)]))
        skip = np.repeat(np.r_[run[1:], len(r)], np.diff(np.r_[run, len(r)]))
        k = end - skip  # each entry meets the entries of later components, or of the other tile, only
        out, found = [], 0
        who = np.flatnonzero(k)
        total = np.cumsum(k[who])
        lo = 0
        while lo < len(who):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + 500_000)))
            own = who[lo:hi]
            i = np.repeat(own, k[own])
            j = np.arange(len(i)) - np.repeat(np.cumsum(k[own]) - k[own], k[own]) + np.repeat(skip[own], k[own])
            ok = (r["gid"][i] != r["gid"][j]) & (r["comp"][i] != r["comp"][j]) & fits(r["n"][i].astype(np.int64), r["pos"][i], r["n"][j].astype(np.int64), r["pos"][j], num, den)
            x, y = r["gid"][i[ok]], r["gid"][j[ok]]
            if len(x):
                out.append(bounded(np.unique(np.column_stack([np.minimum(x, y), np.maximum(x, y)]), axis=0), g))
                found += len(out[-1])
                if found > 2_000_000:
                    out = [np.unique(np.concatenate(out), axis=0)]
                    found = len(out[0])
            lo = hi
        p = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.Table.from_batches([batch(schema, p[:, 0], p[:, 1])])

    info = arrow_map(sets.select(F.coalesce("leader", "doc"), "comp", "doc", "n", "bins"), by_group, PACKED_DDL)
    labelled = arrow_groups(live.groupBy("bucket").cogroup(info.groupBy("bucket")), label, "bucket int, kind int, body binary")
    return arrow_groups(labelled.groupBy("bucket"), pairs, "a long, b long").distinct()


def inner_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b), a < b, of members (key, doc, c, tiles, n, bins) of one group in different components whose counts let them be similar. Tiles of a group meet in pairs."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    own = F.pmod(F.xxhash64("doc"), "tiles").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = members.withColumn("own", own).withColumn("other", other).select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc", "c", "n", "bins")

    def meet(t: pa.Table) -> pa.Table:
        low, high, own, doc, c, n = (t.column(x).to_numpy() for x in ("low", "high", "own", "doc", "c", "n"))
        bins = np.frombuffer(column_bytes(t.column("bins"))[0].tobytes(), np.uint8).reshape(-1, BINS)
        left, right = np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0])
        out = []
        for i in left.tolist():
            j = right[(c[right] != c[i]) & (doc[right] > doc[i] if low[0] == high[0] else doc[right] != doc[i])]
            j = j[reachable(bins[j], bins[i][None, :], n[j], n[i], num, den)]
            out.append(np.column_stack([np.minimum(doc[j], doc[i]), np.maximum(doc[j], doc[i])]))
        p = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.Table.from_batches([batch(schema, p[:, 0], p[:, 1])])

    return arrow_groups(dealt.groupBy("key", "low", "high"), meet, "a long, b long")


def possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose overlap can reach the need, by their counts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for x in batches:
            if x.num_rows:
                u, v = (np.frombuffer(column_bytes(x.column(i))[0].tobytes(), np.uint8).reshape(-1, BINS) for i in (2, 4))
                na, nb = (x.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
                yield x.select([0, 1]).filter(pa.array(reachable(u, v, na, nb, num, den))).cast(schema)

    s = sets.select("doc", "bins", "n")
    both = pairs.join(s.withColumnsRenamed({"doc": "a", "bins": "ua", "n": "na"}), "a").join(s.withColumnsRenamed({"doc": "b", "bins": "ub", "n": "nb"}), "b")
    return arrow_map(both.select("a", "b", "ua", "na", "ub", "nb"), run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are similar: each a is compared with blocks of at most about MEMBERS of its b."""
    pairs = compact(pairs, "pairs")
    blocks = pairs.groupBy("a").agg((F.floor(F.count("*") / MEMBERS) + 1).alias("blocks"))
    dealt = small_join(pairs, blocks, "a", "inner", MOST).withColumn("block", F.pmod(F.xxhash64("b"), "blocks"))
    sent = dealt.select("a", "block", F.col("b").alias("doc"), F.lit(False).alias("centre")).unionByName(dealt.select("a", "block", F.col("a").alias("doc"), F.lit(True).alias("centre")).distinct())
    rows = small_join(texts, sent, "doc", "inner", MOST_PAIRS, 2 * bytes_of(pairs)).select("a", "block", "doc", "centre", "text")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(t: pa.Table) -> pa.Table:
        data, offsets = column_bytes(t.column("text"))
        centre, doc = t.column("centre").to_numpy(), t.column("doc").to_numpy()
        out = np.zeros(0, np.int64)
        for c in np.flatnonzero(centre)[:1]:
            _, own = shingle_sets(data[offsets[c] : offsets[c + 1]], offsets[c : c + 2] - offsets[c], width)
            for i, j in chunks(offsets, _CHUNK) if len(own) else ():
                o = offsets[i : j + 1]
                row, value = shingle_sets(data[o[0] : o[-1]], o - o[0], width)
                n = np.bincount(row, minlength=j - i)
                k = np.minimum(np.searchsorted(own, value), len(own) - 1)
                both = np.bincount(row[own[k] == value], minlength=j - i)
                hit = ~centre[i:j] & (den * both >= num * (n + len(own) - both)) & (n > 0)
                out = np.union1d(out, doc[i:j][hit])
        return pa.Table.from_batches([batch(schema, np.full(len(out), t.column("a")[0].as_py()), np.asarray(out, np.int64))])

    return arrow_groups(rows.groupBy("a", "block"), compare, "a long, b long")


def join(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles and component_id (the smallest id reachable by links of similarity num / den at least) of each row of docs.

    Words are runs of other characters than [\\x20\\x09-\\x0D], A-Z lower-cased. Null
    and empty texts have no shingles and are linked with nothing: their
    component is their own id. Equal sets are linked. Rows that repeat an id are one document;
    rows without an id have a null component. Ties don't matter: a component has one least id.
    """
    spark = docs.sparkSession
    prepare(spark)
    buckets = 2 * parts(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    with Held() as held:
        every = held(described(texts, width, num, den))
        some = every.where("n > 0 and doc is not null")
        equal = compact(some.groupBy("n", "f", "g").agg(F.min("doc").alias("rep"), F.count("*").alias("k")).where("k > 1").drop("k"), "classes")
        classed = small_join(every, equal, ["n", "f", "g"], "left", MOST)
        nodes = compact(classed.select("doc", "n", F.coalesce("rep", "doc").alias("node")), "nodes", 500_000)
        sets = classed.where("n > 0 and doc is not null and (rep is null or rep = doc)")
        alike = compact(sets.groupBy("n", "p").agg(F.min("doc").alias("leader"), F.count("*").alias("k")).where("k > 1").drop("k"), "groups")
        grouped = small_join(sets, alike, ["n", "p"], "left", MOST)
        leaders = grouped.where("leader is null or leader = doc")
        packed = held(postings(leaders, buckets))
        common, more = very_common(packed), None
        live = shared_postings(packed, buckets, common)
        if common is not None:
            hot = headed(packed, common)
            live, more = live.unionByName(repacked(hot, _SHARED, as_shared, "gid", buckets)), repacked(hot, _EDGE, as_edges(num, den), "b", buckets)
        live = compact(live, "live", 5_000)
        members = compact(grouped.where("leader is not null").select("leader", "doc"), "members")

        first = centres(live, buckets, num, den, common, more).unionByName(members.where("leader <> doc").select(F.col("leader").alias("a"), F.col("doc").alias("b")))
        links = compact(verified(first, texts, width, num, den), "links")
        comps = compact(components(links), "components")
        # candidates between components: pairs of groups' parts, each of one component, expanded into members, and pairs inside a group
        labelled = small_join(grouped, comps.withColumnsRenamed({"node": "doc", "component": "comp"}), "doc", "left", MOST).withColumn("comp", F.coalesce("comp", "doc"))
        wide = cross_pairs(live, labelled, buckets, num, den)
        mixed = small_join(members.withColumnRenamed("leader", "key"), comps.withColumnRenamed("node", "doc"), "doc", "left", MOST).select("key", "doc", F.coalesce("component", "doc").alias("c"))
        part = compact(mixed.groupBy("key", "c").agg(F.min("doc").alias("sub"), F.count("*").alias("size")), "parts")
        m = compact(small_join(mixed, part.drop("size"), ["key", "c"], "inner", MOST).select(F.col("sub").alias("key"), "doc"), "members")
        for side in ("a", "b"):
            wide = small_join(wide.withColumnRenamed(side, "key"), m, "key", "left", MOST).select(F.coalesce("doc", "key").alias(side), "b" if side == "a" else "a")
        # inside a group, only where its members are in several components, and then between these
        split = part.groupBy("key").agg(F.count("*").alias("k"), F.sum("size").alias("size")).where("k > 1").select("key", F.ceil(F.col("size") / SPLIT).cast("int").alias("tiles"))
        inner = inner_pairs(mixed.join(split, "key").join(sets.select("doc", "n", "bins"), "doc"), num, den)
        second = wide.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(inner)
        for side in ("a", "b"):
            second = small_join(second, comps.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left", MOST)
        second = second.where("a <> b and coalesce(ca, a) <> coalesce(cb, b)").select("a", "b").distinct()
        links = compact(links.unionByName(verified(possible(second, sets, num, den), texts, width, num, den)), "links")
    comps = compact(components(links), "components")
    out = small_join(nodes, comps, "node", "left", MOST)
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))
