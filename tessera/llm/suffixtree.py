"""Passage deduplication with prefix-partitioned suffix trees over words.

A window is ``width`` consecutive words. Regions that may hold repeated windows
(see anchors) are dealt to shards by anchor. In a shard the suffixes that begin
windows are parted by variable-length prefixes: suffixes are grouped by their
first word, and groups too large for one subtree are parted by longer prefixes
until they fit. Each group's subtree is grown level by level: a node's suffixes
branch by the next words, whose number doubles while a node stays undivided.
Nodes of at least ``width`` words in depth are the repeats; a node knows the
smallest document below it, so a leaf of a larger document under such a node
is a window to remove.

One anchor's regions can be too many for a shard. They are dealt over several,
and each sends its deep nodes (a 128-bit path fingerprint and the smallest
document) and its undecided windows, which are merged by ranges of the fingerprint.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import anchors
from tessera.llm.anchors import RUN, merged
from tessera.llm.common import Packer, arrow_groups, arrow_map, batch, bucket_of, compact, parts, prepare, small_join, starts, unpack
from tessera.llm.wordcore import SAME, SPACE, Words, chunks, column_bytes, digests, inside_rows, sliding_min, window_hashes

GRAM = 10
SHARD_WORDS = 400_000
CROSS_WORDS = 800_000
GROUP_SUFFIXES = 100_000
_CHUNK = 1 << 18
#: The second, independent word hash of path fingerprints.
_SEED = 0xA5A5A5A5DEADBEEF
_NODE = np.dtype([("h", np.uint64), ("g", np.uint64), ("doc", np.int64), ("t", np.int64), ("s", np.int32), ("n", np.int8)])


def find_runs(width: int, gram: int):
    """RUN arrays of texts taken as words; s and n count words."""

    def find(doc, t, column):
        data, offsets = column_bytes(column)
        for i, j in chunks(offsets, _CHUNK):
            o = offsets[i : j + 1]
            words = Words(data[o[0] : o[-1]], o - o[0], SAME, SPACE)
            h = words.hashes()
            row, at = inside_rows(words.first, width)
            if not len(at):
                continue
            m = sliding_min(window_hashes(h, gram), width - gram + 1)
            value = m[at]
            new = starts(value, row)
            s0, e = at[new], at[np.r_[new[1:], len(at)] - 1] + width
            r = np.empty(len(new), RUN)
            r["m"], r["doc"], r["t"] = value[new], doc[i:j][row[new]], t[i:j][row[new]]
            r["f"], r["g"] = digests(h, s0, e)
            r["s"], r["n"], r["own"] = s0 - words.first[row[new]], e - s0, 0
            yield r

    return find


def cut_words(column, row, s, n) -> pa.Array:
    """Each run's words, joined by single blanks."""
    data, offsets = column_bytes(column)
    words = Words(data, offsets, SAME, SPACE)
    first = words.first[row] + s
    out = []
    for a, k in zip(first.tolist(), n.tolist(), strict=True):
        body = data[words.start[a] : words.end[a + k - 1]].tobytes()
        out.append(b" ".join(body.split()) if len(body) != int((words.end[a : a + k] - words.start[a : a + k]).sum()) + k - 1 or _odd(body) else body)
    return pa.array(out, pa.binary())


def _odd(body: bytes) -> bool:
    return any(c in body for c in (b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))


class Forest:
    """The subtrees of a shard's regions. Words are numbered by their own bytes; ends of regions have numbers of their own."""

    def __init__(self, bodies: list[bytes], width: int, group: int = GROUP_SUFFIXES):
        numbers: dict[bytes, int] = {}
        words = [b.split(b" ") for b in bodies]
        sizes = np.array([len(w) for w in words], np.int64)
        self.x = np.array([numbers.setdefault(w, len(numbers)) for own in words for w in own], np.int64)
        self.words = len(numbers)
        self.base = np.cumsum(sizes) - sizes
        self.width = width
        counts = np.maximum(sizes - width + 1, 0)
        self.region = np.repeat(np.arange(len(sizes)), counts)
        self.at = np.arange(len(self.region)) - np.repeat(np.cumsum(counts) - counts, counts) + self.base[self.region]
        #: the node of depth width above each suffix, or -1 where the suffix has none with company
        self.node = np.full(len(self.at), -1, np.int64)
        self.count = 0
        for members, depth in self.prefixes(group):
            self.grow(members, depth)

    def prefixes(self, group: int):
        """(suffixes, prefix length): groups of suffixes with a common prefix, in prefix order; longer prefixes where there are too many."""
        waiting = [(np.arange(len(self.at)), 0)]
        small: list[np.ndarray] = []
        held = 0
        while waiting:
            members, depth = waiting.pop()
            if len(members) <= group or depth >= self.width:
                if depth == 0:
                    yield members, 0
                    continue
                small.append(members)
                held += len(members)
                if held > group:  # several small groups share the memory of one
                    yield np.concatenate(small), 0
                    small, held = [], 0
                continue
            w = self.x[self.at[members] + depth]
            order = np.argsort(w, kind="stable")
            cuts = starts(w[order])
            for part in np.split(members[order], cuts[1:]):
                if len(part) > 1:
                    waiting.append((part, depth + 1))
        if small:
            yield np.concatenate(small), 0

    def grow(self, members: np.ndarray, depth: int) -> None:
        """One subtree from its root down: at each level the open nodes' suffixes branch by the next words."""
        node = np.zeros(len(members), np.int64)
        step = 1
        while len(members) and depth < self.width:
            step = min(step, self.width - depth)
            edge = np.zeros(len(members), np.int64)
            for k in range(step):  # the label of the edge, as a number of its own
                edge = np.unique(edge * self.words + self.x[self.at[members] + depth + k], return_inverse=True)[1]
            order = np.lexsort((edge, node))
            members, node, edge = members[order], node[order], edge[order]
            new = starts(node, edge)
            size = np.diff(np.r_[new, len(members)])
            open_ = np.repeat(size > 1, size)  # leaves alone repeat nothing
            node = np.repeat(np.arange(len(new)), size)[open_]
            members = members[open_]
            depth += step
            step *= 2
        if len(members):
            self.node[members] = node + self.count
            self.count += int(node.max()) + 1


def path_hashes(forest: Forest, at: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of the width words from each place, the same in every shard."""
    data, offsets = column_bytes(pa.array(bodies, pa.binary()))
    words = Words(data, offsets, SAME, SPACE)
    return window_hashes(words.hashes(), forest.width)[at], window_hashes(words.hashes(_SEED), forest.width)[at]


def resolve(shipped: DataFrame, width: int, buckets: int) -> DataFrame:
    """(doc, t, s, e), in words: the spans of pending regions whose windows begin in a smaller document too."""
    schema = pa.schema([("doc", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())])
    plain = pa.schema([schema.field(i) for i in range(4)])

    def group(t: pa.Table) -> pa.Table:
        doc, text, s0, pending = (t.column(c).to_numpy() for c in ("doc", "t", "s", "pending"))
        order = np.lexsort((s0, text, doc))
        keep = order[starts(doc[order], text[order], s0[order])]  # repeated rows of the input ship a region each
        bodies = t.column("body").take(pa.array(keep)).to_pylist()
        doc, text, s0, pending = doc[keep], text[keep], s0[keep], pending[keep]
        forest = Forest(bodies, width)
        own = doc[forest.region]
        least = own.copy()
        deep = forest.node >= 0
        if deep.any():
            smallest = np.full(forest.count, np.iinfo(np.int64).max)
            np.minimum.at(smallest, forest.node[deep], own[deep])
            least[deep] = smallest[forest.node[deep]]
        place = s0[forest.region] + (forest.at - forest.base[forest.region])
        ask = pending[forest.region]
        hit = ask & (least < own)
        k = np.flatnonzero(hit)
        out = []
        if len(k):
            new = np.flatnonzero(np.r_[True, (np.diff(forest.region[k]) != 0) | (np.diff(place[k]) != 1)])
            last = np.r_[new[1:], len(k)] - 1
            r = forest.region[k[new]]
            out.append(batch(schema, doc[r], text[r], place[k[new]].astype(np.int32), (place[k[last]] + width).astype(np.int32), pa.nulls(len(new), pa.int32()), pa.nulls(len(new), pa.binary())))
        if t.column("cross")[0].as_py() and len(forest.at):
            # one row for each window class, with its smallest document; and the windows that still ask
            first = np.ones(len(forest.at), np.bool_)
            idx = np.flatnonzero(deep)
            o = idx[np.lexsort((own[idx], forest.node[idx]))]
            first[idx] = False
            first[o[starts(forest.node[o])]] = True
            k = np.flatnonzero(first | (ask & ~hit))
            rec = np.empty(len(k), _NODE)
            rec["h"], rec["g"] = path_hashes(forest, forest.at[k], bodies)
            r = forest.region[k]
            rec["doc"], rec["t"], rec["s"], rec["n"] = doc[r], text[r], place[k], ask[k] & ~hit[k]
            pack = Packer(buckets, 1 << 62)
            list(pack.add(bucket_of(rec["h"], buckets), rec))
            for b in pack.flush():
                none = [pa.nulls(b.num_rows, x) for x in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
                out.append(batch(schema, *none, *b.columns))
        return pa.Table.from_batches(out, schema)

    found = compact(arrow_groups(shipped.groupBy("shard"), group, "doc long, t long, s int, e int, bucket int, body binary"), "passages")

    def merge(t: pa.Table) -> pa.Table:
        r = unpack(t, _NODE)
        r = r[np.lexsort((r["doc"], r["g"], r["h"]))]
        new = starts(r["h"], r["g"])
        least = np.repeat(r["doc"][new], np.diff(np.r_[new, len(r)]))
        hits = r[(r["n"] == 1) & (least < r["doc"])]
        return pa.Table.from_batches([batch(plain, hits["doc"], hits["t"], hits["s"], (hits["s"] + width).astype(np.int32))])

    crossed = arrow_groups(found.where("body is not null").select("bucket", "body").groupBy("bucket"), merge, "doc long, t long, s int, e int")
    return found.where("body is null").select("doc", "t", "s", "e").unionByName(crossed)


def repeated_spans(texts: DataFrame, width: int, gram: int = GRAM, shard_words: int = SHARD_WORDS, cross_words: int = CROSS_WORDS) -> DataFrame:
    n = parts(texts.sparkSession)
    live = anchors.live_runs(anchors.exchange_runs(texts, find_runs(width, min(gram, width)), 2 * n), True, cross_words)
    size = live.where(F.col("kind") != anchors.FULL).agg(F.count("*").alias("n"), F.sum("n").alias("words")).first()
    shards = max(1, -(-(size.words or 0) // shard_words))
    return anchors.spans(live, resolve(anchors.regions(texts, live, size.n, shards, cut_words), width, 2 * n))


def remove(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """id_col, n_words, n_removed, kept_sha256, and the kept text if wanted, of each row of docs.

    Words are runs of other characters than [\\x20\\x09-\\x0D], unchanged. Each word
    covered by a window of width words that also begins in a document with a
    smaller id is removed, judged on the input. Kept words are joined by single
    blanks. Null and empty texts have no words; texts of fewer than width words
    lose none; of equal texts, those with larger ids lose all; rows that repeat an id and a text fare alike. Rows
    without an id take no part and keep their words. Texts of any length are read
    whole. An empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = anchors.marked(docs, id_col, text_col, False)
    found = compact(repeated_spans(rows.where("text <> '' and id is not null and (rep is null or rep = doc)"), width), "spans")
    every = small_join(rows, found, ["doc", "t"], "left", anchors.MOST_COPIES)
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *[("kept", pa.string())] * keep])

    def run(batches):
        for b in batches:
            out = []
            for text, copied, s, e in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                words = text.encode().split()  # bytes split at just [\x20\x09-\x0D]
                n = len(words)
                if copied and n >= width:
                    words = []
                elif s:
                    s, e = merged(np.array(s), np.array(e))
                    words = [w for a, z in zip([0, *e.tolist()], [*s.tolist(), n], strict=True) for w in words[a:z]]
                body = b" ".join(words)
                out.append((n, n - len(words), hashlib.sha256(body).hexdigest(), body.decode() if keep else None)[: 3 + keep])
            yield batch(schema, b.column(0), *zip(*out, strict=True)) if out else batch(schema, *[[]] * len(schema))

    return arrow_map(every.select("id", "text", F.expr("coalesce(rep < id, false)").alias("copied"), "starts", "ends"), run, "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep).withColumnRenamed("id", id_col)
