"""Benchmark decontamination with a positional inverted index.

The index is sharded by document: each run of documents that a task reads is a
shard, whose postings are one array of (term, position) in ascending order. A
test window is looked up from its rarest term in the shard: that term's
postings, less the term's offset, are the candidate starts; the next rarest
terms' lists, adjusted by their offsets, are intersected one after another by
binary search, so that each list touched is cut by the rarest ones. With a slop
of 0 a match is an exact phrase; with a larger slop every term must stand within
that many words of its place (a proximity match).

The index needs no exchange: documents stay where they are read, only the test
windows travel, equal ones once. They are sent in blocks of a bounded size. A
larger test set is matched block by block: each pass writes the documents it
has matched to the shared folder, and its block is released before the next.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, batch, column_ints, compact, prepare
from tessera.llm.common import starts as starts_of
from tessera.llm.wordcore import LOWER, Words, chunks, column_bytes, inside_rows, mix, window_hashes

#: [\x00-\x2F\x3A-\x60\x7B-\x7F] less A-Z, which are lower-cased first.
SEPARATORS = np.zeros(256, np.bool_)
SEPARATORS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
SEPARATORS[0x41:0x5B] = False

_SHARD_BYTES = 1 << 20
#: Test windows are sent to executors in blocks of at most so many bytes of test text.
BLOCK_BYTES = 16 << 20
_CANDIDATES = 1 << 20


class Windows:
    """The distinct test windows: their words as term numbers in one array (flat), where each begins (at), its length, and the items that have it."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int):
        data, offsets = column_bytes(pa.array([t for _, t in items], pa.string()))
        words = Words(data, offsets, LOWER, SEPARATORS)
        h = words.hashes()
        self.vocabulary, flat = np.unique(h, return_inverse=True)
        self.flat = flat.astype(np.int32)
        n = np.diff(words.first)
        item, at = inside_rows(words.first, width)
        name = window_hashes(h, width)[at]
        length = np.full(len(at), width)
        for k in range(1, width):  # an item of fewer words is one window
            own = np.flatnonzero(n == k)
            if len(own):
                item, at = np.r_[item, own], np.r_[at, words.first[own]]
                name, length = np.r_[name, mix(window_hashes(h, k)[words.first[own]] + np.uint64(k))], np.r_[length, np.full(len(own), k)]
        order = np.lexsort((item, name))
        item, at, name, length = item[order], at[order], name[order], length[order]
        new = starts_of(name)
        self.at, self.length = at[new], length[new]
        #: The items of window w are item[first[w]:first[w + 1]], as places in names.
        ids = [i for i, _ in items]
        self.names = sorted({i for i in ids if i is not None})
        place = {i: k for k, i in enumerate(self.names)}
        # an item without an id can't be named: its windows count as hits of none
        number = np.array([place.get(i, -1) for i in ids], np.int64)[item]
        known = np.flatnonzero(number >= 0)
        owner = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(item)]))
        self.item = number[known].astype(np.int32)
        self.first = np.searchsorted(owner[known], np.arange(len(new) + 1))
        self.names = np.array(self.names, np.int64)

    def items_of(self, row: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, id) of the different items of the windows matched in each row, ascending."""
        both = np.unique(row.astype(np.int64) << 32 | window)
        row, window = both >> 32, both & 0xFFFFFFFF
        size = self.first[window + 1] - self.first[window]
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[window], size)
        both = np.unique(np.repeat(row, size) << 32 | self.item[k])
        return both >> 32, self.names[both & 0xFFFFFFFF]


class Shard:
    """The postings of some texts, for the terms of a vocabulary."""

    def __init__(self, words: Words, vocabulary: np.ndarray):
        h = words.hashes()
        at = np.searchsorted(vocabulary, h)
        at[at == len(vocabulary)] = 0
        known = np.flatnonzero(vocabulary[at] == h) if len(vocabulary) else np.zeros(0, np.int64)
        terms = at[known]
        order = np.argsort(terms, kind="stable")
        #: (term, position), ascending, as one number each
        self.postings = terms[order] << 32 | known[order]
        self.count = np.bincount(terms, minlength=len(vocabulary))
        self.begin = np.cumsum(self.count) - self.count
        self.first = words.first
        self.row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        self.n = len(h)

    def near(self, term: np.ndarray, place: np.ndarray, row: np.ndarray, slop: int) -> np.ndarray:
        """Whether a posting of term is within slop of place, in the same text."""
        low = np.maximum(place - slop, self.first[row])
        i = np.searchsorted(self.postings, term << 32 | low)
        i[i == len(self.postings)] = 0
        found = self.postings[i]
        at = found & 0xFFFFFFFF
        return (found >> 32 == term) & (at >= low) & (at <= np.minimum(place + slop, self.first[row + 1] - 1))

    def match(self, windows: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of the matches inside one text. Candidates are made in slices of about _CANDIDATES."""
        empty = np.zeros(0, np.int64)
        if not len(self.postings) or not len(windows.at):
            return empty, empty
        absent = np.r_[0, np.cumsum(self.count[windows.flat] == 0)]
        alive = np.flatnonzero(absent[windows.at + windows.length] == absent[windows.at])
        if not len(alive):
            return empty, empty
        width = int(windows.length[alive].max())
        inside = np.arange(width) < windows.length[alive][:, None]
        terms = windows.flat[np.minimum(windows.at[alive][:, None] + np.arange(width), len(windows.flat) - 1)].astype(np.int64)
        order = np.argsort(np.where(inside, self.count[terms], np.iinfo(np.int64).max), axis=1, kind="stable")
        sizes = self.count[terms[np.arange(len(alive)), order[:, 0]]]
        total = np.cumsum(sizes)
        out, lo = [], 0
        while lo < len(alive):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + _CANDIDATES)))
            out.append(self._slice(np.arange(lo, hi), terms, order, windows.length[alive], sizes, slop))
            lo = hi
        window, start = alive[np.concatenate([w for w, _ in out])], np.concatenate([s for _, s in out])
        if slop and len(window):  # the same place found from two postings of the rarest term
            both = np.unique(np.column_stack([window, start]), axis=0)
            window, start = both[:, 0], both[:, 1]
        return window, start

    def _slice(self, own, terms, order, length, sizes, slop: int) -> tuple[np.ndarray, np.ndarray]:
        offset, size = order[own, 0], sizes[own]
        window = np.repeat(own, size)
        k = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.begin[terms[own, offset]], size)
        start = (self.postings[k] & 0xFFFFFFFF) - np.repeat(offset, size)
        last = start + length[window] - 1
        ok = (start >= 0) & (last < self.n)
        window, start, last = window[ok], start[ok], last[ok]
        ok = self.row[start] == self.row[last]
        window, start = window[ok], start[ok]
        for rank in range(1, terms.shape[1]):
            if not len(window):
                break
            offset = order[window, rank]
            ok = (length[window] <= rank) | self.near(terms[window, offset], start + offset, self.row[start], slop)
            window, start = window[ok], start[ok]
        return window, start


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The test items in blocks whose text is bounded, by a hash of the row."""
    items = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes) * 2 if size > block_bytes else 1)
    for k in range(n):
        yield n, [(r.id, r.text) for r in (items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)).collect()]


SCHEMA = pa.schema([("id", pa.int64()), ("t", pa.int64()), ("u", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])
DDL = "id long, t long, u long, n_words long, starts array<int>, ends array<int>, items array<long>"


def _pass(rows: DataFrame, windows, slop: int, every: bool) -> DataFrame:
    """One block of windows against all rows (id, text, t, u); only the rows with matches unless every."""

    def run(batches):
        w = windows.value
        for b in batches:
            data, offsets = column_bytes(b.column(1))
            for i, j in chunks(offsets, _SHARD_BYTES):
                o = offsets[i : j + 1]
                words = Words(data[o[0] : o[-1]], o - o[0], LOWER, SEPARATORS)
                shard = Shard(words, w.vocabulary)
                window, start = shard.match(w, slop)
                if not every and not len(start):
                    continue
                row = shard.row[start] if len(start) else start
                order = np.lexsort((w.length[window], start))
                window, start, row = window[order], start[order], row[order]
                rows = np.arange(j - i + 1)
                cuts = np.searchsorted(row, rows).astype(np.int32)
                owner, item = w.items_of(row, window)
                place = start - words.first[row]
                lists = [column_ints(place, cuts, pa.int32()), column_ints(place + w.length[window], cuts, pa.int32()), column_ints(item, np.searchsorted(owner, rows).astype(np.int32), pa.int64())]
                out = batch(SCHEMA, *[b.column(c).slice(i, j - i) for c in (0, 2, 3)], np.diff(words.first), *lists)
                yield out if every else out.filter(pa.array(np.diff(cuts) > 0))

    return arrow_map(rows.select("id", "text", "t", "u"), run, DDL)


def matches(docs: DataFrame, items: DataFrame, width: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document with the places of test windows in it.

    Returns one row per row of docs, in any order: id_col, n_words, starts and
    ends (word positions of each match, the end excluded) and items (the
    different items that have a match, ascending). Null and empty texts have no words; items without words match
    nothing; an item shorter than width is one window; an item without an id is
    matched, but not among items. Whole texts are read, of any length. Repeated rows are matched each, repeated items
    once. Empty tables give no rows, or rows without matches. Other columns are not read, so names can't clash.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).select("id", "text", F.xxhash64("text").alias("t"), F.xxhash64(F.lit(1), F.col("text")).alias("u"))
    parts = []
    for n, block in item_blocks(items, item_col, item_text_col, block_bytes):
        windows = spark.sparkContext.broadcast(Windows(block, width))
        if n == 1:
            return _pass(rows, windows, slop, True).select(F.col("id").alias(id_col), "n_words", "starts", "ends", "items")
        parts.append(compact(_pass(rows, windows, slop, False).dropDuplicates(["id", "t", "u"]), "matches"))
        windows.unpersist()
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")]
    found = found.groupBy("id", "t", "u").agg(*lists, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    counted = _pass(rows, spark.sparkContext.broadcast(Windows([], width)), 0, True).select("id", "t", "u", "n_words")
    both = counted.alias("a").join(found.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.t") == F.col("b.t")) & (F.col("a.u") == F.col("b.u")), "left")
    return both.select(F.col("a.id").alias(id_col), "n_words", *[F.coalesce(f"b.{c}", F.array().cast(k)).alias(c) for c, k in (("starts", "array<int>"), ("ends", "array<int>"), ("items", "array<long>"))])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_words, n_hit (words inside any match), n_items (named ones), items_sha256, contaminated of matches()."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
    none = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for b in batches:
            hit, count, sha = [], [], []
            for starts, ends, items in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if not starts:
                    hit.append(0), count.append(0), sha.append(none)
                    continue
                n = reach = 0
                for s, e in sorted(zip(starts, ends, strict=True)):
                    n += max(0, e - max(s, reach))
                    reach = max(reach, e)
                names = sorted(map(str, items))
                hit.append(n), count.append(len(names)), sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield batch(schema, b.column(0), b.column(1), hit, count, sha, [n > 0 for n in hit])

    return arrow_map(found.select(F.col(id_col).alias("id"), "n_words", "starts", "ends", "items"), run, "id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean").withColumnRenamed("id", id_col)
