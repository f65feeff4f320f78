"""Line deduplication by range-partitioned hashes.

Lines become records (128-bit key hash, document, position). The records are
partitioned by ranges of all four columns and sorted the same way, so a key's
records lie side by side, in order of document and position, and one very
common key may span many partitions instead of filling one. Each partition is
decided in one pass over its sorted batches, of which only the open key's last
document is carried on: a line goes once enough documents and a larger one are
known to have its key. Keys at the ends of a partition may go on elsewhere: for
these, a summary of at most ``copies`` document ids per partition is merged,
and their undecided lines are decided by it. There are at most two such keys a
partition, which bounds the merged summary. The number of partitions follows
the number of lines.

The operator returns a compressed keep bitmap for each document, not texts.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Held, arrow_map, batch, compact, fresh, parts, prepare, starts
from tessera.llm.wordcore import LOWER, SPACE, Words, chunks, column_bytes, digests

_CHUNK = 1 << 18
#: Lines of a range partition, about.
PARTITION_LINES = 4_000_000
#: \n alone parts lines.
_LINE = np.zeros(256, np.bool_)
_LINE[0x0A] = True


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): the bytes of all lines, and the index of each text's first line with a last entry. An empty text is one empty line."""
    breaks = np.flatnonzero(data == 0x0A)
    n_lines = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(n_lines)])
    start = np.empty(first[-1], np.int64)
    end = np.empty(first[-1], np.int64)
    is_first = np.zeros(first[-1] + 1, np.bool_)
    is_first[first[:-1]] = True
    start[is_first[:-1]] = offsets[:-1]
    start[~is_first[:-1]] = breaks + 1
    is_last = is_first[1:].copy()
    is_last[-1:] = True
    end[is_last] = offsets[1:]
    end[~is_last] = breaks
    return start, end, first


def line_records(docs: DataFrame, least: int) -> DataFrame:
    """(h1, h2, doc, row, pos) of the lines with keys of at least so many code points."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        for b in batches:
            data, offsets = column_bytes(b.column(2))
            doc, row = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for i, j in chunks(offsets, _CHUNK):
                o = offsets[i : j + 1]
                x, o = data[o[0] : o[-1]], o - o[0]
                start, end, first = line_bounds(x, o)
                words = Words(x, o, LOWER, SPACE)
                a = np.searchsorted(words.start, start)  # words don't cross lines, as \n parts them
                z = np.searchsorted(words.start, end)
                some = np.flatnonzero((z > a) & (end - start >= least))
                s, e = words.start[a[some]], words.end[z[some] - 1]
                points = np.zeros(len(x) + 1, np.int64)
                np.cumsum((x & 0xC0) != 0x80, out=points[1:])
                ok = points[e] - points[s] >= least
                some, s, e = some[ok], s[ok], e[ok]
                h = [x.view(np.int64) for x in digests(words.data, s, e)]
                r = np.searchsorted(first, some, "right") - 1
                if len(r):
                    yield batch(schema, *h, doc[r + i], row[r + i], (some - first[r]).astype(np.int32))

    return arrow_map(docs, run, "h1 long, h2 long, doc long, row long, pos int")


class Decider:
    """Decides the sorted records (h1, h2, doc, row, pos) of a partition batch by batch. Records of its first key are never decided here."""

    def __init__(self, copies: int):
        self.copies = copies
        self.first: tuple | None = None
        self.open: tuple | None = None
        self.held: list[np.ndarray] = [np.zeros(0, np.int64)] * 5  # what waits of the open key: all, or its largest document's
        self.before = 0  # documents of the open key whose records were dropped
        self.tops: dict[tuple, list[int]] = {}  # the largest documents of the first and the open key

    def add(self, *columns: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The records to drop, and those of the first key, as columns."""
        carried = len(self.held[0]) > 0
        columns = [np.concatenate(x) for x in zip(self.held, columns, strict=True)]
        h1, h2, doc = columns[:3]
        at = starts(h1, h2)
        size = np.diff(np.r_[at, len(h1)])
        key = np.repeat(np.arange(len(at)), size)
        new = np.zeros(len(h1), np.bool_)
        new[starts(h1, h2, doc)] = True
        n_docs = np.bincount(key[new], minlength=len(at))
        n_docs[0] += self.before if carried else 0
        names = [(int(h1[i]), int(h2[i])) for i in (at[0], at[-1])]
        self.first = self.first or names[0]
        self.open = names[1]
        for name, docs in zip(names, (doc[: size[0]], doc[at[-1] :]), strict=True):
            self.tops[name] = sorted({*self.tops.get(name, []), *np.unique(docs)[-self.copies :].tolist()})[-self.copies :]
        self.tops = {k: v for k, v in self.tops.items() if k in (self.first, self.open)}
        never = key == 0 if names[0] == self.first else np.zeros(len(key), np.bool_)
        drop = ~never & (n_docs >= self.copies)[key] & (doc != doc[at + size - 1][key])
        wait = ~never & ~drop & (key == len(at) - 1)
        self.before = int(n_docs[-1]) - len(np.unique(doc[wait]))
        self.held = [c[wait] for c in columns]
        return [c[drop] for c in columns], [c[never] for c in columns]


def dropped_lines(lines: DataFrame, copies: int, n: int) -> DataFrame:
    """(doc, row, pos) of the lines to drop."""
    keys = ["h1", "h2", "doc", "row", "pos"]
    dealt = lines.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()), ("docs", pa.list_(pa.int64()))])
    ddl = "h1 long, h2 long, doc long, row long, pos int, docs array<long>"

    def run(batches):
        """Three kinds of rows: lines to drop (no h1), undecided lines of a key at an end of the partition, and such a key's summary (with docs)."""

        def rows(columns, decided):
            h1, h2, doc, row, pos = columns
            none = pa.nulls(len(doc), pa.int64())
            return batch(schema, none if decided else h1, none if decided else h2, doc, row, pos.astype(np.int32), pa.nulls(len(doc), schema.field("docs").type))

        decider = Decider(copies)
        for b in batches:
            if b.num_rows:
                drop, open_ = decider.add(*[b.column(x).to_numpy(zero_copy_only=False) for x in range(5)])
                yield from (rows(x, decided) for x, decided in ((drop, True), (open_, False)) if len(x[0]))
        yield rows(decider.held, False)
        for (h1, h2), docs in decider.tops.items():
            yield batch(schema, [h1], [h2], [None], [None], [None], [docs])

    found = compact(arrow_map(dealt, run, ddl), "lines", 200_000)
    sums = found.where("docs is not null").groupBy("h1", "h2").agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs")).where(F.size("docs") >= copies).select("h1", "h2", F.array_max("docs").alias("keeper"))
    later = found.where("docs is null and h1 is not null").join(F.broadcast(sums), ["h1", "h2"]).where("doc <> keeper").select("doc", "row", "pos")
    return found.where("docs is null and h1 is null").select("doc", "row", "pos").unionByName(later)


def keep_bitmaps(docs: DataFrame, copies: int = 3, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, dropped): for each document that loses lines, its id, a hash of its text, and a zlib-compressed bitmap of the lines to drop.

    A line's key is the line without [\\x20\\x09-\\x0D] at its ends, A-Z lower-cased.
    Keys of at least ``least`` code points in at least ``copies`` documents keep
    only the lines in the largest document. Rows that repeat a doc_id count as
    one document. Null and empty texts have one empty line, which stays; rows without an id are not considered
    and keep their lines. Texts and lines of any length are read whole. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    n = parts(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("row"), F.col(text_col).cast("string").alias("text")).where("doc is not null and text is not null")
    with Held() as held:
        lines = held(line_records(rows, least))
        drops = dropped_lines(lines, copies, max(n, -(-lines.count() // PARTITION_LINES)))
    drops = drops.groupBy("doc", "row").agg(F.collect_list("pos").alias("at"))
    schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("dropped", pa.binary())])

    def run(batches):
        for b in batches:
            yield batch(schema, b.column(0), b.column(1), [pack_bits(x.values.to_numpy()) for x in b.column(2)])

    return arrow_map(drops, run, "doc long, row long, dropped binary")


def pack_bits(positions: np.ndarray) -> bytes:
    bits = np.zeros(int(positions.max()) + 1, np.bool_)
    bits[positions] = True
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack_bits(body: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(body), np.uint8)))


def _with_bitmaps(docs: DataFrame, copies: int, least: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """docs with each row's bitmap, and the name of its column."""
    doc, row, own, dropped = fresh(docs, "__doc", "__row", "__hash", "dropped")
    maps = keep_bitmaps(docs, copies, least, id_col, text_col).withColumnsRenamed({"doc": doc, "row": row, "dropped": dropped})
    marked = docs.withColumn(own, F.xxhash64(text_col))
    return marked.join(maps, (marked[id_col].cast("long") == maps[doc]) & (marked[own] == maps[row]), "left").drop(doc, row, own), dropped


def kept_text(text: str, dropped: bytes | None) -> tuple[str, int, int]:
    """(text without the dropped lines, lines before, lines dropped)."""
    if dropped is None:
        return text, text.count("\n") + 1, 0
    lines = text.split("\n")
    out = set(unpack_bits(dropped).tolist())
    return "\n".join(x for i, x in enumerate(lines) if i not in out), len(lines), len(out)


def dedup(docs: DataFrame, copies: int = 3, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text that keep_bitmaps() leaves; all columns stay, whatever their names. Null texts stay null; a text that loses all lines is empty."""
    rows, bitmap = _with_bitmaps(docs, copies, least, id_col, text_col)

    @F.pandas_udf("string")
    def kept(texts, dropped):
        return texts.combine(dropped, lambda t, d: None if t is None else kept_text(t, d)[0])

    lost = F.col(bitmap).isNotNull()
    return rows.withColumn(text_col, F.when(lost, kept(F.when(lost, F.col(text_col)), bitmap)).otherwise(F.col(text_col))).drop(bitmap)


def digest(docs: DataFrame, copies: int = 3, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_lines, n_dropped, kept_sha256."""
    schema = pa.schema([("id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
    rows, bitmap = _with_bitmaps(docs.select(id_col, text_col), copies, least, id_col, text_col)

    def run(batches):
        for b in batches:
            lines, lost, sha = [], [], []
            for i in range(b.num_rows):  # one text after another, so that a batch is not held twice
                text, n, d = kept_text(b.column(1)[i].as_py() or "", b.column(2)[i].as_py())
                lines.append(n), lost.append(d), sha.append(hashlib.sha256(text.encode()).hexdigest())
            yield batch(schema, b.column(0), lines, lost, sha)

    return arrow_map(rows.select(F.col(id_col).cast("long"), text_col, bitmap), run, "id long, n_lines long, n_dropped long, kept_sha256 string").withColumnRenamed("id", id_col)
