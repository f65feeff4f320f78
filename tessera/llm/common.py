"""Shared folder, reading, lineage cuts and packed exchanges of the llm operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from tessera.session import clean, find_package, fresh, table, written  # noqa: F401  for the operators

#: What is broadcast at most, by bytes_of().
BROADCAST_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers: by rows, and by bytes for long texts. Let workers on this machine find the package."""
    find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    except Exception as e:  # noqa: BLE001  an older Spark without the setting keeps the bound on rows
        if "maxBytesPerBatch" not in str(e):
            raise


class Held:
    """Keeps what is used several times, is as large as the input and made from it in one pass on the executors' disks, until the block ends. Lost parts are made again."""

    def __init__(self):
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.frames.append(df.persist(StorageLevel.DISK_ONLY))
        return self.frames[-1]

    def __enter__(self) -> Held:
        return self

    def __exit__(self, *_) -> None:
        for df in reversed(self.frames):
            df.unpersist()


def compact(df: DataFrame, name: str, per_file: int = 50_000) -> DataFrame:
    """written(), in as many files as the rows need: for results whose number of rows is known only when they are there.

    They are kept on the executors' disks just until they are counted and written.
    """
    first = df.persist(StorageLevel.DISK_ONLY)
    try:
        n = first.count()
        return written(first.coalesce(max(1, -(-n // per_file))), name)
    finally:
        first.unpersist()


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tidy() -> None:
    """Give freed memory back to the system: workers live on, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            tidy()

    return df.mapInArrow(run, schema)


def arrow_groups(groups, fn: Callable[..., pa.Table], schema: str) -> DataFrame:
    """fn over each group (or cogroup) as a table."""

    def one(t: pa.Table) -> pa.Table:
        large = t.nbytes > 1 << 20
        out = fn(t)
        if large:
            del t
            tidy()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = fn(left, right)
        if left.nbytes + right.nbytes > 1 << 20:
            tidy()
        return out

    return groups.applyInArrow(two if isinstance(groups, PandasCogroupedOps) else one, schema)


def bytes_of(df: DataFrame) -> int:
    """About what df takes in memory: 64 bytes a row, 8 a value, and the lengths of lists, texts and binaries as they are."""
    each = 64
    total = F.lit(0).cast("long")
    for f in df.schema:
        each += 8
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            total = total + F.coalesce(F.sum(F.size(c).cast("long")) * 8 * (len(inner) if isinstance(inner, T.StructType) else 1), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.sum(F.octet_length(c).cast("long")), F.lit(0))
    return df.agg((F.count("*") * each + total).alias("n")).first().n


def small_join(df: DataFrame, other: DataFrame, key, how: str = "inner", most: int = BROADCAST_BYTES, size: int | None = None) -> DataFrame:
    """df joined with other, which is broadcast if it is measured (or known) to take at most so many bytes, else joined by an exchange."""
    return df.join(F.broadcast(other) if (bytes_of(other) if size is None else size) <= most else other, key, how)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


PACKED = pa.schema([("bucket", pa.int32()), ("body", pa.binary())])
PACKED_DDL = "bucket int, body binary"


@cache
def spread(buckets: int) -> np.ndarray:
    """An int for each of so many buckets, two for each partition of half as many: Spark's hash (Murmur3 of an int, seed 42) deals them out evenly."""
    n = max(1, buckets // 2)
    x = np.arange(64 * n + 1024, dtype=np.uint32)
    turn = lambda v, r: v << np.uint32(r) | v >> np.uint32(32 - r)
    h = turn(x * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593) ^ np.uint32(42)
    h = (turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> np.uint32(shift)) * np.uint32(by)
    part = h.view(np.int32).astype(np.int64) % n
    order = np.argsort(part, kind="stable")
    first = np.searchsorted(part[order], np.arange(n + 1))
    if (np.diff(first) < 2).any():  # too few were tried
        return np.arange(buckets, dtype=np.int32)
    ids = np.concatenate([order[first[:-1]], order[first[:-1] + 1]]).astype(np.int32)
    return np.r_[ids, np.full(max(0, buckets - len(ids)), 1 << 30, np.int32) + np.arange(max(0, buckets - len(ids)), dtype=np.int32)]


class Packer:
    """Collects numpy records by bucket and yields them as (bucket, body) rows: an exchange moves few rows with many records each. Buckets are named by spread()."""

    def __init__(self, buckets: int, most: int = 8 << 20):
        self.buckets, self.most, self.held, self.size = buckets, most, [], 0

    def add(self, bucket: np.ndarray, records: np.ndarray):
        if len(records):
            self.held.append((bucket, records))
            self.size += records.nbytes
        if self.size >= self.most:
            yield from self.flush()

    def flush(self):
        if not self.held:
            return
        bucket = np.concatenate([b for b, _ in self.held])
        records = np.concatenate([r for _, r in self.held])
        self.held, self.size = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket, records = bucket[order], records[order]
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[at[1:], len(bucket)]
        yield pa.RecordBatch.from_arrays([pa.array(spread(self.buckets)[bucket[at]], pa.int32()), pa.array([records[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())], schema=PACKED)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket of the hash's upper bits."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def unpack(t: pa.Table, dtype: np.dtype) -> np.ndarray:
    bodies = t.column("body").to_pylist()
    return np.frombuffer(b"".join(bodies), dtype) if bodies else np.zeros(0, dtype)


def starts(*columns: np.ndarray) -> np.ndarray:
    """Indexes at which a run of equal tuples begins in sorted columns."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, np.bool_)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def texts_of(column) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def column_ints(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row i holds values[cuts[i]:cuts[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))
