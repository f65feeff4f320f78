"""Splits, ordinals and shards in row order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import fresh

_LOW = (1 << 33) - 1


def global_index(df: DataFrame, *keys: str, name: str = "index") -> DataFrame:
    """df with the ordinal of each row in the order of keys, from 0, in place of an existing column of that name.

    Rows are range-partitioned and sorted; a row's ordinal is its place in its
    partition plus the rows of the partitions before. The sorted rows are
    written in the shared folder with their places, so that both passes see the
    same partitions and nothing is computed again; the counts, a row for each
    partition, are summed up by a window over them alone and joined by broadcast.
    """
    from tessera.session import written

    order = [F.col(k).asc_nulls_first() for k in keys]
    at, part, before = fresh(df, "__at", "__part", "__before")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ordered.withColumn(at, F.monotonically_increasing_id()), "ordered").withColumn(part, F.shiftright(at, 33))
    counts = placed.groupBy(part).agg(F.count("*").alias("__n"))
    offsets = counts.select(part, (F.sum("__n").over(W.orderBy(part)) - F.col("__n")).alias(before))
    index = (F.col(before) + F.col(at).bitwiseAND(F.lit(_LOW))).cast("long")
    return placed.join(F.broadcast(offsets), part).withColumn(name, index).drop(at, part, before)


def split_counts(total: int, n: int) -> list[int]:
    """n contiguous splits, the first ones a row longer where total isn't a multiple."""
    if n < 1:
        raise ValueError("at least one split is needed")
    base, more = divmod(total, n)
    return [base + (i < more) for i in range(n)]


def split_of(index: Column, total: int, n: int) -> Column:
    """The split that holds this ordinal (the same as ntile(n) - 1)."""
    base, more = divmod(total, n)
    head = more * (base + 1)
    return F.when(index < head, F.floor(index / F.lit(base + 1))).otherwise(F.lit(more) + F.floor((index - head) / F.lit(max(base, 1)))).cast("int")


def with_splits(df: DataFrame, n: int, *keys: str) -> DataFrame:
    indexed = global_index(df, *keys)
    return indexed.withColumn("split", split_of(F.col("index"), indexed.count(), n))


def split_summary(df: DataFrame, n: int) -> DataFrame:
    """split, rows, expected, valid of all n splits; empty splits are legal."""
    spark = df.sparkSession
    expected = split_counts(df.count(), n)
    want = spark.createDataFrame([(i, c) for i, c in enumerate(expected)], "split int, expected long")
    have = df.groupBy("split").agg(F.count("*").alias("rows"))
    rows = F.coalesce("rows", F.lit(0)).cast("long")
    return want.join(have, "split", "left").select("split", rows.alias("rows"), "expected", (rows == F.col("expected")).alias("valid"))


def shard_of(split: Column, n: int) -> Column:
    return F.pmod(split, F.lit(n)).cast("int")


def file_split(path: Column) -> Column:
    """The number that a split file is named by, else null."""
    return F.regexp_extract(path, r"(?:^|/)(\d+)\.[A-Za-z]+$", 1).try_cast("int")
