"""Progress reports of append-only result logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rollouts import done, tag_complete
from tessera.operators.selection import last_write, pct


def rollout_progress(log: DataFrame, failed_log: DataFrame, inputs: DataFrame, valid: str, expected: int) -> DataFrame:
    """By split and in total (split null): rows, valid, tag_complete, lines, failed_lines, pct. Repeated lines count each."""
    ok = done(valid, expected)
    got = log.groupBy("split").agg(F.count("*").alias("lines"), F.count_if(ok).alias("valid"), F.count_if(ok & tag_complete()).alias("tag_complete"))
    bad = failed_log.groupBy("split").agg(F.count("*").alias("failed_lines"))
    names = ["rows", "valid", "tag_complete", "lines", "failed_lines"]
    both = inputs.join(got, "split", "left").join(bad, "split", "left").select("split", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])
    return both.rollup("split").agg(*[F.sum(c).alias(c) for c in names]).withColumn("pct", pct(F.col("valid"), F.col("rows")))


def verify_progress(log: DataFrame, inputs: DataFrame, expected: int, order: list[str]) -> DataFrame:
    """By split and in total: rows, done, correct, wrong, invalid, parse_failed, pct, accuracy.

    The last line of each key counts. Lines without a key (unreadable) and the
    unparsed judgments of invalid records count as parse_failed only.
    """
    counts = ["correct_count", "wrong_count", "invalid_count", "parse_failed_count"]
    latest = last_write(log.where("id is not null"), ["split", "id"], order)
    valid = F.coalesce("verify_valid", F.lit(False))
    got = latest.groupBy("split").agg(F.count_if(valid).alias("done"), *[F.sum(F.when(valid | F.lit(c == "parse_failed_count"), F.coalesce(c, F.lit(0))).otherwise(0)).alias(c) for c in counts])
    unread = log.where("id is null").groupBy("split").agg(F.count("*").alias("unread"))
    both = inputs.join(got, "split", "left").join(unread, "split", "left").select("split", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ["rows", "done", *counts, "unread"]])
    out = both.rollup("split").agg(*[F.sum(c).alias(c) for c in ["rows", "done", *counts, "unread"]])
    return out.select("split", "rows", "done", F.col("correct_count").alias("correct"), F.col("wrong_count").alias("wrong"), F.col("invalid_count").alias("invalid"), (F.col("parse_failed_count") + F.col("unread")).alias("parse_failed"), pct(F.col("done"), F.col("rows")).alias("pct"), pct(F.col("correct_count"), F.col("rows") * expected).alias("accuracy"))


def complete(progress: DataFrame) -> DataFrame:
    """split and complete: whether every row has a valid result."""
    return progress.where("split is not null").select("split", (F.col("rows") <= F.col("done")).alias("complete"))
