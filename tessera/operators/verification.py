"""Judgments of rollouts: format, verdict, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import checks
from tessera.functions import text as T


def judged(rollouts: DataFrame, response: str = "response", output: str = "verifier_response") -> DataFrame:
    """One row a rollout, with format_error, format_valid, verdict, reasoning_consistent, reason, parsed and label (A or B)."""
    v = checks.verdict(F.col(output))
    out = rollouts.withColumn("format_error", T.format_error(F.col(response))).withColumn("__v", v)
    return out.select(*rollouts.columns, "format_error", (F.col("format_error") == "").alias("format_valid"), "__v.*", checks.label(F.col("__v")).alias("label"))


def counts(judgments: DataFrame, *keys: str, expected: int) -> DataFrame:
    """For each sample the numbers of judgments that are correct, wrong, invalid (label C, never given) and unparsed, and whether the record is valid."""
    parse_failed = F.count_if(~F.col("parsed"))
    return judgments.groupBy(*keys).agg(
        F.count("*").alias("num_rollouts"), F.count_if(F.col("label") == "A").alias("correct_count"), F.count_if(F.col("label") == "B").alias("wrong_count"),
        F.count_if(F.col("label") == "C").alias("invalid_count"), parse_failed.alias("parse_failed_count"), ((F.count("*") == expected) & (parse_failed < expected)).alias("verify_valid"),
    )


def accepted(label: Column, format_valid: Column) -> Column:
    return F.coalesce((label == "A") & format_valid, F.lit(False))


def correct_rollouts(rollouts: DataFrame, judgments: DataFrame, key: str = "id") -> DataFrame:
    """The rollouts whose judgment is accepted, by key and rollout_id."""
    good = judgments.where(accepted(F.col("label"), F.col("format_valid"))).select(key, "rollout_id").distinct()
    return rollouts.join(good, [key, "rollout_id"], "left_semi")


def correct_ids(rollouts: DataFrame, key: str = "id") -> DataFrame:
    return rollouts.groupBy(key).agg(F.array_sort(F.collect_list("rollout_id")).alias("correct_rollout_ids"))


def verifier_prompt(template: str, question: Column, answer: Column, candidate: Column) -> Column:
    """Values are inserted in one pass; the candidate keeps its final answer when cut."""
    return T.render_once(template, {"question": T.truncate(question, T.VERIFIER_CHARS), "answer": T.truncate(answer, T.VERIFIER_CHARS), "candidate": T.truncate_keeping_answer(candidate)})
