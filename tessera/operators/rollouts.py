"""Rollout records: 1 to n responses a sample, and their validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T

ROLLOUT = "struct<rollout_id: int, response: string, final_answer: string, has_answer_tag: boolean, finish_reason: string, response_chars: int, error: string>"
SAMPLE_FIELDS = ["index", "id", "question", "answer", "source", "original_id", "domain", "type", "subtype"]


def key(df: DataFrame) -> Column:
    """A record's key: its id as text, else its index, else empty. Null counts as absent."""
    parts = [F.col(c).cast("string") for c in ("id", "index") if c in df.columns]
    return F.coalesce(*parts, F.lit(""))


def metadata(df: DataFrame) -> list[Column]:
    """The sample fields that df has; id defaults to the index."""
    return [F.coalesce(F.col("id").cast("string"), F.col("index").cast("string")).alias("id") if c == "id" and "index" in df.columns else F.col(c) for c in SAMPLE_FIELDS if c in df.columns]


def failed(r: Column) -> Column:
    return r["error"].isNotNull() & (r["error"] != "")


def parsed(response: Column) -> Column:
    """Struct of response (tags normalised), final_answer, has_answer_tag, response_chars."""
    r = T.normalize_tags(response)
    return F.struct(r.alias("response"), T.last_answer(r).alias("final_answer"), T.has_answer(r).alias("has_answer_tag"), F.length(r).alias("response_chars"))


def validity_unless_all_failed(df: DataFrame) -> DataFrame:
    """Cleaning and distillation: a record is invalid only if all rollouts failed; all are kept, failed ids listed."""
    bad = F.filter("rollouts", failed)
    n = F.coalesce(F.size("rollouts"), F.lit(0))
    return df.withColumns({
        "num_rollouts": n,
        "num_failed_rollouts": F.coalesce(F.size(bad), F.lit(0)),
        "failed_rollout_ids": F.transform(bad, lambda r: r["rollout_id"]),
        "failed_rollout_errors": F.map_from_entries(F.transform(bad, lambda r: F.struct(r["rollout_id"].cast("string"), r["error"]))),
        "rollout_valid": F.coalesce(F.size(bad) < F.size("rollouts"), F.lit(False)),
    })


def validity_if_none_failed(df: DataFrame) -> DataFrame:
    """Difficulty filtering: a record is invalid if any rollout failed; only the others are kept, with the first failure by position."""
    bad = F.filter("rollouts", failed)
    first = F.try_element_at(bad, F.lit(1))
    return df.withColumns({
        "error": first["error"],
        "failed_rollout_id": first["rollout_id"],
        "rollout_valid": F.coalesce((F.size("rollouts") > 0) & (F.size(bad) == 0), F.lit(False)),
        "rollouts": F.filter("rollouts", lambda r: ~F.coalesce(failed(r), F.lit(False))),
    })


def done(valid: str, expected: int) -> Column:
    return F.coalesce(F.col(valid) & (F.size("rollouts") == expected), F.lit(False))


def tag_complete(ignore_errors: bool = False) -> Column:
    """Every rollout has an answer tag, and no error unless these are ignored."""
    return F.coalesce(F.forall("rollouts", lambda r: F.coalesce(r["has_answer_tag"], F.lit(False)) & (F.lit(ignore_errors) | ~F.coalesce(failed(r), F.lit(False)))), F.lit(False))


def not_done(samples: DataFrame, results: DataFrame, on: str = "index") -> DataFrame:
    """Resume: the samples without a finished result."""
    return samples.join(results.where(F.col(on).isNotNull()).select(on).distinct(), on, "left_anti")
