"""Best-of-n selection, realignment and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values of the record format.
METHOD, SINGLE, BEST, NO_ID = "normalized_answer_likelihood", "single_correct_rollout", "max_normalized_answer_likelihood", 999_999
FINAL_COLUMNS = ["index", "id", "question", "answer", "original_answer", "source", "original_id", "domain", "type", "subtype", "label_valid", "distill_model", "difficulty", "rollout_id", "response", "final_answer", "has_answer_tag", "finish_reason", "response_chars", "selection_method", "selection_reason", "num_correct_rollouts", "correct_rollout_ids", "answer_logprob_mean", "answer_logprob_sum", "answer_token_count"]


def best_of_n(candidates: DataFrame, *keys: str) -> DataFrame:
    """For each sample its candidate with the highest mean log-prob, ties to the least rollout_id (a missing one is last).

    candidates: keys, rollout_id, mean, sum, count. A sample's only candidate is
    taken without scores. A sample of several in which one has no mean is not
    selected: its reason is null. NaN counts as no mean. Aggregated map-side; no sort.
    """
    mean = F.when(~F.isnan("mean"), F.col("mean"))
    order = F.struct(mean, -F.coalesce("rollout_id", F.lit(NO_ID)))
    out = candidates.groupBy(*keys).agg(F.count("*").alias("n"), F.count(mean).alias("scored"), F.max_by(F.struct("rollout_id", "mean", "sum", "count"), order).alias("best"))
    one, ok = F.col("n") == 1, F.col("n") == F.col("scored")
    score = lambda c: F.when(~one & ok, F.col(f"best.{c}"))
    return out.select(
        *keys, F.col("n").alias("num_correct_rollouts"), F.when(one | ok, F.col("best.rollout_id")).alias("selected_rollout_id"),
        score("mean").alias("answer_logprob_mean"), score("sum").alias("answer_logprob_sum"), F.when(one, F.lit(0).cast("long")).when(ok, F.col("best.count")).alias("answer_token_count"),
        F.when(one, SINGLE).when(ok, BEST).alias("selection_reason"),
    )


def best_records(samples: DataFrame, rollouts: DataFrame, scores: DataFrame, key: str = "id") -> DataFrame:
    """samples with their nested best-of-n record: selection_method, num_correct_rollouts, selected_rollout_id, best_rollout, candidate_scores, correct_rollout_ids.

    rollouts: key and the rollout's fields; scores: key, rollout_id, mean, sum,
    count. A sample's candidates are its own few rollouts. Samples of which a candidate has no mean have no record.
    """
    fields = ["rollout_id", "response", "final_answer", "has_answer_tag", "finish_reason", "response_chars"]
    best = best_of_n(scores, key).where("selection_reason is not null")
    taken = rollouts.select(key, *fields).join(best.withColumnRenamed("selected_rollout_id", "rollout_id"), [key, "rollout_id"])
    chosen = taken.select(key, F.struct(*fields, "answer_logprob_sum", "answer_logprob_mean", "answer_token_count", "selection_reason").alias("best_rollout"), "num_correct_rollouts", F.col("rollout_id").alias("selected_rollout_id"))
    one = F.struct("rollout_id", "final_answer", F.col("mean").alias("answer_logprob_mean"), F.col("sum").alias("answer_logprob_sum"), F.col("count").alias("answer_token_count"))
    lists = scores.join(rollouts.select(key, "rollout_id", "final_answer"), [key, "rollout_id"]).groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("candidate_scores"), F.array_sort(F.collect_list("rollout_id")).alias("correct_rollout_ids"))
    return samples.join(chosen, key).join(lists, key).withColumn("selection_method", F.lit(METHOD))


def final_rows(best: DataFrame) -> DataFrame:
    """The nested best-of-n records as flat rows of 26 columns; absent sample fields are null."""
    nested = {"rollout_id", "response", "final_answer", "has_answer_tag", "finish_reason", "response_chars", "selection_reason", "answer_logprob_mean", "answer_logprob_sum", "answer_token_count"}
    have = set(best.columns)
    return best.select(*[F.col(f"best_rollout.{c}").alias(c) if c in nested else F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in FINAL_COLUMNS])


def joined_strictly(samples: DataFrame, records: DataFrame, on: list[str]) -> DataFrame:
    """Each sample with its record; a sample without one raises when its row is read."""
    marked = samples.join(records.withColumn("__there", F.lit(True)), on, "left")
    missing = F.raise_error(F.concat(F.lit("no record for "), F.concat_ws("/", *[F.col(c).cast("string") for c in on])))
    return marked.withColumn("__there", F.coalesce("__there", missing.cast("boolean"))).where("__there").drop("__there")


def realigned(order: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """rows by split and index of order: one partition range for the write, sorted inside."""
    return order.join(rows, key).repartitionByRange("split", "index").sortWithinPartitions("split", "index")


def completeness(expected: DataFrame, got: DataFrame, key: str = "id") -> DataFrame:
    """key and problem (missing, extra, duplicate_expected, duplicate_result) of everything that doesn't match one to one."""
    e = expected.groupBy(key).agg(F.count("*").alias("e"))
    g = got.groupBy(key).agg(F.count("*").alias("g"))
    both = e.join(g, key, "full_outer").select(key, F.coalesce("e", F.lit(0)).alias("e"), F.coalesce("g", F.lit(0)).alias("g"))
    problems = F.filter(F.array(F.when(F.col("g") == 0, "missing"), F.when(F.col("e") == 0, "extra"), F.when(F.col("e") > 1, "duplicate_expected"), F.when(F.col("g") > 1, "duplicate_result")), lambda x: x.isNotNull())
    return both.select(key, F.explode(problems).alias("problem"))


def require_complete(expected: DataFrame, got: DataFrame, key: str = "id") -> None:
    """Raises with the first ten problems, sorted."""
    bad = completeness(expected, got, key).orderBy("problem", key).limit(10).collect()
    if bad:
        raise ValueError("incomplete: " + ", ".join(f"{r[key]} {r.problem}" for r in bad))


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def last_write(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by an explicit order. Spark prunes to one row a key and task before the exchange."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_tokens(logits: DataFrame, keys: list[str], k: int, value: str = "logit", token: str = "token_id") -> DataFrame:
    """The k largest tokens of each position with their rank; ties to the smaller token."""
    w = W.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(token))
    return logits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def progress(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Best-of-n progress by shard and in total (shard null): expected, done, single, scored, pct."""
    got = rows.groupBy("shard").agg(F.count("*").alias("done"), F.count_if(F.coalesce(F.col("selection_reason") == SINGLE, F.lit(False))).alias("single"))
    both = expected.join(got, "shard", "left").select("shard", "expected", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("done", "single")])
    return both.rollup("shard").agg(*[F.sum(c).alias(c) for c in ("expected", "done", "single")]).select("shard", "expected", "done", "single", (F.col("done") - F.col("single")).alias("scored"), pct(F.col("done"), F.col("expected")).alias("pct"))


def pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
