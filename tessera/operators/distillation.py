"""Token-level distillation losses and metrics in long form.

Student logits have a row for each position and token; log-softmax is a window
over a position, so only top tokens are carried on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import fresh

#: Least log-prob, largest loss.
LOG_FLOOR, LOSS_LIMIT = -10.0, 10.0
LOSSES: dict[str, Callable[[Column, Column], Column]] = {}


def register(*names: str):
    """Register a loss of one token, a function of student and teacher log-prob, by names. A name can be taken once."""

    def add(fn):
        taken = [n for n in names if n in LOSSES]
        if taken or len(set(names)) < len(names):
            raise ValueError(f"already registered: {taken or names}")
        LOSSES.update(dict.fromkeys(names, fn))
        return fn

    return add


def loss_of(name: str) -> Callable[[Column, Column], Column]:
    if name not in LOSSES:
        raise ValueError(f"unknown loss {name}; there are {sorted(LOSSES)}")
    return LOSSES[name]


@register("forward_kl_topk")
def forward_kl(student: Column, teacher: Column) -> Column:
    """p (log p - log q), both logs floored first."""
    q, p = F.greatest(student, F.lit(LOG_FLOOR)), F.greatest(teacher, F.lit(LOG_FLOOR))
    return F.exp(p) * (p - q)


@register("reverse_kl_topk_corrected")
def reverse_kl(student: Column, teacher: Column) -> Column:
    """q (log q - log p) - q + p, both logs floored first."""
    q, p = F.greatest(student, F.lit(LOG_FLOOR)), F.greatest(teacher, F.lit(LOG_FLOOR))
    return F.exp(q) * (q - p) - F.exp(q) + F.exp(p)


@register("kl", "k1")
def k1(student: Column, teacher: Column) -> Column:
    return student - teacher


@register("abs")
def absolute(student: Column, teacher: Column) -> Column:
    return F.abs(student - teacher)


@register("mse", "k2")
def k2(student: Column, teacher: Column) -> Column:
    return F.lit(0.5) * (student - teacher) * (student - teacher)


@register("low_var_kl", "k3")
def k3(student: Column, teacher: Column) -> Column:
    d = teacher - student
    return F.exp(d) - d - F.lit(1.0)


def log_softmax(logits: DataFrame, keys: list[str], value: str = "logit") -> DataFrame:
    """logits with logprob: value - (max + ln(sum(exp(value - max)))). One exchange by keys, which what follows by the same keys shares; a position has no more rows than the vocabulary."""
    w = W.partitionBy(*keys)
    top, norm = fresh(logits, "__max", "__norm")
    shifted = logits.withColumn(top, F.max(value).over(w))
    return shifted.withColumn(norm, F.col(top) + F.ln(F.sum(F.exp(F.col(value) - F.col(top))).over(w))).withColumn("logprob", F.col(value) - F.col(norm)).drop(top, norm)


def topk_losses(student: DataFrame, teacher: DataFrame, student_top: DataFrame, keys: list[str], loss: str) -> DataFrame:
    """For each position: loss, student_mass, teacher_mass, overlap_count, overlap_advantage.

    student: keys, token_id, logprob over the vocabulary; teacher: the same for
    its top tokens; student_top: keys, token_id of the student's top tokens.
    Forward losses go over the teacher's tokens, corrected reverse ones over the
    student's. Masses are taken before the floor. Advantage: the mean of minus
    the token losses over shared tokens, 0 without any.
    """
    on = [*keys, "token_id"]
    forward = loss == "forward_kl_topk"
    base = teacher.select(*on, F.col("logprob").alias("t")) if forward else student_top.select(*on).join(teacher.select(*on, F.col("logprob").alias("t")), on, "left")
    rows = base.join(student.select(*on, F.col("logprob").alias("s")), on)
    other = student_top if forward else teacher
    rows = rows.join(other.select(*on, F.lit(1).alias("__both")), on, "left")
    token = loss_of(loss)(F.col("s"), F.coalesce("t", F.lit(LOG_FLOOR)))
    both = F.col("__both").isNotNull()
    return rows.withColumn("l", token).groupBy(*keys).agg(
        F.sum("l").alias("loss"), F.sum(F.exp("s")).alias("student_mass"), F.coalesce(F.sum(F.exp("t")), F.lit(0.0)).alias("teacher_mass"),
        F.count_if(both).alias("overlap_count"), F.coalesce(F.try_divide(F.sum(F.when(both, -F.col("l"))), F.count_if(both)), F.lit(0.0)).alias("overlap_advantage"),
    )


def floored(loss: Column) -> Column:
    """Top-k losses aren't negative."""
    return F.greatest(loss, F.lit(0.0))


def clamped(loss: Column, limit: float = LOSS_LIMIT) -> Column:
    return F.least(F.greatest(loss, F.lit(-limit)), F.lit(limit))


def metrics(positions: DataFrame, k: int) -> DataFrame:
    """One row over the response's positions (is_response): masses (mean, min, max), overlap_ratio, overlap_advantage over positions with overlap, and loss range after the floor and before the clamp."""
    rows = positions.where("is_response")
    some = F.col("overlap_count") > 0
    l = floored(F.col("loss"))  # noqa: E741
    return rows.agg(
        *[f(m).alias(f"{m}{s}") for m in ("student_mass", "teacher_mass") for f, s in ((F.avg, ""), (F.min, "_min"), (F.max, "_max"))],
        (F.avg("overlap_count") / F.lit(k)).alias("overlap_ratio"), F.coalesce(F.avg(F.when(some, F.col("overlap_advantage"))), F.lit(0.0)).alias("overlap_advantage"), F.min(l).alias("loss_min"), F.max(l).alias("loss_max"),
    )


def token_mean(positions: DataFrame, loss: str = "loss") -> DataFrame:
    return positions.where("is_response").agg(F.avg(loss).alias("loss"))


def sequence_mean(positions: DataFrame, sequence: str = "seq_id", loss: str = "loss") -> DataFrame:
    """The mean of the sequences' token means."""
    return positions.where("is_response").groupBy(sequence).agg(F.avg(loss).alias("__m")).agg(F.avg("__m").alias("loss"))


def combined(distillation: Column, policy: Column, coefficient: float, task_rewards: bool) -> Column:
    """The distillation loss by its coefficient, and the policy's unless task rewards are off."""
    return distillation * F.lit(coefficient) + (policy if task_rewards else F.lit(0.0))


def routed(rows: DataFrame, teachers: dict[str, str], key: str) -> DataFrame:
    """rows with teacher: the only one for all, else by routing key. A missing or unknown key raises when its row is read."""
    if not teachers:
        raise ValueError("no teacher is configured")
    if len(teachers) == 1:
        return rows.withColumn("teacher", F.lit(next(iter(teachers.values()))))
    to = F.try_element_at(F.create_map(*[F.lit(x) for kv in teachers.items() for x in kv]), F.col(key))
    return rows.withColumn("teacher", F.coalesce(to, F.raise_error(F.concat(F.lit("no teacher for routing key "), F.coalesce(F.col(key), F.lit("null")))).cast("string")))
