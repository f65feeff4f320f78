"""Functions on token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def common_prefix(a: Column, b: Column) -> Column:
    """The number of leading equal elements."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.coalesce(F.when(at > 0, at - 1), F.least(F.size(a), F.size(b)).cast("long"))


def actual_logprobs(ids: Column, entries: Column) -> Column:
    """Each token's own log-prob from its entry, a map from token (as text) to log-prob; null where the entry is null or lacks it. Unequal lengths raise."""
    picked = F.zip_with(ids, entries, lambda i, m: F.try_element_at(m, i.cast("string")))
    return F.when(F.size(ids) == F.size(entries), picked).otherwise(F.raise_error(F.lit("token ids and log-probs differ in length")).cast("array<double>"))


def target_score(prefix_ids: Column, full_ids: Column, logprobs: Column) -> Column:
    """Struct of start, sum, count and mean of the log-probs after the common prefix, nulls left out; sum and mean are null if none is left."""
    start = common_prefix(prefix_ids, full_ids)
    rest = F.filter(F.slice(logprobs, (start + 1).cast("int"), F.size(logprobs)), lambda x: x.isNotNull())
    total = F.when(F.size(rest) > 0, F.aggregate(rest, F.lit(0.0), lambda s, x: s + x))
    n = F.size(rest).cast("long")
    return F.struct(start.alias("start"), total.alias("sum"), n.alias("count"), F.try_divide(total, n).alias("mean"))


def pad(a: Column, left: Column | int, right: Column | int, value) -> Column:
    fill = lambda n: F.array_repeat(F.lit(value), n if not isinstance(n, int) else F.lit(n))
    return F.concat(fill(left), a, fill(right))


def keep_last(tokens: Column, n: int) -> Column:
    """Left truncation: at most the last n."""
    return F.when(F.size(tokens) > n, F.slice(tokens, -n, n)).otherwise(tokens)
