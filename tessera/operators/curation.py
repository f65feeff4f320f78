"""Choosing samples: difficulty, teachers, the frontier, rewards and duplicates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import fresh

#: The domains of the two groups.
GROUPS = {
    "science": "analytical", "mathematics": "analytical", "logic/puzzle": "analytical", "chart/document": "analytical",
    "general vision": "real_world", "spatial": "real_world", "GUI/web": "real_world", "perception": "real_world", "counting": "real_world",
}
TEACHERS = ["9B", "27B", "122B"]
#: Rows of a tile of tiled_pairs().
TILE = 2_000


def difficult(correct: Column) -> Column:
    """Kept for distillation: no rollout of the small model is correct."""
    return correct == 0


def cascade(solved: DataFrame, key: str, teachers: Sequence[str] = TEACHERS) -> DataFrame:
    """key and distill_model: the first teacher of the cascade that solves the sample. solved: key, teacher, solved."""
    rank = F.array_position(F.array(*[F.lit(t) for t in teachers]), F.col("teacher"))
    return solved.where(F.col("solved") & (rank > 0)).groupBy(key).agg(F.min_by("teacher", rank).alias("distill_model"))


def group_of(domain: Column, groups: Mapping[str, str] = GROUPS) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in groups.items() for x in kv]), domain)


def pass_rates(outcomes: DataFrame, *keys: str) -> DataFrame:
    return outcomes.groupBy(*keys).agg(F.count("*").alias("rollouts"), F.count_if("correct").alias("passes"), F.avg(F.col("correct").cast("double")).alias("pass_rate"))


def frontier(rates: DataFrame, rollouts: int = 8) -> DataFrame:
    """Neither always nor never solved, with all rollouts present."""
    return rates.where((F.col("rollouts") == rollouts) & F.col("passes").between(1, rollouts - 1))


def balanced(df: DataFrame, group: str, most: int, *order: str) -> DataFrame:
    """At most so many rows of each group, the first by order (a choice of this library: the recipe names no rule)."""
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= most).drop("__rn")


def reward(correct: Column, well_formed: Column, weights: tuple[float, float] = (1.0, 0.0)) -> Column:
    """The weighted sum of answer and format rewards."""
    return F.lit(weights[0]) * correct.cast("double") + F.lit(weights[1]) * well_formed.cast("double")


def exact_duplicates(df: DataFrame, key: str, *content: str) -> DataFrame:
    """df with keeper: the least key of the rows with the same content (nulls are equal). Counts of 256-bit hashes move, not contents."""
    digest = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    hashed = df.withColumn("__h", digest)
    keepers = hashed.groupBy("__h").agg(F.min(key).alias("keeper"))
    return hashed.join(keepers, "__h").drop("__h")


def tiled_pairs(df: DataFrame, group: list[str], key: str, value: str, compare: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], result: str, kind: str) -> DataFrame:
    """(a, b, result), a < b: the pairs inside groups that compare finds between two arrays of values (places in both, and the result).

    A group of more than TILE rows is dealt into tiles by a hash of the key, and
    its tiles meet in pairs: no task holds more than two tiles, and a hot
    group's work is spread over many. compare works on whole tiles.
    """
    many, own, low, high = fresh(df, "__tiles", "__tile", "__low", "__high")
    sizes = df.groupBy(*group).agg(F.count("*").alias("__n")).where("__n > 1").select(*group, F.ceil(F.col("__n") / TILE).cast("int").alias(many))
    dealt = df.join(sizes, group).withColumn(own, F.pmod(F.xxhash64(key), many).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    dealt = dealt.select(*group, key, value, own, other.alias("__other")).select(*group, key, value, own, F.least(own, "__other").alias(low), F.greatest(own, "__other").alias(high))
    names = dict(df.dtypes)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(key)
        halves = [rows[rows[own] == t] for t in (rows[low].iloc[0], rows[high].iloc[0])]
        out = pd.DataFrame({"a": [], "b": [], result: []})
        if len(halves[0]) and len(halves[1]):
            i, j, r = compare(*[np.stack(h[value].to_numpy()) for h in halves])
            x, y = halves[0][key].to_numpy()[i], halves[1][key].to_numpy()[j]
            ok = x < y if rows[low].iloc[0] == rows[high].iloc[0] else x != y
            out = pd.DataFrame({"a": np.minimum(x, y)[ok], "b": np.maximum(x, y)[ok], result: r[ok]})
        return out

    return dealt.groupBy(*group, low, high).applyInPandas(meet, f"a {names[key]}, b {names[key]}, {result} {kind}")


def hamming_pairs(df: DataFrame, key: str, value: str, most: int = 3) -> DataFrame:
    """(a, b, distance): rows whose 64-bit hashes differ in at most ``most`` bits, by pigeonhole over most + 1 bands.

    Equal hashes are one class first (the least key stands for it; see exact_duplicates for its members), so no group of
    copies is expanded into pairs; bands that very many hashes share are compared in tiles.
    """
    bands = most + 1
    width = -(-64 // bands)
    mask = (1 << width) - 1
    classes = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(key).alias("key"))
    cut = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.call_function("shiftrightunsigned", F.col(value), i * width).bitwiseAND(F.lit(mask)).alias("part")))
    wide = classes.select("key", value, F.explode(cut).alias("x")).select("key", value, "x.*")

    def near(x: np.ndarray, y: np.ndarray):
        distance = np.bitwise_count(x.astype(np.int64).view(np.uint64)[:, None] ^ y.astype(np.int64).view(np.uint64)[None, :])
        i, j = np.nonzero(distance <= most)
        return i, j, distance[i, j].astype(np.int32)

    return tiled_pairs(wide, ["band", "part"], "key", value, near, "distance", "int").distinct()


def cosine_pairs(vectors: DataFrame, key: str, value: str, least: float) -> DataFrame:
    """(a, b, cosine): all pairs of at least this cosine, in the same block where vectors has a column ``block`` (say, a cluster).

    Exact: full blocks are compared in tiles, by matrix products. Equal vectors
    of a block are one class, whose least key stands for it; a member is paired
    with that alone, so no group of copies is expanded. Null vectors and those of length 0 have no pairs.
    """
    norm = F.sqrt(F.aggregate(value, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    block = F.col("block") if "block" in vectors.columns else F.lit(0).alias("block")
    rows = vectors.select(F.col(key).alias("key"), block, F.transform(value, lambda x: x.cast("double")).alias("v"), norm.alias("norm")).where("norm > 0")
    classes = rows.groupBy("block", "v").agg(F.min("key").alias("key"), F.min("norm").alias("norm"), F.count("*").alias("copies"))
    copies = rows.join(classes.where("copies > 1").select("block", "v", F.col("key").alias("first")), ["block", "v"]).where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"), F.lit(1.0).alias("cosine"))
    unit = classes.select("block", "key", F.transform("v", lambda x: x / F.col("norm")).alias("unit"))

    def near(x: np.ndarray, y: np.ndarray):
        cosine = x @ y.T
        i, j = np.nonzero(cosine >= least)
        return i, j, cosine[i, j]

    return tiled_pairs(unit, ["block"], "key", "unit", near, "cosine", "double").unionByName(copies)
