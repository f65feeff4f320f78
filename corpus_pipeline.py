"""A corpus pipeline of llm operators; each stage's rows are written and read again by the next.

Stages, in order: toxic documents go; repeated lines go; of each group of near
copies the document with the smallest id stays; documents with benchmark
passages go; the rest is encoded. All but the last return the columns of
documents, and n_chars follows the text. Rows without an id can't be judged by
the stages that compare documents and stay. Null texts stay null until they are
encoded as empty. Empty tables give none, whatever the stage; other columns of
documents are left out by the first stage, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, jaccard, linededup, pieces, toxicity
from tessera.llm.common import compact, small_join, table, written
from tessera.llm.queries import default_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs less the ids in dropped, which is broadcast if measured to be small, else joined by an exchange. Rows without an id stay."""
    return small_join(docs, compact(dropped.where("doc_id is not null").distinct(), "dropped"), "doc_id", "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score under 0.7. The lexicon is learnt from the labelled ones among them, less the held-out third. Null and empty texts stay; repeated rows fare alike."""
    docs = docs.select(*COLUMNS)
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id")))
    return toxicity.with_score(docs, lexicon, to="__score").where("__score < 0.7").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that at least three of them have, in all but the largest id. Null texts stay null and keep n_chars; a text that loses all lines is empty."""
    return linededup.dedup(docs.select(*COLUMNS), copies=3, least=20).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id. Null and empty texts are copies of nothing; rows that repeat an id stay or go together."""
    return without(docs, jaccard.join(docs, width=5, num=80, den=100).where("component_id <> doc_id").select("doc_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any benchmark window. Rows that repeat an id of a contaminated one go with it."""
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"), width=10)
    return without(docs, found.where(F.size("starts") > 0).select("doc_id"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, their number and digests, with lang and source. Null and empty texts have no ids."""
    return pieces.encode(docs, default_model(), keep_text=False, carry=("lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]
#: Components, encoding and a fitted lexicon are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
