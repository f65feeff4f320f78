"""Resumable processing of a growing folder with Structured Streaming.

The checkpoint remembers which files were read; results already written are
anti-joined inside each batch, so a key is done once even if its input comes
again, and no state grows in memory. Invalid results are logged apart and tried
again when their input is offered anew. A batch that failed between its writes
replaces what it wrote. All that is there is processed, then the stream ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut


def run(spark: SparkSession, source: str, schema: str, target: str, failed: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str = "id", valid: str = "valid", form: str = "parquet") -> None:
    """work maps a batch of new rows to results with key and valid; valid ones go to target, others to failed (Parquet)."""

    def each(batch: DataFrame, number: int) -> None:
        new = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        # what this batch itself left in an earlier attempt is done again and replaced, whole; other checkpoints' batches have other names
        own = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        done = stored(spark, target, f"`{key}` {dict(batch.dtypes)[key]}, batch string")
        if done is not None:
            new = new.join(done.where(F.col("batch") != own).select(key), key, "left_anti")
        results = cut(work(new))
        ok = F.coalesce(F.col(valid), F.lit(False))
        results.where(ok).write.mode("overwrite").parquet(f"{target}/batch={own}")
        results.where(~ok).write.mode("overwrite").parquet(f"{failed}/batch={own}")

    rows = spark.readStream.format(form).schema(schema).load(source)
    rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The results so far, or None before the first batch. With a schema, a folder whose first write failed is empty."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def finished(results: DataFrame | None, expected: int, key: str = "id", failures: int = 0) -> bool:
    """Whether as many distinct keys are valid as expected, and nothing failed in this run."""
    return results is not None and failures == 0 and results.select(key).distinct().count() >= expected
