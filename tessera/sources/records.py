"""Reading and writing pools and result logs. Schemas are declared, never inferred from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


def parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def row_count(spark: SparkSession, path: str) -> int:
    """From the files' footers: no column is read."""
    return spark.read.parquet(path).count()


def jsonl(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines with their file). Strict: a bad line raises when read. Blank lines are skipped."""
    own = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if strict:
        return spark.read.schema(own).option("mode", "FAILFAST").json(path), spark.createDataFrame([], "line string, file string")
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    # parsed beside the raw line: a query on the bad lines alone would not fill a corrupt-record column
    marked = lines.withColumn("r", F.from_json("value", T.StructType([*own, T.StructField(_CORRUPT, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    bad = F.col(f"r.{_CORRUPT}").isNotNull()
    return marked.where(~bad).select(*[F.col(f"r.`{f.name}`") for f in own]), marked.where(bad).select(F.col("value").alias("line"), "file")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    """zstd without dictionaries; tasks commit by rename, so a reader sees whole files. With by, only the partitions in df are replaced."""
    w = df.write.mode("overwrite").option("compression", "zstd").option("parquet.enable.dictionary", "false")
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_both(df: DataFrame, valid: str, good: str, bad: str, both: bool = False) -> None:
    """Valid rows to one log, others to another; with both, these also to the first. df is computed once, in its own stage."""
    from tessera.session import cut

    kept = cut(df)
    ok = F.coalesce(F.col(valid), F.lit(False))
    append_jsonl(kept if both else kept.where(ok), good)
    append_jsonl(kept.where(~ok), bad)


def images(spark: SparkSession, path: str) -> DataFrame:
    """Spark's image source; unreadable files have sizes of -1."""
    return spark.read.format("image").option("dropInvalid", "false").load(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def write_splits(df: DataFrame, path: str, order: str = "index") -> None:
    """df, with split, as one file a split, 0.parquet and so on, each in the given order; a file appears whole, by a rename, and replaces an older one."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    work = f"{path}/_writing"
    df.repartition("split").sortWithinPartitions("split", order).write.mode("overwrite").option("compression", "zstd").option("parquet.enable.dictionary", "false").partitionBy("split").parquet(work)
    for folder in fs.listStatus(place(work)):
        if folder.isDirectory():
            (file,) = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            to = place(f"{path}/{folder.getPath().getName().removeprefix('split=')}.parquet")
            fs.delete(to, False)
            fs.rename(file, to)
    fs.delete(place(work), True)


def adopted_splits(spark: SparkSession, path: str, n: int) -> DataFrame:
    """An existing folder of split files as a table with split and no copying; another number of splits than n raises."""
    from tessera.operators.partition import file_split

    df = spark.read.parquet(path).withColumn("split", file_split(F.col("_metadata.file_path"))).where("split is not null")
    have = df.select("split").distinct().count()
    if have != n:
        raise ValueError(f"{have} splits with rows where {n} are expected")
    return df
