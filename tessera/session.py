"""Session helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a session on this machine alone (tests) gets a temporary one; a cluster's raises, as its executors don't see this machine's."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        own = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not own and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="tessera-"))
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_written: list[tuple[SparkSession, str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: the lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def clean() -> None:
    """Delete the tables that written() has left; call it when no result that reads them is in use."""
    while _written:
        spark, path = _written.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended
            return


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores at their ends as it takes for df to have none of them."""
    have = {c.lower() for c in df.columns}
    while any(n.lower() in have for n in names):
        names = tuple(f"{n}_" for n in names)
    return list(names)


def find_package(spark: SparkSession) -> None:
    """Let Python workers that can see this machine's files find the package; elsewhere it must be installed or shipped."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
