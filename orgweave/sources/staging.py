"""Tables in the cluster's shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .progress import timed

ROOT = str(Path(__file__).resolve().parents[2])
_written: list[tuple[SparkSession, str]] = []


def ready(spark: SparkSession) -> None:
    """Lets Python workers that start from now on import this package when it lies beside the driver."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset and the master is local, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="orgweave-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(shutil.rmtree, found, True)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed at the end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a table of its own and reads it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with timed(name):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deals a table of few files to all cores, where much work is to be done for each row."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def _clean() -> None:
    for spark, path in _written:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session is gone; the folder's owner clears it
            return
