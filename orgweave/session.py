"""The Spark session for local runs; on a cluster the submitted one is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A session on this machine. Adaptive execution sizes joins and splits skewed ones at run time."""
    conf = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(partitions or cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName("orgweave").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
