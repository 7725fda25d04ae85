"""Sinks and sources: Parquet, CSV, JSON documents and model files."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at))


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is none."""
    return spark.read.parquet(path) if exists(spark, path) else None


def cached(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; computed and written first where there is none."""
    if (found := load_parquet(spark, path)) is None:
        save_parquet(compute(), path)
        found = spark.read.parquet(path)
    return found


def save_csv(df: DataFrame, path: str) -> None:
    """Arrays and structs are written as JSON text, which CSV can hold."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def save_json(value: Any, path: str, spark: SparkSession) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, default=str).encode()))
    finally:
        out.close()


def load_json(path: str, spark: SparkSession) -> Any:
    """The document, or None where there is none."""
    if not exists(spark, path):
        return None
    return json.loads("\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))


def save_model(settings: dict, metadata: dict, path: str, spark: SparkSession) -> None:
    stamp = {"timestamp": datetime.now(timezone.utc).isoformat()}
    save_json(settings | {"training_metadata": stamp | metadata}, path, spark)


def load_model(path: str, spark: SparkSession) -> dict | None:
    """Settings without the metadata of their training."""
    found = load_json(path, spark)
    return found and {k: v for k, v in found.items() if k != "training_metadata"}


def save_results(predictions: DataFrame, folder: str, high: float = 0.95) -> list[str]:
    """Judged matches, judged rejections and high-confidence pairs, each only if there are any."""
    parts = {"high_confidence": F.col("match_probability") >= high}
    if "llm_match" in predictions.columns:
        parts = {"llm_confirmed": F.col("llm_match"), "llm_rejected": ~F.col("llm_match")} | parts
    written = []
    for name, condition in parts.items():
        part = predictions.where(condition)
        if not part.isEmpty():
            save_parquet(part, f"{folder}/{name}")
            written.append(name)
    return written
