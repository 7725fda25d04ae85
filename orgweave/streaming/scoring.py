"""Scoring of records as they arrive, against a reference table that stays.

An extension: each micro-batch runs the batch plan and its result is written once under its batch number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.linkage import predict


def score_stream(stream: DataFrame, reference: DataFrame, prepare: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True, **options) -> StreamingQuery:
    """Starts scoring; ``prepare`` brings a batch to features. A batch that is run again overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        predict(reference, prepare(batch), **options).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
