"""Timing and progress of long steps, in the log ``orgweave``."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("orgweave")
T = TypeVar("T")


@contextmanager
def timed(name: str) -> Iterator[None]:
    """Logs a step's seconds, also if it fails."""
    began = time.perf_counter()
    try:
        yield
    except Exception:
        log.info("%s failed after %.1f s", name, time.perf_counter() - began)
        raise
    log.info("%s took %.1f s", name, time.perf_counter() - began)


def progress(items: Iterable[T], name: str) -> Iterator[T]:
    """The items, logging after each how many are done, the seconds taken and those left at this pace."""
    todo = list(items)
    began = time.perf_counter()
    for k, item in enumerate(todo, 1):
        yield item
        took = time.perf_counter() - began
        log.info("%s: %d of %d (%.0f %%), %.1f s, about %.1f s left", name, k, len(todo), 100 * k / len(todo), took, took / k * (len(todo) - k))


def query(spark: SparkSession, sql: str, shown: int = 100) -> DataFrame:
    """Runs SQL once and keeps its rows in a written table, logging the statement's first ``shown`` characters, its rows and seconds."""
    from .staging import stage

    began = time.perf_counter()
    out = stage(spark.sql(sql), "query")
    log.info("%s: %d rows in %.1f s", " ".join(sql.split())[:shown], out.count(), time.perf_counter() - began)
    return out
