"""Memory of Python workers, which Spark keeps from task to task."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SECONDS = 1  # between two times in a task


def give_back() -> None:
    """What the allocators keep for later goes back to the system: Spark takes workers in turn, so idle ones hold as much as those at work."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, for mapInArrow; now and then and at the end of a task its worker gives memory back."""

    def task(batches: Iterator) -> Iterator:
        last = time.monotonic()
        try:
            for out in run(batches):
                yield out
                if time.monotonic() > last + SECONDS:
                    give_back()
                    last = time.monotonic()
        finally:
            give_back()

    return task


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send at most so many rows to a Python worker at once: texts are large, and both sides hold a batch."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)
