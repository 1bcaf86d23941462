"""Python workers: let them import this package where it is not installed, and give their memory back."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows and bytes of an Arrow batch of texts, at most (a longer row is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def share_package(spark: SparkSession) -> SparkSession:
    """Put the folder of this package on the workers' module path, and bound the session's Arrow batches.

    On a cluster, install the package or ship it with the job. Bounds that are lower already stay.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("b"))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
    return spark


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc: nothing to hand back
        pass


def lean(f: Callable[[Iterator], Iterator], *caches: Callable[[], None]) -> Callable[[Iterator], Iterator]:
    """An Arrow function whose worker clears ``caches`` and hands its free memory back when a task's rows end.

    Workers live on from stage to stage; without this, each keeps the most it ever needed.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            for clear in caches:
                clear()
            _trim()

    return run
