"""The shared folder for checkpoints and other scratch data."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# per session: how many blocks are open, and the value to restore after the last
_open: dict[int, tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside delete their shuffle files when they end, not when the driver collects garbage.

    A job of several writes then holds the files of one of them. Spark's setting for it changes no result: a frame
    that is run once more makes its files again. The session's own value is restored, also after a failure; blocks
    may be open in several threads.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        depth, before = _open.get(session, (0, spark.conf.get(_RELEASE, None)))
        _open[session] = depth + 1, before
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            depth, before = _open.pop(session)
            if depth > 1:
                _open[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(_RELEASE)
            else:
                spark.conf.set(_RELEASE, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, from ``spark.checkpoint.dir``.

    A cluster must set it to a folder that all executors share. Only a local
    master may do without: then a folder in the warehouse serves.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
