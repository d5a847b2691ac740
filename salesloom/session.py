"""Session settings and the shared folder every written table goes to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where a later operator then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_RUN = uuid.uuid4().hex[:12]


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the run-time re-planning the operators count on."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


# Shuffle files of a write go as soon as it is done, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _lock = 0, threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files behind. Only for what is run once: a frame run again would have to make them anew."""
    global _cleaning
    with _lock:
        _cleaning += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _cleaning -= 1
            if not _cleaning:
                spark.conf.unset(_CLEANUP)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can read, named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="salesloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def run_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder that belongs to this application and process only."""
    return "/".join([shared_dir(spark).rstrip("/"), "salesloom", spark.sparkContext.applicationId, _RUN, *parts])
