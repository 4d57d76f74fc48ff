"""Session-level helpers: the shared scratch folder and the settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# What the jobs assume. All of these are SQL settings a running session may change.
#  * UTC: pickup times are local wall-clock times and must not be shifted.
#  * AQE: splits skewed join partitions and merges small output partitions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_SETTINGS`` to a running session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One session setting for the length of an action."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tripflow-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Every executor must be able to reach it, so a machine-local folder is made up only
    for a local master that names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/tripflow/{uuid.uuid4().hex}/{name}"
