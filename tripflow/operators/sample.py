"""Sampling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 30) -> DataFrame:
    """Bernoulli sample without replacement; which rows it takes depends on the partitions."""
    return df.sample(False, fraction, seed)


def hash_sample(df: DataFrame, *keys: str, fraction: float = 0.1) -> DataFrame:
    """Sample by a hash of key columns: the same rows on any cluster and partitioning.

    Rows with equal keys are taken or left together, and a smaller sample is part of a
    larger one. Eight hex digits of fixed width order as text the way they do as numbers;
    a fraction that rounds to all of their 2^32 values takes every row.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must be between 0 and 1, not {fraction}")
    bound = round(fraction * 2**32)
    if bound >= 2**32:
        return df
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.where(F.substring(F.md5(text), 1, 8) < f"{bound:08x}")
