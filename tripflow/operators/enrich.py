"""Joining trips to the zone dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table, measured by one aggregation over it, is small enough to broadcast.

    Counts 16 bytes for each fixed-width value, the length of each text and 32 bytes of
    overhead for each row.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    fixed = 32 + 16 * len(df.columns)
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts]
    row_bytes = sum((length.cast("long") for length in lengths), F.lit(fixed).cast("long"))
    total = df.agg(F.sum(row_bytes).alias("b")).first()["b"]
    return (total or 0) <= max_bytes


def unique_zones(zones: DataFrame, zone_key: str, columns: Sequence[str]) -> DataFrame:
    """One row per zone. Where copies differ, the greatest values win, on every run."""
    one = F.max(F.struct(*columns)).alias("one")
    return zones.groupBy(zone_key).agg(one).select(zone_key, "one.*")


def enrich_zone(
    trips: DataFrame,
    zones: DataFrame,
    key: str = "locationID",
    how: str = "left",
    zone_key: str = "zone_id",
    columns: Sequence[str] = ("borough",),
    dedup_dim: bool = True,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Adds zone columns to trips.

    ``how`` is ``left`` (trips of unknown zones stay, with NULL) or ``inner``. The
    published zone list repeats some keys; ``dedup_dim=False`` keeps the repeats, and
    with them the multiplied trips.

    The measured dimension is broadcast when it is within the bound, which leaves the
    trips unshuffled. Beyond it both sides are shuffled on the key; the dimension is
    rebalanced after deduplication so that its exchange is a plain one, which is what
    lets AQE split the partition of a hot zone.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how}")
    dim = zones.select(F.col(zone_key).try_cast(trips.schema[key].dataType).alias("_zone"), *columns)
    dim = dim.where(F.col("_zone").isNotNull())
    small = fits_broadcast(dim, max_broadcast_bytes)
    if dedup_dim:
        dim = unique_zones(dim, "_zone", columns)
    dim = F.broadcast(dim) if small else dim.hint("rebalance")
    return trips.join(dim, F.col(key) == F.col("_zone"), how).drop("_zone")
