"""Writing and publishing result tables."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripflow.session import scratch_path, setting


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    compact: bool = False,
    mode: str = "overwrite",
) -> None:
    """Parquet sink.

    ``compact`` lets Spark rebalance the output to files of the advisory size: a small
    aggregate lands in a single file, while a table of any size never passes through
    one task. With ``partition_by`` the rows of one folder are brought together so, and
    a folder too large for one file gets several. It sets a session-wide option while it
    writes, so concurrent writes of one session should use sessions of their own
    (``spark.newSession()``).
    """
    writer = (df.hint("rebalance", *partition_by) if compact else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    merge = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    with setting(df.sparkSession, merge, "false") if compact else nullcontext():
        writer.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared scratch folder and read back: every later use sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_pairs_csv(
    df: DataFrame,
    path: str,
    label: str | Column,
    feature: str | Column,
    partition_by: Sequence[str] = (),
) -> None:
    """Two columns as header-less, uncompressed, comma separated doubles, in a folder per ``partition_by`` value."""
    cols = [df[c] if isinstance(c, str) else c for c in (label, feature)]
    writer = df.select(*[c.try_cast("double") for c in cols], *partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("header", False).option("sep", ",").option("compression", "none").csv(path)


def write_warehouse(
    df: DataFrame, name: str, fmt: str = "parquet", connector: bool = False, **options: str
) -> None:
    """Overwrite a warehouse table: in the catalog, or through a connector format."""
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if connector:
        writer.option("table", name).save()
    else:
        writer.saveAsTable(name)


def publish_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Declare an external parquet table over written files unless it exists already."""
    partitioned = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING PARQUET {partitioned} "
        f"LOCATION '{location}' TBLPROPERTIES ('classification' = 'parquet')"
    )
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def preview(df: DataFrame, n: int = 50, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` a top-n that is the same on every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
