"""Reading trip files, fact tables and warehouse tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.operators.align import union_all

# Files whose headers are looked up at a time.
LOOK_UPS = 16


def read_trips_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None = None,
    with_file: bool = False,
) -> DataFrame:
    """Delimited trip files with a header, every column a string.

    Spark binds the columns of all files in one read by position. Files below one glob
    whose headers differ would therefore swap values silently, so they are grouped by
    header first, each group is read under its own schema with the header check on,
    and the groups are put together by name. The look-up is one small job for each file,
    ``LOOK_UPS`` at a time, which ends at the header line; file names and header lines
    reach the driver. Passing ``schema`` skips the look-up, and all files must then carry exactly
    that header or the scan fails.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None:
        return _read_group(spark, paths, schema.fieldNames(), with_file)

    groups: dict[tuple[str, ...], list[str]] = {}
    for files in _files_by_header(spark, paths):
        columns = tuple(spark.read.option("header", True).csv(files[0]).columns)
        if columns:
            groups.setdefault(columns, []).extend(files)
    if not groups:
        raise ValueError(f"no file with a header in {paths}")
    frames = [_read_group(spark, sorted(group), columns, with_file) for columns, group in groups.items()]
    return frames[0] if len(frames) == 1 else union_all(frames, fold_case=False)


def _files_by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Files grouped by their first line that is not blank; a file without one has no rows.

    The limit ends a file's scan at that line, so only heads are read, on the executors. One scan over all files could
    not end early in each of them.
    """
    files = sorted(_as_path(uri) for uri in spark.read.text(list(paths)).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(LOOK_UPS) as pool:
        for file, header in zip(files, pool.map(lambda f: _first_line(spark, f), files)):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return sorted(groups.values())


def _first_line(spark: SparkSession, file: str) -> str | None:
    found = spark.read.text(file).where(F.trim("value") != "").first()
    return None if found is None else found["value"]


def _as_path(uri: str) -> str:
    """A listed file as a path to read: no URI escapes, and nothing taken for a glob."""
    return re.sub(r"([*?\[\]{}])", r"\\\1", unquote(uri))


def _read_group(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], with_file: bool
) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(list(paths))
    return df.withColumn("source_file", F.col("_metadata.file_path")) if with_file else df


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone dimension as delimited text: ``zone_id, borough`` (and more if present)."""
    return read_trips_csv(spark, path)


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A parquet table by folder, glob or list of them."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_warehouse(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> DataFrame:
    """A warehouse table: from the catalog, or through a connector format.

    With ``fmt`` the table name goes to the connector as its ``table`` option, next to
    any further ``options`` such as a project.
    """
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).option("table", name).options(**options).load()


def read_pairs_csv(
    spark: SparkSession, path: str, label: str = "label", feature: str = "x", partitions: Sequence[str] = ()
) -> DataFrame:
    """Header-less ``label,feature`` lines as two doubles, with text ``partitions`` from folder names.

    A broken line fails the read.
    """
    schema = ", ".join([f"`{label}` double", f"`{feature}` double", *(f"`{p}` string" for p in partitions)])
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
