"""What the training-data operators share: word rules, stored intermediates, row selection."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from tripflow.session import scratch_path

# Words of the phrase operators in UTF-8 after ASCII lower-casing: runs of digits, a-z and non-ASCII characters.
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
# What one Arrow batch holds at most; a longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 500, 4 * 1024 * 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage cut that survives lost executors."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_bucket(key: Column, modulus: int, rest: int) -> Column:
    """Whether CRC-32 of the key as text leaves this rest; false for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == rest, F.lit(False))


def row_key(text: Column) -> Column:
    """Tells rows apart that repeat an id with another text."""
    return F.xxhash64(text)


def select_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """Rows of ``docs`` named (``left_semi``) or not named (``left_anti``) by ``decided`` (``_id``, ``_key``).

    Spark broadcasts ``decided`` only below its own threshold, measured on the stored table; otherwise both sides are
    shuffled on near-unique keys.
    """
    same = docs[id_col].eqNullSafe(decided["_id"]) & (row_key(docs[text_col]) == decided["_key"])
    return docs.join(decided, same, how)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES``; smaller settings are kept.

    The default of 10,000 rows is meant for short rows: of documents it is tens of megabytes in the JVM and again in
    Python, for every task. The settings have no bearing on results.
    """
    prefix = "spark.sql.execution.arrow"
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = str(spark.conf.get(f"{prefix}.{name}")).rstrip("bB")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(f"{prefix}.{name}", str(most))


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, one value at a time, so that a batch of long texts is not copied whole."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a DDL schema; made by the driver, since parsing DDL needs the session."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def numbered(spark: SparkSession, df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``_index`` (from 0, in ``order`` within ``group``) and ``_total`` (rows of the group), stored before.

    Rows are dealt by ranges of group and order, and numbered by their place in a range plus what the group has in the
    ranges before. A group of any size is so split over all tasks; rows alike in ``order`` are kept apart by the place
    they were stored at, so they may be split as well. The running sum sees one row for each group of each range.
    """
    placed = stored(spark, df.withColumn("_at", F.monotonically_increasing_id()), name)
    ranged = placed.repartitionByRange(group, *order, "_at").sortWithinPartitions(group, *order, "_at").drop("_at")
    # The stored id tells range and place: Spark puts the partition's number into its upper bits.
    rows = stored(spark, ranged.withColumn("_row", F.monotonically_increasing_id()), f"{name}_ranged")
    part = F.shiftright("_row", 33)
    runs = rows.groupBy(part.alias("_part"), group).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part",
        F.col(group).alias("_group_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("_total"),
    )
    same = (part == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group_of"))
    index = (F.col("_row") + F.col("_shift")).alias("_index")
    return rows.join(runs, same).select(*(rows[f"`{c}`"] for c in df.columns), index, "_total")
