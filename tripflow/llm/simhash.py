"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart have a common value within ``r`` bits of both. Every distinct fingerprint
emits all values of its ball, values are grouped, and a group's members are linked after a check of their distance.

For the production radius (2 bits, so balls of 65 values) a group keeps its members in two numbers: which single-bit
flips of the value, and whether the value itself, is a fingerprint. So the shuffle carries fixed-size rows that are
combined before it, a group has at most 65 members whatever the data, and no pair is lost or repeated. Larger radii use
the general form, whose groups are bounded by the ball's size.

Defined results: a NULL or empty text has no words and the fingerprint zero, linked like any other; repeated rows share
a fingerprint; a NULL id is linked but never names a component unless all ids there are NULL.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import arrow_type, row_key, rows_of, select_rows, small_batches, stored
from tripflow.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: per bit, the majority of the XXH64 values of its word shingles."""
    words = text.lower().split() if text else []  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``_id``, ``_key``, ``fp`` (signed) of every row."""
    small_batches(spark)
    rows = docs.select(
        F.col(id_col).alias("_id"), row_key(F.col(text_col)).alias("_key"), F.col(text_col).cast("binary").alias("_text")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = arrow_type(rows, "_id")

    def run(batches):
        for batch in batches:
            ids, keys = batch.column("_id").cast(id_type), batch.column("_key")
            values = [fingerprint(text, shingle) for (text,) in rows_of([batch], "_text")]
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(values, pa.int64())], names=["_id", "_key", "fp"])

    return rows.mapInArrow(run, f"_id {kind}, _key bigint, fp bigint")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (``fp``) that connect all pairs at most ``max_bits`` apart."""
    radius = (max_bits + 1) // 2
    if radius == 1:
        return _ball_one(prints, max_bits)
    # The values within the radius, as masks; each group's members meet in one array of at most the ball's size.
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    signed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in masks))
    groups = (
        prints.select("fp", F.explode(signed).alias("mask"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("mask")).alias("value"))
        .agg(F.array_sort(F.collect_set("fp")).alias("members"))
        .where(F.size("members") > 1)
    )
    # Members of a ball may be more than max_bits apart when max_bits is odd, so each is tried with those before it.
    tail = groups.select(F.posexplode("members").alias("i", "b"), "members")
    near = F.filter(F.slice("members", F.lit(1), F.col("i")), lambda a: F.bit_count(a.bitwiseXOR(F.col("b"))) <= max_bits)
    return tail.select(F.explode(near).alias("a"), "b").distinct()


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _ball_one(prints: DataFrame, max_bits: int) -> DataFrame:
    flips = F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")
    one = _bit(F.col("bit"))
    groups = (
        prints.select("fp", flips)
        .select(
            F.when(F.col("bit") < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(one)).alias("value"),
            F.when(F.col("bit") < 0, F.lit(0).cast("bigint")).otherwise(one).alias("flip"),
            (F.col("bit") < 0).cast("int").alias("own"),
        )
        .groupBy("value")
        .agg(F.bit_or("flip").alias("flips"), F.max("own").alias("own"))
        .where(F.bit_count("flips") + F.col("own") > 1)
    )
    value = F.col("value")
    flipped = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(63)), _bit),
        lambda bit: F.col("flips").bitwiseAND(bit) != 0,
    )
    members = F.concat(
        F.when(F.col("own") == 1, F.array(value)).otherwise(F.array().cast("array<bigint>")),
        F.transform(flipped, lambda bit: value.bitwiseXOR(bit)),
    )
    sets = groups.select(F.array_sort(members).alias("members"))
    if max_bits == 2:  # any two members are within two bits: a star connects them
        pairs = sets.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", 2, 65)).alias("b"))
    else:  # one bit: the pairs are those of the value itself
        pairs = groups.where("own = 1").select(value.alias("a"), F.explode(members).alias("b")).where("a <> b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Of every row ``_id``, ``_key``, ``fp``, ``root`` and ``component_id``.

    ``root`` is the least fingerprint of the component and tells components apart; ``component_id`` is the smallest id
    reachable over links.
    """
    rows = stored(spark, fingerprints(spark, docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(spark, rows.groupBy("fp").agg(F.min("_id").alias("least")), "distinct-fingerprints")
    if max_bits == 0:
        named = distinct.select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    else:
        root = components(spark, links(distinct.select("fp"), max_bits))
        rooted = distinct.join(root, distinct["fp"] == root["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )
        first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        named = rooted.join(first, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("_id", "_key", "fp", "root", "component_id")


def one_of_each_group(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Of each group of near-duplicates one row: that of the smallest id, of equal ids one text by its hash.

    Two texts under one id that are not alike are in different groups and both stay; NULL ids come last.
    """
    found = near_duplicates(spark, docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col("_id").isNull(), "_id", "_key")
    rows = found.groupBy("root", "_id", "_key").agg(F.count("*").alias("n"))
    chosen = stored(spark, rows.groupBy("root").agg(F.min_by(F.struct("_id", "_key", "n"), order).alias("r")).select("r.*"), "kept")
    # Rows that stand once are let through; those repeated exactly are few, and are brought together to keep one.
    once = stored(spark, chosen.where("n = 1"), "kept-once")
    repeated = stored(spark, chosen.where("n > 1"), "kept-repeated")
    copies = select_rows(docs, repeated, id_col, text_col, "left_semi")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = copies.groupBy(F.col(id_col).alias("_id"), row_key(F.col(text_col)).alias("_key")).agg(F.first(whole).alias("r"))
    return select_rows(docs, once, id_col, text_col, "left_semi").union(one.select("r.*"))
