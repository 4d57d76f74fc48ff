"""Merkle manifest of a dataset, kept as a postorder append log.

Rows are leaves, ordered by id within their group; two consecutive nodes make one of the next level, an odd one left over
makes one alone, and the groups' roots make the manifest's root in the same way. The tree is built by aligned builders:
each takes a run of ``2 ** BUILDER_LEVELS`` consecutive nodes, so that its subtree needs no other builder, and appends
nodes to its log in the order of their completion (postorder). The roots of all builders are the leaves of the next tier,
until each group has one node. A tier is that many times smaller than the one below; the number of tiers is the logarithm
of the rows, and no builder, task or driver ever holds more than one run.

Where a node stands in a log follows from the sizes of the subtrees before it alone (``position``), so a proof is read by
computed positions, without keys or pointers. Proofs go down the tiers: a run's path to the root is found once and handed
to its leaves.

Defined results: each NULL field counts as ``-``, an empty text as length 0; rows that repeat an id are leaves of their
own, ordered by their digests; a NULL id comes first; a NULL group is a group of its own, before all others; a group of one row
is its own root; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import arrow_type, numbered, small_batches, stored
from tripflow.session import scratch_path

BUILDER_LEVELS = 9
DIGEST = 32
ABOUT = ("tiers", "root_tiers", "builder_levels")
# What a path holds for each level: 0 for no sibling, 1 for one on the left, 2 on the right; then its digest.
STEP = 1 + DIGEST
NONE, LEFT, RIGHT = 0, 1, 2


# --- leaves -------------------------------------------------------------------------------


def field_text(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon and its text; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


# --- the log ------------------------------------------------------------------------------


def node_hash(*children: bytes) -> bytes:
    """A node's digest from its children's; digests enter as lower-case hex."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels_of(total: int) -> int:
    """Levels above the leaves of a tree."""
    return (total - 1).bit_length()


def position(level, index, leaves: int):
    """Where the node ``index`` of ``level`` stands in the postorder log of a tree; numbers or arrays.

    A node over ``2 ** level`` leaves follows all nodes that were complete with its last leaf: of each level, as many as
    that leaf's number has whole runs. The other nodes, one a level at most, are completed at the end from below.
    """
    level, index = np.asarray(level, np.int64), np.asarray(index, np.int64)
    last = ((index + 1) << level) - 1
    whole = 2 * last - np.bitwise_count(last) + level
    lowest = (leaves & -leaves).bit_length() - 1
    ragged = 2 * leaves - leaves.bit_count() + level - lowest - 1
    return np.where(last < leaves, whole, ragged)


def append_log(leaves: Iterable[bytes], levels: int) -> list[bytes]:
    """Nodes of a run's subtree in the order of their completion; the last one is its root."""
    log, open_nodes, n = [], [], 0
    for leaf in leaves:
        node, left = leaf, n
        log.append(node)
        while left & 1:
            node = node_hash(open_nodes.pop(), node)
            log.append(node)
            left >>= 1
        open_nodes.append(node)
        n += 1
    last = None  # the right-most node, if its run is short
    for level in range(levels):
        if n % (2 << level):
            children = [open_nodes.pop()] if n >> level & 1 else []
            last = node_hash(*children, *([last] if last is not None else []))
            log.append(last)
    return log


def paths(log: bytes, leaves: int, levels: int) -> np.ndarray:
    """For every leaf of a run, the sibling at each level with its side: an array of leaves x levels x ``STEP`` bytes."""
    nodes = np.frombuffer(log, np.uint8).reshape(-1, DIGEST)
    out = np.zeros((leaves, levels, STEP), np.uint8)
    for level in range(levels):
        own = np.arange(leaves) >> level
        other = own ^ 1
        there = np.flatnonzero(other < -(-leaves >> level))
        out[there, level, 0] = np.where(other[there] < own[there], LEFT, RIGHT)
        out[there, level, 1:] = nodes[position(level, other[there], leaves)]
    return out


def siblings(path: bytes) -> list[tuple[int, bytes]]:
    return [(path[i], path[i + 1 : i + STEP]) for i in range(0, len(path), STEP)]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of its path lead to."""
    for side, digest in siblings(path):
        leaf = node_hash(leaf) if side == NONE else node_hash(digest, leaf) if side == LEFT else node_hash(leaf, digest)
    return leaf


# --- building -----------------------------------------------------------------------------


@dataclass
class Manifest:
    """Stored tiers, lowest first, of the groups' trees and of the tree over their roots."""

    tiers: list[DataFrame]
    group_tiers: list[DataFrame]
    builder_levels: int


def _build(nodes: DataFrame, id_type: pa.DataType, id_kind: str, builder_levels: int) -> DataFrame:
    """One tier: runs of ``nodes`` (``_group``, ``_index``, ``_total``, ``_id``, ``_leaf``, ``_claim``) with their logs."""
    runs = nodes.withColumn("_run", F.shiftright("_index", builder_levels))
    dealt = runs.repartition("_group", "_run").sortWithinPartitions("_group", "_run", "_index")
    names = ["_group", "_run", "_total", "ids", "claims", "log"]

    def close(key, total, ids, leaves, claims):
        log = append_log(leaves, min(builder_levels, levels_of(total)))
        columns = [
            pa.array([key[0]], pa.string()),
            pa.array([key[1]], pa.int64()),
            pa.array([total], pa.int64()),
            pa.array([ids], pa.list_(id_type)),
            pa.array([claims], pa.list_(pa.binary())),
            pa.array([b"".join(log)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def build(batches: Iterator) -> Iterator:
        key, total, ids, leaves, claims = None, 0, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_group", "_run", "_total", "_id", "_leaf", "_claim")]
            for group, run, many, doc, leaf, claim in zip(*columns):
                if (group, run) != key:
                    if key is not None:
                        yield close(key, total, ids, leaves, claims)
                    key, total, ids, leaves, claims = (group, run), many, [], [], []
                ids.append(doc)
                leaves.append(leaf)
                claims.append(claim)
        if key is not None:
            yield close(key, total, ids, leaves, claims)

    kind = f"_group string, _run bigint, _total bigint, ids array<{id_kind}>, claims array<binary>, log binary"
    return dealt.select("_group", "_run", "_index", "_total", "_id", "_leaf", "_claim").mapInArrow(build, kind)


def _tiers(spark: SparkSession, nodes: DataFrame, id_type: pa.DataType, builder_levels: int, path: str, name: str) -> list[DataFrame]:
    kind = nodes.schema["_id"].dataType.simpleString()

    def written(tier: DataFrame, n: int) -> DataFrame:
        tier.write.option("compression", "zstd").parquet(f"{path}/{name}_{n}")
        return spark.read.schema(tier.schema).parquet(f"{path}/{name}_{n}")

    tiers = [written(_build(nodes, id_type, kind, builder_levels), 0)]
    while not tiers[-1].where(F.col("_run") > 0).isEmpty():
        runs = F.expr(f"shiftright(_total - 1, {builder_levels}) + 1")
        above = tiers[-1].select(
            "_group",
            F.col("_run").alias("_index"),
            runs.alias("_total"),
            F.lit(None).cast("string").alias("_id"),
            F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("_leaf"),
            F.lit(None).cast("binary").alias("_claim"),
        ).where("_total > 1")  # a group that has its root is done
        tiers.append(written(_build(above, pa.string(), "string", builder_levels), len(tiers)))
    return tiers


def build(spark: SparkSession, leaves: DataFrame, builder_levels: int = BUILDER_LEVELS, path: str | None = None) -> Manifest:
    """The manifest of ``leaves``: ``_group`` (string), ``_id``, ``_leaf`` (digest), ``_claim`` (digest that is put to
    the test in the leaf's place, or NULL). Its logs are written below ``path``, else to the scratch folder."""
    small_batches(spark)
    path = path or scratch_path(spark, "manifest")
    # Unlike NULL, the key of a NULL group can be joined; it sorts first.
    keyed = leaves.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col("_group")), F.lit("")))
    rows = numbered(spark, keyed, "_group", ["_id", "_leaf"], "leaves")
    tiers = _tiers(spark, rows, arrow_type(rows, "_id"), builder_levels, path, "tier")
    roots = tiers[0].where("false").select("_group", F.col("log").alias("_leaf"))
    for tier in tiers:
        done = tier.where(F.col("_run") == 0).where(F.col("_total") <= 1 << builder_levels)
        roots = roots.union(done.select("_group", F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("_leaf")))
    named = roots.select(F.lit("").alias("_group"), F.col("_group").alias("_id"), "_leaf", F.lit(None).cast("binary").alias("_claim"))
    group_rows = numbered(spark, named, "_group", ["_id"], "roots")
    group_tiers = _tiers(spark, group_rows, pa.string(), builder_levels, path, "root_tier")
    about = spark.range(1).select(*(F.lit(n).alias(c) for c, n in zip(ABOUT, (len(tiers), len(group_tiers), builder_levels))))
    about.write.parquet(f"{path}/about")
    return Manifest(tiers, group_tiers, builder_levels)


def open_manifest(spark: SparkSession, path: str) -> Manifest:
    """A manifest written before."""
    small_batches(spark)
    tiers, group_tiers, builder_levels = spark.read.parquet(f"{path}/about").select(*ABOUT).first()
    read = lambda name, n: [spark.read.parquet(f"{path}/{name}_{i}") for i in range(n)]
    return Manifest(read("tier", tiers), read("root_tier", group_tiers), builder_levels)


def root_of(manifest: Manifest) -> str | None:
    """The root in hex; an empty manifest has none."""
    top = _tops(manifest.group_tiers, manifest.builder_levels)[-1].first()
    return None if top is None else bytes(top["_top"]).hex()


# --- proofs -------------------------------------------------------------------------------


def _down(tier: DataFrame, above: DataFrame, builder_levels: int, by_id: bool) -> DataFrame:
    """Paths of a tier's leaves from those of its runs: ``_group``, ``_run`` (the leaf's index) and what ``above`` has."""
    joined = tier.drop("claims").join(above, ["_group", "_run"])

    def hand_down(batches: Iterator) -> Iterator:
        for batch in batches:
            for row in batch.to_pylist():
                own = _own_paths(row, len(row["ids"]), builder_levels)
                index = range(row["_run"] << builder_levels, (row["_run"] << builder_levels) + len(own))
                group = row["ids"] if by_id else [row["_group"]] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group, pa.string()),
                        pa.array([0] * len(own) if by_id else index, pa.int64()),
                        pa.array([p + row["_path"] for p in own], pa.binary()),
                        pa.array([row["_subroot"]] * len(own), pa.binary()),
                        pa.array([row["_root"]] * len(own), pa.binary()),
                    ],
                    names=["_group", "_run", "_path", "_subroot", "_root"],
                )

    return joined.mapInArrow(hand_down, "_group string, _run bigint, _path binary, _subroot binary, _root binary")


def _own_paths(row: dict, leaves: int, builder_levels: int) -> list[bytes]:
    flat = paths(row["log"], leaves, min(builder_levels, levels_of(row["_total"])))
    return [p.tobytes() for p in flat]


def _tops(tiers: list[DataFrame], builder_levels: int) -> list[DataFrame]:
    """Of each tier the runs that are a whole group: ``_group``, ``_run`` and the group's root."""
    return [
        tier.where((F.col("_run") == 0) & (F.col("_total") <= 1 << builder_levels)).select(
            "_group", "_run", F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("_top")
        )
        for tier in tiers
    ]


def _run_paths(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """The path, subroot and root of every run of the lowest tier."""
    levels = manifest.builder_levels
    root = _tops(manifest.group_tiers, levels)[-1]
    above = root.select("_group", "_run", F.lit(b"").alias("_path"), F.col("_top").alias("_subroot"), F.col("_top").alias("_root"))
    for i, tier in reversed(list(enumerate(manifest.group_tiers))):
        above = stored(spark, _down(tier, above, levels, by_id=i == 0), "root_paths")
    groups = above.select("_group", "_path", "_root")
    below = None
    for tier, top in reversed(list(zip(manifest.tiers, _tops(manifest.tiers, levels)))):
        # Groups whose root lies in this tier start here; the others come from the tier above.
        starting = top.join(groups, "_group").select("_group", "_run", "_path", F.col("_top").alias("_subroot"), "_root")
        above = starting if below is None else starting.union(below)
        if tier is manifest.tiers[0]:
            return above
        below = stored(spark, _down(tier, above, levels, by_id=False), "paths")


def proofs(spark: SparkSession, manifest: Manifest, ids: DataFrame | None = None) -> DataFrame:
    """One row per leaf: ``_group``, ``_id``, ``_leaf``, ``_claim``, ``_path``, ``_subroot``, ``_root``.

    With ``ids`` (one column) only those leaves; logs of other runs are not opened.
    """
    levels = manifest.builder_levels
    lowest = manifest.tiers[0]
    if ids is not None:
        ids = ids.toDF("_id").distinct()
        held = lowest.select("_group", "_run", F.explode("ids").alias("_id")).join(ids, "_id", "left_semi")
        lowest = lowest.join(held.select("_group", "_run").distinct(), ["_group", "_run"], "left_semi")
    joined = lowest.join(_run_paths(spark, manifest), ["_group", "_run"])
    element = lowest.schema["ids"].dataType.elementType.simpleString()
    id_type = arrow_type(lowest, "ids").value_type

    def extract(batches: Iterator) -> Iterator:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                at = position(0, np.arange(n), n) * DIGEST
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["_group"][1:] if row["_group"] else None] * n, pa.string()),
                        pa.array(row["ids"], id_type),
                        pa.array([row["log"][a : a + DIGEST] for a in at.tolist()], pa.binary()),
                        pa.array(row["claims"], pa.binary()),
                        pa.array([p + row["_path"] for p in _own_paths(row, n, levels)], pa.binary()),
                        pa.array([row["_subroot"]] * n, pa.binary()),
                        pa.array([row["_root"]] * n, pa.binary()),
                    ],
                    names=["_group", "_id", "_leaf", "_claim", "_path", "_subroot", "_root"],
                )

    kind = f"_group string, _id {element}, _leaf binary, _claim binary, _path binary, _subroot binary, _root binary"
    found = joined.mapInArrow(extract, kind)
    return found if ids is None else found.join(ids, "_id", "left_semi").select(found.columns)


def verify(proven: DataFrame) -> DataFrame:
    """``proven`` with ``_folded``, the root that the claim (else the leaf) folds to, and ``_siblings``, the hash of all siblings."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            leaves, claims, found = (batch.column(c).to_pylist() for c in ("_leaf", "_claim", "_path"))
            folded = [fold(leaf if claim is None else claim, path) for leaf, claim, path in zip(leaves, claims, found)]
            hashes = [node_hash(*(digest for side, digest in siblings(path) if side)) for path in found]
            extra = [pa.array(folded, pa.binary()), pa.array(hashes, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "_folded", "_siblings"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in proven.schema)
    return proven.mapInArrow(run, f"{kinds}, _folded binary, _siblings binary")
