"""Prefix trie of conversations, aggregated at every depth without building a tree of objects.

1. Turns become (MD5 of role and text, bytes of the text) and are gathered by block of conversations, so that a rebuilt
   conversation finds the opening it borrows in its own task.
2. Equal rebuilt conversations become one sequence with a count, its smallest member, and the digest of its members. Members
   are dealt by ranges of (sequence, id) and joined to runs of text there, so that a sequence that a third of all
   conversations share costs one row a range in the end, which one task only hashes in order.
3. Sequences are dealt by ranges of their turns (shards). A shard numbers its turns, sorts its sequences by numpy ``lexsort``
   over turn-id matrices padded to the longest (``BLOCK`` columns at a time, and only of sequences still tied), and
   ORs the changes between neighbours over the columns: where the mask is set at a column, a node starts; ``reduceat``
   over those starts aggregates a depth. In preorder a node's subtree is a slice, so sums over subtrees are differences
   of running sums.
4. Only nodes on a shard's first and last path can be shared with other shards (boundary nodes). A shard knows how much of its
   first path the shard before holds too, so each node, child and leaf is counted by the first shard that holds it, and
   all aggregates of boundary nodes add up (or are minima) over shards. Children of boundary nodes look their parent up
   by (shard, node), so the root is no hot key.

Defined results: rows with a NULL conversation belong to none and are left out; a NULL turn comes first, equal turns are
ordered by the MD5 of role and text; a NULL role or text is an empty one; repeated rows are turns of their own; a
conversation may be left without turns and is then a member of the root alone; an empty table has no nodes. One
conversation's turns (20 bytes each) must fit a task, as a document must elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.common import arrow_schema, small_batches, stored

ID = 16  # bytes of a turn's digest
BLOCK = 32
CHUNK_BYTES = 1 << 20
SHARD_BYTES = 32 << 20
EMPTY = hashlib.sha256(b"").hexdigest()


# --- rebuilding ---------------------------------------------------------------------------


def turn_digest(role: Column, text: Column) -> Column:
    """Stands for a turn: role and text with the role's length in front, so that no two pairs read alike."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def rebuild(
    spark: SparkSession,
    turns: DataFrame,
    opening: Column,
    family: int = 5,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Conversations as sequences: ``conv``, ``ids`` (digests one after the other), ``sizes`` (int32), ``key``.

    Conversation c begins with the first ``opening`` turns of c - c % ``family`` and goes on after its own first ones.
    """
    small_batches(spark)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    conv = F.col(conv_col).cast("bigint")
    rows = turns.where(conv.isNotNull()).select(
        conv.alias("conv"),
        (conv - conv % family).alias("block"),
        F.col(turn_col).alias("at"),
        F.unhex(turn_digest(role, text)).alias("id"),
        F.octet_length(text).alias("size"),
        opening.cast("int").alias("opening"),
    )
    dealt = rows.repartition("block").sortWithinPartitions("block", "conv", F.asc_nulls_first("at"), "id").drop("at")
    schema = "conv bigint, ids binary, sizes binary, key binary"
    shape = arrow_schema(schema)

    def run(batches: Iterator) -> Iterator:
        for convs, ids, sizes, openings in _whole_blocks(batches):
            yield from _rebuilt(convs, ids, sizes, openings, family, shape)

    return dealt.select("block", "conv", "id", "size", "opening").mapInArrow(run, schema)


def _whole_blocks(batches: Iterator) -> Iterator[tuple]:
    """Arrays of whole blocks: a block cut by a batch is held until it is complete."""
    held: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        raw = b"".join(batch.column("id").to_pylist())
        part = [batch.column(c).to_numpy() for c in ("conv", "size", "opening")]
        ids = np.frombuffer(raw, f"V{ID}")
        rows = (blocks, part[0], ids, part[1], part[2])
        cut = int(np.searchsorted(blocks, blocks[-1]))  # the last block may go on
        if held and held[0][0][0] != blocks[-1]:
            yield _joined([*held, tuple(x[:cut] for x in rows)])
            held = []
        elif not held and cut:
            yield _joined([tuple(x[:cut] for x in rows)])
        elif held:
            cut = 0
        held.append(tuple(x[cut:] for x in rows))
    if held:
        yield _joined(held)


def _joined(parts: list[tuple]) -> tuple:
    _, convs, ids, sizes, openings = (np.concatenate(x) for x in zip(*parts))
    return convs, ids, sizes.astype(np.int32), openings


def _rebuilt(convs, ids, sizes, openings, family: int, shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    first = np.append(np.flatnonzero(np.diff(convs, prepend=convs[0] - 1)), len(convs))
    at = {c: (a, b) for c, a, b in zip(convs[first[:-1]].tolist(), first[:-1].tolist(), first[1:].tolist())}
    out, size = [], 0
    for c, (a, b) in at.items():
        many = int(openings[a])
        base_a, base_b = at.get(c - int(np.fmod(c, family)), (0, 0))
        lent = slice(base_a, min(base_a + many, base_b))
        own = slice(min(a + many, b), b)
        whole = ids[lent].tobytes() + ids[own].tobytes()
        out.append((c, whole, sizes[lent].tobytes() + sizes[own].tobytes(), hashlib.md5(whole).digest()))
        size += len(whole)
        if size >= CHUNK_BYTES:
            yield _batch(out, shape)
            out, size = [], 0
    if out:
        yield _batch(out, shape)


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)


# --- distinct sequences -------------------------------------------------------------------


def sequences(spark: SparkSession, rebuilt: DataFrame) -> DataFrame:
    """Distinct sequences: ``ids``, ``sizes``, ``key``, ``n`` members, ``least`` of them, ``ends`` (digest of all)."""
    schema = "key binary, least bigint, n bigint, text string"
    shape = arrow_schema(schema)

    def in_runs(batches: Iterator) -> Iterator:
        key, found, size = None, [], 0

        def closed():
            return key, found[0], len(found), ",".join(map(str, found))

        for batch in batches:
            out = []
            for own, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
                if own != key or size >= CHUNK_BYTES:
                    if found:
                        out.append(closed())
                    key, found, size = own, [], 0
                found.append(conv)
                size += 20
            if out:
                yield _batch(out, shape)
        if found:
            yield _batch([closed()], shape)

    members = rebuilt.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    runs = members.mapInArrow(in_runs, schema)
    result = "key binary, least bigint, n bigint, ends string"
    result_shape = arrow_schema(result)

    def in_order(batches: Iterator) -> Iterator:
        key, least, n, digest = None, 0, 0, None
        for batch in batches:
            out = []
            for own, first, many, text in zip(*(batch.column(c).to_pylist() for c in ("key", "least", "n", "text"))):
                if own != key:
                    if key is not None:
                        out.append((key, least, n, digest.hexdigest()))
                    key, least, n, digest = own, first, 0, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.encode())
                n += many
            if out:
                yield _batch(out, result_shape)
        if key is not None:
            yield _batch([(key, least, n, digest.hexdigest())], result_shape)

    counted = runs.repartition("key").sortWithinPartitions("key", "least").mapInArrow(in_order, result)
    one = rebuilt.select(F.col("conv").alias("least"), "ids", "sizes")
    return stored(spark, counted.join(one, "least"), "sequences")


# --- shards -------------------------------------------------------------------------------


def _turn_numbers(ids: np.ndarray) -> np.ndarray:
    """Dense numbers of turns that keep the order of their digests."""
    halves = ids.view(">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    changed = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    number = np.empty(len(order), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(changed)]) if len(order) else 0
    return number


def _padded(turns: np.ndarray, start: np.ndarray, length: np.ndarray, rows: np.ndarray, first: int, width: int) -> np.ndarray:
    """Columns ``first`` .. of some sequences as a matrix; -1 behind a sequence's end."""
    columns = np.arange(first, first + width)
    there = columns < length[rows, None]
    return np.where(there, turns[np.where(there, start[rows, None] + columns, 0)] if len(turns) else -1, -1)


def sort_and_compare(turns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the sequences, and how many first turns each shares with the one before it in that order."""
    start = np.cumsum(length) - length
    order, tied = np.arange(len(length)), np.zeros(len(length), np.int64)  # tied: number of the run of ties
    first = 0
    while True:
        many = np.bincount(tied)[tied]
        active = np.flatnonzero(many > 1)
        if not len(active) or first >= length.max(initial=0):
            break
        rows = order[active]
        width = min(BLOCK, int(length[rows].max()) - first)
        if width <= 0:
            break
        matrix = _padded(turns, start, length, rows, first, width)
        found = np.lexsort((*matrix.T[::-1], tied[active]))
        order[active] = rows[found]
        changed = np.ones(len(order), bool)
        changed[1:] = tied[1:] != tied[:-1]
        changed[active[1:]] |= (matrix[found][1:] != matrix[found][:-1]).any(axis=1) | (np.diff(active) > 1)
        tied = np.cumsum(changed) - 1
        first += width
    shared = np.zeros(len(order), np.int64)
    alike, first = np.arange(1, len(order)), 0  # rows that so far agree with the one before
    while len(alike):
        width = BLOCK
        here = _padded(turns, start, length, order[alike], first, width)
        before = _padded(turns, start, length, order[alike - 1], first, width)
        differs = (here != before) | (here < 0)
        mask = np.logical_or.accumulate(differs, axis=1)
        shared[alike] += (~mask).sum(axis=1)
        alike = alike[~mask[:, -1]]
        first += width
    return order, shared


def shard_nodes(length, shared, weight, least) -> tuple:
    """Nodes of sorted sequences in preorder: row, depth, ``n_convs``, ``conv_id`` and the end of the subtree. The root is
    not among them.

    A depth's nodes start where the mask is set; sequences longer than what they share with either neighbour are nodes of
    their own from there on and need no column.
    """
    rows = len(length)
    fresh = length - shared  # nodes that a sequence starts
    first = np.cumsum(fresh) - fresh
    total = int(fresh.sum())
    row = np.repeat(np.arange(rows), fresh)
    depth = np.arange(total) - first[row] + shared[row] + 1
    n, small = weight[row].copy(), least[row].copy()
    stop = (first + fresh)[row]
    after = np.append(shared[1:], 0)
    together = np.maximum(shared, after)  # turns shared with a neighbour
    active = np.flatnonzero(together > 0)
    d = 1
    while len(active):
        # Rows that share a node of this depth with a neighbour, the mask of its starts, and its aggregates.
        starts = np.flatnonzero(shared[active] < d)
        at = active[starts]
        node = first[at] + (d - 1 - shared[at])
        n[node] = np.add.reduceat(weight[active], starts)
        small[node] = np.minimum.reduceat(least[active], starts)
        last = active[np.append(starts[1:], len(active)) - 1]
        stop[node] = first[last] + fresh[last]
        d += 1
        active = active[together[active] >= d]
    return row, depth, n, small, stop


def _common(a: bytes, b: bytes) -> int:
    """First turns that two sequences share."""
    many = min(len(a), len(b)) // ID
    x, y = (np.frombuffer(s[: many * ID], np.uint8).reshape(-1, ID) for s in (a, b))
    differs = np.flatnonzero((x != y).any(axis=1))
    return int(differs[0]) if len(differs) else many


PACKED = "shard bigint, head binary, tail binary, ids binary, length binary, shared binary, sizes binary, weight binary, least binary, ends array<string>"


def _shards(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """Sorted shards, one stored row each, so that no reader can split or join them."""
    shape = arrow_schema(PACKED)
    size = distinct.agg(F.coalesce(F.sum(F.octet_length("ids") + 100), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES + 1)
    # Ranges of whole sequences: no opening, however common or long, is bound to one shard.
    ranged = distinct.repartitionByRange(parts, "ids")
    marked = ranged.withColumn("shard", F.spark_partition_id().cast("bigint"))

    def pack(batches: Iterator) -> Iterator:
        columns: dict[str, list] = {c: [] for c in ("shard", "ids", "sizes", "n", "least", "ends")}
        for batch in batches:
            for c, values in columns.items():
                values += batch.column(c).to_pylist()
        if not columns["ids"]:
            return
        length = np.array([len(x) // ID for x in columns["ids"]], np.int64)
        ids = np.frombuffer(b"".join(columns["ids"]), np.uint8)
        order, shared = sort_and_compare(_turn_numbers(ids), length)
        pick = lambda c: [columns[c][i] for i in order.tolist()]
        found = pick("ids")
        yield _batch(
            [
                (
                    columns["shard"][0],
                    found[0],
                    found[-1],
                    b"".join(found),
                    length[order].tobytes(),
                    shared.tobytes(),
                    b"".join(pick("sizes")),
                    np.array(pick("n"), np.int64).tobytes(),
                    np.array(pick("least"), np.int64).tobytes(),
                    pick("ends"),
                )
            ],
            shape,
        )

    return stored(spark, marked.select("shard", "ids", "sizes", "n", "least", "ends").mapInArrow(pack, PACKED), "shards")


NODES = (
    "shard bigint, node binary, parent_node binary, edge boolean, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def _nodes_of(shard: dict, shape: pa.Schema) -> pa.RecordBatch:
    """All nodes of a shard; aggregates of boundary nodes (``edge``) are this shard's part."""
    length, shared, weight, least = (np.frombuffer(shard[c], np.int64) for c in ("length", "shared", "weight", "least"))
    sizes = np.frombuffer(shard["sizes"], np.int32).astype(np.int64)
    before, after = shard["before"], shard["after"]
    known = 0 if before is None else _common(before, shard["head"])  # of the first path, held by the shard before
    goes_on = 0 if after is None else _common(shard["tail"], after)  # of the last path, held by the next shard
    row, depth, n, small, stop = shard_nodes(length, shared, weight, least)
    total = len(row)
    start = np.cumsum(length) - length
    size = sizes[start[row] + depth - 1] if total else sizes[:0]
    owned = np.ones(total, bool)
    owned[: min(known, int(length[0]))] = False
    # A node without children here: the next in preorder is not deeper. The last sequence may go on in the next shard.
    leaf = np.append(depth[1:] <= depth[:-1], True) if total else np.zeros(0, bool)
    if total and after is not None and goes_on == length[-1]:
        leaf[-1] = False
    leaf &= owned
    running = lambda values: np.concatenate([[0], np.cumsum(values)])
    own = np.arange(total)
    saved_upto, leaves_upto = running(n * size - owned * size), running(leaf)
    saved, leaves = saved_upto[stop] - saved_upto[own], leaves_upto[stop] - leaves_upto[own]
    # Parents: the node before in the same sequence, else the ancestor that the row before passes at that depth.
    first = np.searchsorted(row, np.arange(len(length)))
    path: list[int] = []  # nodes of the current sequence by depth
    parent = np.where(depth > 1, own - 1, -1)
    on_tail = np.zeros(total, bool)
    for r, d in zip(range(len(length)), shared.tolist()):
        del path[d:]
        a = int(first[r])
        b = a + int(length[r]) - d
        if d and b > a:
            parent[a] = path[d - 1]
        path.extend(range(a, b))
    on_tail[path[:goes_on]] = True
    edge = ~owned | on_tail
    children = np.bincount(parent[owned & (parent >= 0)], minlength=total)[:total] if total else own
    ends = np.full(total, None, object)
    whole = depth == length[row]
    ends[whole] = np.array(shard["ends"], object)[row[whole]]
    # Names of boundary nodes: the digest of the turns that lead there.
    names: dict[int, bytes] = {-1: b""}
    for which, many, nodes in (("head", known, range(total)), ("tail", goes_on, path)):
        digest = hashlib.md5()
        for i, at in zip(range(many), nodes):
            digest.update(shard[which][i * ID : (i + 1) * ID])
            names.setdefault(at, digest.digest())
    none = int(length[0]) == 0  # a sequence without turns ends at the root
    root = (
        b"", None, True, int(least.min()), 0, None, int(weight.sum()), int((owned & (depth == 1)).sum()),
        int(leaf.sum()) + int(none and len(length) == 1 and after is None), int(saved_upto[-1]), shard["ends"][0] if none else None,
    )
    parent_edge = np.where(parent < 0, True, edge[parent]) if total else edge
    nodes = [names[i] if e else None for i, e in enumerate(edge.tolist())]
    parent_nodes = [names[p] if e else None for p, e in zip(parent.tolist(), parent_edge.tolist())]
    parent_ids = [None if e else int(small[p]) for p, e in zip(parent.tolist(), parent_edge.tolist())]
    # Another shard may hold the sequence that ends at a boundary node.
    done = [x if e else x or EMPTY for x, e in zip(ends.tolist(), edge.tolist())]
    columns = [nodes, parent_nodes, edge, small, depth, parent_ids, n, children, leaves, saved, done]
    values = [[shard["shard"]] * (total + 1), *([r, *c] for r, c in zip(root, columns))]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, shape)], schema=shape)


def prefix_nodes(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    shards = _shards(spark, distinct)
    # One row a shard: as few as the shuffle has partitions.
    line = Window.orderBy("shard")
    near = shards.select("shard", F.lag("tail").over(line).alias("before"), F.lead("head").over(line).alias("after"))
    shape = arrow_schema(NODES)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for shard in batch.to_pylist():
                yield _nodes_of(shard, shape)

    parts = stored(spark, shards.join(near, "shard").mapInArrow(run, NODES), "nodes")
    edges = parts.where("edge")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    met = edges.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.max("parent_node").alias("parent_node"),
        *sums,
        F.coalesce(F.max("ends_sha256"), F.lit(EMPTY)).alias("ends_sha256"),
    )
    met = stored(spark, met, "boundary_nodes")
    # What a shard's nodes have to know of their parents, by shard.
    parents = edges.select("shard", "node").join(met.select("node", F.col("conv_id").alias("parent_id")), "node")
    inner = (
        parts.where("NOT edge")
        .join(parents.withColumnRenamed("node", "parent_node"), ["shard", "parent_node"], "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_id"))
    )
    above = met.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    outer = met.join(above, "parent_node", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(columns).unionByName(outer.select(columns))
