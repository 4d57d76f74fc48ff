"""Benchmark decontamination over a distributed positional inverted index.

The index is sharded by documents: each stored row is a block of whole documents of about ``block_words`` words with
its dictionary (``terms``), the sorted positions of every term (``positions``, cut by ``ends``), and the first word of
each document (``starts``). Building it shuffles nothing, and a search is one pass over the blocks: within a block a
phrase takes the posting list of its rarest term, shifts it by the term's offset in the phrase and intersects it with
the other terms' lists, rarest first. The terms are stored as they are, so a match is exact.

Proximity takes the same lists: from the rarest term's postings on, it asks of each term whether one lies near enough.

Test texts reach the executors in packs of bounded size (``pack_words``). A larger test set takes more passes, one after
the other: a pass's hits are stored and its broadcast is released before the next pack is made, and an item longer than
a pack is cut into overlapping parts. Defined results: a NULL text has no words; a repeated document row is judged as a
row of its own; an item without words, or an empty benchmark, matches nothing; equal phrases of several items are
searched once and count for each; rows of a benchmark that repeat an item id are one item, as are those whose id is
NULL, which are counted but have no id to show in a digest of ids.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import WORD_BYTES, arrow_schema, arrow_type, batch_of, row_key, rows_of, select_rows, small_batches, stored

WINDOW = 13
NEAR_SPAN = 20
BLOCK_WORDS = 1_000_000
PACK_WORDS = 1_000_000


# --- index ----------------------------------------------------------------------------


def build_index(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Index every word of every text; the stored table is returned."""
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("_id"), row_key(F.col(text_col)).alias("_key"), F.col(text_col).cast("binary").alias("_text")
    )
    schema = (
        f"block string, ids array<{kind}>, keys array<bigint>, starts binary, "
        "terms array<binary>, ends binary, positions binary"
    )
    id_type = pa.list_(arrow_type(rows, "_id"))

    def blocks(batches):
        for ids, keys, words, terms in _documents_in_blocks(rows_of(batches, "_id", "_key", "_text"), block_words):
            flat = np.concatenate(words) if words else np.zeros(0, np.int32)
            counts = np.bincount(flat, minlength=len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([ids], id_type),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([np.cumsum([0, *map(len, words)]).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([terms], pa.list_(pa.binary())),
                    pa.array([np.cumsum(counts).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.argsort(flat, kind="stable").astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["block", "ids", "keys", "starts", "terms", "ends", "positions"],
            )

    return stored(spark, rows.mapInArrow(blocks, schema), "postings")


def _documents_in_blocks(rows: Iterable[tuple], block_words: int) -> Iterator[tuple]:
    ids, keys, words, size, terms = [], [], [], 0, defaultdict(count().__next__)
    for doc, key, text in rows:
        found = WORD_BYTES.findall(text.lower()) if text else []
        ids.append(doc)
        keys.append(key)
        words.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
        size += len(found)
        if size >= block_words or len(ids) >= block_words // 20:
            yield ids, keys, words, list(terms)
            ids, keys, words, size, terms = [], [], [], 0, defaultdict(count().__next__)
    if ids:
        yield ids, keys, words, list(terms)


class _Block:
    """One stored block, opened."""

    def __init__(self, row: tuple):
        self.block, self.ids, self.keys, starts, terms, ends, positions = row
        self.starts = np.frombuffer(starts, np.int32)
        self.ends = np.frombuffer(ends, np.int32)
        self.positions = np.frombuffer(positions, np.int32)
        self.number = {t: i for i, t in enumerate(terms)}

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """Occurrences of terms by their number; -1 is a term the block lacks."""
        sizes = np.diff(self.ends, prepend=0)
        return np.where(numbers >= 0, sizes[numbers] if len(sizes) else 0, 0)

    def postings(self, number: int) -> np.ndarray:
        return self.positions[self.ends[number - 1] if number else 0 : self.ends[number]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


_COLUMNS = ("block", "ids", "keys", "starts", "terms", "ends", "positions")


# --- test texts -----------------------------------------------------------------------


class _Pack:
    """A bounded part of the test texts: distinct phrases by length, as numbers of distinct terms."""

    def __init__(self, items: list[tuple], window: int | None):
        number: dict[bytes, int] = defaultdict(count().__next__)
        phrases: dict[tuple[int, ...], set] = defaultdict(set)
        self.items = list(dict.fromkeys(item for item, _ in items))
        at = {item: i for i, item in enumerate(self.items)}
        for item, words in items:
            ids = [number[w] for w in words]
            size = len(ids) if window is None else min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                phrases[tuple(ids[i : i + size])].add(at[item])
        self.terms = list(number)
        by_size: dict[int, list] = defaultdict(list)
        for phrase, owners in phrases.items():
            by_size[len(phrase)].append((phrase, sorted(owners)))
        self.phrases = {
            size: (np.array([p for p, _ in found], np.int32), [o for _, o in found]) for size, found in by_size.items()
        }


def _packs(items: DataFrame, id_col: str, text_col: str, window: int | None, pack_words: int) -> Iterator[_Pack]:
    """Test texts in packs; the driver holds one pack at a time."""
    held, size, any_pack = [], 0, False
    for item, text in items.select(id_col, F.col(text_col).cast("binary")).toLocalIterator():
        words = WORD_BYTES.findall(bytes(text).lower()) if text is not None else []
        # Parts of a long item share the words of the windows between them; a whole phrase cannot be cut.
        first = range(0, max(1, len(words) - window + 1), pack_words) if window else (0,)
        for i in first:
            part = words[i : i + pack_words + window - 1] if window else words
            held.append((item, part))
            size += len(part)
            if size >= pack_words:
                yield _Pack(held, window)
                held, size, any_pack = [], 0, True
    if held or not any_pack:
        yield _Pack(held, window)


def _starts_of(block: _Block, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where a phrase begins in the block: offset-adjusted intersection from the rarest term on."""
    order = np.argsort(counts, kind="stable")
    first = order[0]
    starts = block.postings(numbers[first]) - first
    starts = starts[starts >= 0]
    for j in order[1:]:
        if not len(starts):
            return starts
        there = block.postings(numbers[j])
        found = np.searchsorted(there, starts + j)
        starts = starts[there[np.minimum(found, len(there) - 1)] == starts + j]
    inside = starts + len(numbers) <= block.starts[block.document(starts) + 1]
    return starts[inside]


def _matches(block: _Block, pack: _Pack) -> Iterator[tuple[np.ndarray, int, list[int]]]:
    numbers = np.fromiter((block.number.get(t, -1) for t in pack.terms), np.int32, len(pack.terms))
    counts = block.count(numbers)
    for size, (phrases, owners) in pack.phrases.items():
        held = counts[phrases]
        for i in np.flatnonzero(held.min(axis=1) > 0):
            starts = _starts_of(block, numbers[phrases[i]], held[i])
            if len(starts):
                yield starts, size, owners[i]


# --- searches -------------------------------------------------------------------------


def find_phrases(
    spark: SparkSession,
    index: DataFrame,
    items: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    window: int | None = None,
    pack_words: int = PACK_WORDS,
) -> DataFrame:
    """Exact phrase matches: ``doc_id``, ``start`` (word), ``n_words``, ``items`` (array of item ids).

    A phrase is a whole item, or with ``window`` each run of that many of its words.
    """
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {doc_kind}, start bigint, n_words int, items array<{item_kind}>"

    shape = arrow_schema(schema)

    def search(shared):
        def run(batches):
            pack = shared.value
            for row in rows_of(batches, *_COLUMNS):
                block, found = _Block(row), []
                for starts, size, owners in _matches(block, pack):
                    names = [pack.items[o] for o in owners]
                    for s, d in zip(starts.tolist(), block.document(starts).tolist()):
                        found.append((block.ids[d], s - int(block.starts[d]), size, names))
                yield batch_of(found, shape)

        return run

    packs = _packs(items, item_col, text_col, window, pack_words)
    return reduce(DataFrame.union, _in_passes(spark, index, lambda shared, _: search(shared), schema, packs))


def find_near(
    spark: SparkSession,
    index: DataFrame,
    items: DataFrame,
    span: int,
    item_col: str = "item_id",
    text_col: str = "text",
    pack_words: int = PACK_WORDS,
) -> DataFrame:
    """Exact proximity matches: all distinct words of an item, in any order, within ``span`` words of one document.

    One row (``doc_id``, ``item_id``, ``start``, ``end``) for each occurrence of the item's rarest word (in the block)
    that lies in such a place; the place is the shortest, then the leftmost.
    """
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, start bigint, end bigint"

    shape = arrow_schema(schema)

    def search(shared):
        def run(batches):
            pack = shared.value
            for row in rows_of(batches, *_COLUMNS):
                block, found = _Block(row), []
                numbers = np.fromiter((block.number.get(t, -1) for t in pack.terms), np.int32, len(pack.terms))
                for phrases, owners in pack.phrases.values():
                    for phrase, own in zip(phrases, owners):
                        terms = numbers[np.unique(phrase)]
                        if terms.min() < 0 or len(terms) > span:
                            continue
                        for d, a, b in _near(block, terms, span):
                            found += [(block.ids[d], pack.items[o], a, b) for o in own]
                yield batch_of(found, shape)

        return run

    packs = _packs(items, item_col, text_col, None, pack_words)
    return reduce(DataFrame.union, _in_passes(spark, index, lambda shared, _: search(shared), schema, packs))


def _near(block: _Block, terms: np.ndarray, span: int) -> Iterator[tuple[int, int, int]]:
    lists = sorted((block.postings(t) for t in terms), key=len)
    at = lists[0]
    low = np.maximum(at - span + 1, block.starts[block.document(at)])
    high = np.minimum(at + span - 1, block.starts[block.document(at) + 1] - 1)
    keep = np.ones(len(at), bool)
    for there in lists[1:]:
        keep &= np.searchsorted(there, high, "right") > np.searchsorted(there, low)
    for p, a, b in zip(at[keep].tolist(), low[keep].tolist(), high[keep].tolist()):
        events = sorted(
            [(p, 0)]
            + [
                (q, k)
                for k, there in enumerate(lists[1:], 1)
                for q in there[np.searchsorted(there, a) : np.searchsorted(there, b, "right")].tolist()
            ]
        )
        best, latest = None, {}
        for q, k in events:
            latest[k] = q
            left = min(latest.values())
            if len(latest) == len(lists) and q - left < span:
                best = min(best, (q - left + 1, left)) if best else (q - left + 1, left)
        if best:
            d = int(block.document(np.array([p]))[0])
            first = int(block.starts[d])
            yield d, best[1] - first, best[1] - first + best[0]


def _close(at: np.ndarray, there: np.ndarray, span: int) -> np.ndarray:
    """Positions that have one of the others less than ``span`` words away."""
    found = np.searchsorted(there, at - span + 1)
    return at[(found < len(there)) & (there[np.minimum(found, len(there) - 1)] < at + span)]


def _near_documents(block: _Block, rarest: int, at: np.ndarray, others: np.ndarray, span: int) -> np.ndarray:
    """Documents of the block in which all terms lie within ``span`` words; ``at`` are places of the rarest to look at."""
    lists = [block.postings(rarest), *sorted((block.postings(t) for t in others), key=len)]
    for there in lists[1:]:
        at = _close(at, there, span)
        if not len(at):
            return at
    # Such a place starts at one of the terms, at most a span before the rarest: the others must follow in time.
    starts = [at]
    for there in lists[1:]:
        first, many = np.searchsorted(there, at - span + 1), np.searchsorted(there, at)
        many -= first
        ends = np.cumsum(many)
        starts.append(there[np.repeat(first - ends + many, many) + np.arange(ends[-1])])
    starts = np.unique(np.concatenate(starts))
    last = np.minimum(starts + span, block.starts[block.document(starts) + 1])
    for there in lists:
        found = np.searchsorted(there, starts)
        fits = (found < len(there)) & (there[np.minimum(found, len(there) - 1)] < last)
        starts, last = starts[fits], last[fits]
    return np.unique(block.document(starts))


def _near_items(block: _Block, pack: _Pack, span: int) -> dict[int, set]:
    """Items by document whose phrase's words lie within ``span`` words.

    The windows of an item share most words, so the two rarest are looked up once for all that have them.
    """
    numbers = np.fromiter((block.number.get(t, -1) for t in pack.terms), np.int32, len(pack.terms))
    counts = block.count(numbers)
    out, pairs = defaultdict(set), {}  # items by document; positions of a word that have another near them
    for phrases, owners in pack.phrases.values():
        there = numbers[phrases]
        rows = np.flatnonzero(there.min(axis=1) >= 0)
        if not len(rows):
            continue
        order = np.argsort(counts[phrases[rows]], axis=1, kind="stable")
        rarest, second = (there[rows, order[:, min(k, order.shape[1] - 1)]].tolist() for k in (0, 1))
        for i, a, b in zip(rows.tolist(), rarest, second):
            at = pairs.get((a, b))
            if at is None:
                at = pairs[a, b] = _close(block.postings(a), block.postings(b), span)
            # What an earlier window has found of a document need not be found again.
            if len(at):
                at = at[[not out[d].issuperset(owners[i]) for d in block.document(at).tolist()]]
            if len(at):
                terms = np.unique(there[i])
                if len(terms) <= span:
                    for d in _near_documents(block, a, at, terms[terms != a], span).tolist():
                        out[d].update(owners[i])
    return {d: found for d, found in out.items() if found}


def contamination(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    pack_words: int = PACK_WORDS,
    near_span: int | None = None,
) -> DataFrame:
    """Per document row: ``_id``, ``_key``, ``n_words``, hit ``spans`` (words), ``items`` whose windows occur.

    With ``near_span`` also ``near``, the items of which all words of a window lie within that many words, in any order.
    """
    index = build_index(spark, docs, id_col, text_col, block_words)
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = (
        f"block string, row int, _id {doc_kind}, _key bigint, n_words bigint, "
        f"spans array<struct<a:bigint,b:bigint>>, items array<{item_kind}>, near array<{item_kind}>"
    )

    shape = arrow_schema(schema)

    def search(shared, first):
        def run(batches):
            pack = shared.value
            for row in rows_of(batches, *_COLUMNS):
                block = _Block(row)
                edges = np.zeros(int(block.starts[-1]) + 1, np.int64)
                items = defaultdict(set)
                for starts, size, owners in _matches(block, pack):
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + size, -1)
                    for d in np.unique(block.document(starts)).tolist():
                        items[d].update(owners)
                spans = _spans(block, edges)
                near = _near_items(block, pack, near_span) if near_span else {}
                named = lambda found, d, pack=pack: [pack.items[o] for o in sorted(found.get(d, ()))]
                yield batch_of(
                    [
                        (block.block, d, block.ids[d], block.keys[d], int(n), spans.get(d, []), named(items, d), named(near, d))
                        for d, n in enumerate(np.diff(block.starts))
                        # The first pass names every document, the others add what they find.
                        if first or d in items or d in near
                    ],
                    shape,
                )

        return run

    packs = _packs(benchmark, item_col, item_text_col, window, pack_words)
    passes = _in_passes(spark, index, search, schema, packs)
    out = ["_id", "_key", "n_words", "spans", "items", *(["near"] if near_span else [])]
    if len(passes) == 1:
        return passes[0].select(out)
    whole = reduce(DataFrame.union, passes).groupBy("block", "row").agg(
        *(F.first(c).alias(c) for c in ("_id", "_key", "n_words")),
        F.flatten(F.collect_list("spans")).alias("spans"),
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")),
    )
    return whole.select(out)


def _in_passes(spark: SparkSession, index: DataFrame, search, schema: str, packs: Iterable[_Pack]) -> list[DataFrame]:
    """What ``search(broadcast pack, whether it is the first)`` finds in the index, pack by pack; the driver and the
    executors hold one pack at a time."""
    passes = []
    for pack in packs:
        shared = spark.sparkContext.broadcast(pack)
        passes.append(stored(spark, index.mapInArrow(search(shared, not passes), schema), "hits"))
        shared.destroy()
    return passes


def _spans(block: _Block, edges: np.ndarray) -> dict[int, list[dict]]:
    """Runs of hit words by document; a run ends with its document."""
    hit = np.concatenate([[0], np.cumsum(edges[:-1]) > 0, [0]]).astype(np.int8)
    if not hit.any():
        return {}
    cut = np.diff(hit)
    out = defaultdict(list)
    for a, b in zip(np.flatnonzero(cut == 1).tolist(), np.flatnonzero(cut == -1).tolist()):
        while a < b:
            d = int(block.document(np.array([a]))[0])
            first, last = int(block.starts[d]), min(b, int(block.starts[d + 1]))
            out[d].append({"a": a - first, "b": last - first})
            a = last
    return out


def covered(spans: Column) -> Column:
    """Words in at least one of the spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    step = lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"),
        F.greatest(s["end"], x["b"]).alias("end"),
    )
    return F.aggregate(F.sort_array(spans), start, step, lambda s: s["n"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """The rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Documents without those that the rule calls contaminated; columns as they were."""
    found = contamination(spark, docs, benchmark, id_col, text_col, **options)
    bad = found.where(is_contaminated(covered(F.col("spans")), F.col("n_words"))).select("_id", "_key").distinct()
    return select_rows(docs, stored(spark, bad, "contaminated"), id_col, text_col, "left_anti")
