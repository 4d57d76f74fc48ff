"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into pre-tokens in blocks of about ``block_words``. A block keeps its distinct words once, and for each
document the positions as numbers of those words (most frequent first, as base-128 digits). Words are dealt by hash to
shares, and a block's words of a share travel together, sorted and compressed: so one row a block and share is
shuffled, not one a word, and a word costs as much however often it occurs. A share encodes each distinct word once for
all blocks; the ids go back in the words' order, which the block knows, and a block puts the ids of its documents
together by position. Blocks are stored in buckets by their number: only words and ids move, never the positions. The
number of shares and buckets follows the bytes of text. Decoding looks every id up in the token-byte table, which the
vocabulary bounds.

Defined results: a NULL text is an empty one (no ids, no bytes); repeated rows are encoded each; an empty table gives
no rows. Text is UTF-8 and the ranks hold all 256 bytes, so every text can be encoded and decoding restores its bytes.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import arrow_type, rows_of, small_batches
from tripflow.session import scratch_path

BLOCK_WORDS = 2_500_000
# Bytes of text for each share of the words and bucket of the blocks, and how many there are at most.
SHARE_BYTES, MAX_SHARES = 16 << 20, 100_000
PIECE = 1_000_000
BATCH_TOKENS = 2_000_000


class Vocabulary:
    """Ranks and pre-token pattern, read by the driver and sent to the executors; bounded by the vocabulary's size."""

    def __init__(self, path: str, pattern: str):
        self.pattern = pattern
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}

    @property
    def tokens(self) -> list[bytes]:
        """Bytes by id; ids without a token have none."""
        out = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


@cache
def _shared(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast(Vocabulary(path, pattern))


# --- positions as base-128 digits -------------------------------------------------------


def pack(numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers below 2^35 as base-128 digits, low first, and where each ends.

    All but the last digit of a number carry the high bit. Worked on in pieces, to stay small beside the result.
    """
    parts, all_ends, before = [], [np.zeros(0, np.int64)], 0
    for i in range(0, len(numbers), PIECE):
        part = numbers[i : i + PIECE].astype(np.int64)
        sizes = 1 + sum((part >= 1 << s).astype(np.int64) for s in (7, 14, 21, 28))
        ends = np.cumsum(sizes)
        out = np.zeros(int(ends[-1]), np.uint8)
        for k in range(int(sizes.max())):
            rows = np.flatnonzero(sizes > k)
            more = (sizes[rows] > k + 1).astype(np.int64) << 7
            out[ends[rows] - sizes[rows] + k] = (part[rows] >> (7 * k)) & 127 | more
        parts.append(out.tobytes())
        all_ends.append(ends + before)
        before += int(ends[-1])
    return b"".join(parts), np.concatenate(all_ends)


def unpack(packed: bytes) -> np.ndarray:
    digits = np.frombuffer(packed, np.uint8)
    parts, first = [np.zeros(0, np.int64)], 0
    while first < len(digits):
        end = min(first + PIECE, len(digits))
        while digits[end - 1] >= 128:  # finish the number
            end += 1
        part = digits[first:end]
        last = np.flatnonzero(part < 128)
        start = np.concatenate([[0], last[:-1] + 1])
        out = np.zeros(len(last), np.int64)
        for k in range(int((last - start).max()) + 1):
            rows = np.flatnonzero(last - start >= k)
            out[rows] |= (part[start[rows] + k].astype(np.int64) & 127) << (7 * k)
        parts.append(out.astype(np.int32) if len(out) and out.max() < 2**31 else out)
        first = end
    return np.concatenate(parts[1:] or parts)


# --- words of a share ---------------------------------------------------------------------


def pack_words(words: list[str]) -> bytes:
    """Words one after the other with their lengths, compressed."""
    lengths, _ = pack(np.fromiter(map(len, words), np.int64, len(words)))
    return zstandard.compress(len(lengths).to_bytes(4, "little") + lengths + "".join(words).encode(), 6)


def unpack_words(packed: bytes) -> list[str]:
    whole = zstandard.decompress(packed)
    size = 4 + int.from_bytes(whole[:4], "little")
    text = whole[size:].decode()
    ends = np.cumsum(unpack(whole[4:size])).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _shares(words: list[str], shares: int) -> tuple[np.ndarray, list[bytes | None]]:
    """Places of the words in the order of (share, word), and each share's words packed; NULL if it has none."""
    share = np.fromiter((zlib.crc32(w.encode()) % shares for w in words), np.int64, len(words))
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = by_word[np.argsort(share[by_word], kind="stable")] if len(words) else by_word
    ends = np.cumsum(np.bincount(share, minlength=shares)).tolist()
    return order, [pack_words([words[i] for i in order[a:b].tolist()]) if b > a else None for a, b in zip([0, *ends], ends)]


# --- encoding -----------------------------------------------------------------------------


def _blocks(rows: Iterable[tuple], find, block_words: int, shares: int) -> Iterator[tuple]:
    def closed():
        flat = np.concatenate(words) if words else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(flat, minlength=len(number)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        names = list(number)
        number.clear()
        places, packed = _shares([names[i] for i in order], shares)
        return ids, np.cumsum([0, *map(len, words)]).astype(np.int64), pack(rank[flat])[0], pack(places)[0], packed

    ids, words, size, number = [], [], 0, defaultdict(count().__next__)
    for doc, text in rows:
        found = find(text) if text else []
        ids.append(doc)
        words.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        size += len(found)
        if size >= block_words or len(ids) >= block_words // 20:
            yield closed()
            ids, words, size, number = [], [], 0, defaultdict(count().__next__)
    if ids:
        yield closed()


def encode(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    share_bytes: int = SHARE_BYTES,
) -> DataFrame:
    """``_id`` and ``ids`` (array of token ids) of every row."""
    small_batches(spark)
    shared = _shared(spark, vocabulary_path, pattern)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = arrow_type(rows, "_id")
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shares = min(MAX_SHARES, size // share_bytes + 1)

    def cut(batches):
        find = regex.compile(shared.value.pattern).findall
        for ids, bounds, codes, places, packed in _blocks(rows_of(batches, "_id", "_text"), find, block_words, shares):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().int >> 65], pa.int64()),
                    pa.array([ids], pa.list_(id_type)),
                    pa.array([bounds.tobytes()], pa.binary()),
                    pa.array([codes], pa.binary()),
                    pa.array([places], pa.binary()),
                    pa.array([packed], pa.list_(pa.binary())),
                ],
                names=["block", "doc_ids", "bounds", "codes", "places", "words"],
            )

    schema = f"block bigint, doc_ids array<{kind}>, bounds binary, codes binary, places binary, words array<binary>"
    blocks = _in_buckets(spark, rows.mapInArrow(cut, schema), shares)

    def encode_words(batches):
        vocabulary = shared.value
        encoding = tiktoken.Encoding(
            "ranks", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}
        )
        width = np.uint16 if len(vocabulary.ranks) <= 1 << 16 else np.uint32
        yield from _encoded(batches, encoding._encode_single_piece, width)

    used = blocks.select("block", F.posexplode("words").alias("share", "words")).where("words IS NOT NULL")
    parts = used.repartitionByRange(shares, "share").sortWithinPartitions("share")
    parts = parts.mapInArrow(encode_words, "block bigint, share int, sizes binary, ids binary, wide boolean")
    named = parts.repartition(shares, "block").groupBy("block")
    named = named.agg(F.collect_list(F.struct("share", "sizes", "ids", "wide")).alias("named"))
    # Blocks without any word keep their documents.
    whole = blocks.select("block", "doc_ids", "bounds", "codes", "places").join(named, "block", "left")

    def assemble(batches):
        for doc_ids, bounds, codes, named in _whole_blocks(batches):
            yield from _assembled(doc_ids, bounds, codes, named, id_type)

    return whole.mapInArrow(assemble, f"_id {kind}, ids array<int>")


def _in_buckets(spark: SparkSession, blocks: DataFrame, buckets: int) -> DataFrame:
    """Blocks stored in the shared folder, bucketed by their number, so that joining on it does not move them.

    Buckets need a table; its name leaves the catalog at once, the files stay.
    """
    name = f"pre_tokens_{uuid.uuid4().hex}"
    writer = blocks.write.option("compression", "zstd").option("path", scratch_path(spark, "pre-tokens"))
    writer.bucketBy(buckets, "block").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _encoded(batches: Iterable, piece, width) -> Iterator[pa.RecordBatch]:
    """Sizes and ids of each block's words of a share, in their order; each distinct word of a share is encoded once."""
    share, known = None, {}

    def new(word: str) -> list[int]:
        known[word] = found = piece(word)
        return found

    for batch in batches:
        columns = []
        for block, own, packed in zip(*(batch.column(c) for c in ("block", "share", "words"))):
            if own.as_py() != share:
                share, known = own.as_py(), {}
            found = [known.get(word) or new(word) for word in unpack_words(packed.as_py())]
            sizes, _ = pack(np.fromiter(map(len, found), np.int64, len(found)))
            ids = np.fromiter(chain.from_iterable(found), width)
            columns.append((block.as_py(), share, sizes, zstandard.compress(ids.tobytes()), width is np.uint32))
        if columns:
            names = ["block", "share", "sizes", "ids", "wide"]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns), types)], names=names)


def _spread(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every run, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(start - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _whole_blocks(batches: Iterable) -> Iterator[tuple]:
    """Blocks with the ids of their words: the words' numbers, how many ids each has, and all ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            parts = sorted(batch.column("named")[i].as_py() or [], key=lambda part: part["share"])
            sizes = np.concatenate([np.zeros(0, np.int64), *(unpack(part["sizes"]) for part in parts)])
            wide = [np.uint32 if part["wide"] else np.uint16 for part in parts]
            flat = [np.frombuffer(zstandard.decompress(part["ids"]), w) for part, w in zip(parts, wide)]
            flat = np.concatenate([np.zeros(0, np.int32), *flat]).astype(np.int32)
            bounds = np.frombuffer(batch.column("bounds")[i].as_py(), np.int64)
            codes, numbers = batch.column("codes")[i].as_py(), unpack(batch.column("places")[i].as_py())
            yield batch.column("doc_ids")[i].values, bounds, codes, (numbers, sizes, flat)


def _assembled(doc_ids: pa.Array, bounds: np.ndarray, codes: bytes, named: tuple, id_type) -> Iterator[pa.RecordBatch]:
    numbers, sizes, flat = named
    start = np.zeros(len(numbers), np.int64)
    length = np.zeros(len(numbers), np.int64)
    start[numbers], length[numbers] = np.cumsum(sizes) - sizes, sizes
    words = unpack(codes)
    first = 0
    while first < len(doc_ids):
        # As many documents as stay within the batch, one at least.
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BATCH_TOKENS, "right")) - 1)
        last = min(last, len(doc_ids))
        part = words[bounds[first] : bounds[last]]
        many = length[part]
        ends = np.concatenate([[0], np.cumsum(many)])
        picked = _spread(start[part], many)
        offsets = ends[bounds[first : last + 1] - bounds[first]]
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat[picked], pa.int32()))
        yield pa.RecordBatch.from_arrays([doc_ids.slice(first, last - first).cast(id_type), ids], names=["_id", "ids"])
        first = last


# --- decoding -----------------------------------------------------------------------------


def decode(
    spark: SparkSession, encoded: DataFrame, vocabulary_path: str, pattern: str, ids_col: str = "ids"
) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids; NULL ids have NULL bytes, an unknown id fails."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    shared = _shared(spark, vocabulary_path, pattern)

    def run(batches):
        tokens = shared.value.tokens
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids = batch.column(ids_col)[i].values
                out.append(None if ids is None else b"".join(map(tokens.__getitem__, ids.to_numpy().tolist())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema, StructField("decoded", BinaryType())]))


def digests(spark: SparkSession, docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, token count, SHA-256 of the ids as decimal text and of the decoded bytes."""
    both = decode(spark, encode(spark, docs, vocabulary_path, pattern, id_col, text_col), vocabulary_path, pattern)
    return both.select(
        F.col("_id").alias(id_col),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
