"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

The encoding of a prefix ends with exactly one token t, and what stands before t is again the encoding of a shorter prefix:
of all tokens that end at a place, it is the one that the merges leave apart from the last token before it. So one pass
over a pre-token, with an automaton that names the tokens ending at each place, gives the count of each of its prefixes
from a shorter one's, without encoding any of them. Whether two tokens stay apart is asked of the library once a pair.

A text is cut into units: white space and the pre-token behind it. Inside a unit the counts are those of the prefix as a
text of its own, whose last pre-token may be cut otherwise than the whole text's: white space at the end is one pre-token,
the last blank joins the next word only once that has begun, and an apostrophe takes a letter only with the ending
complete. At the end of a unit prefix and text agree again, so the steps (what each character adds) of equal units are
equal; they are kept for the units met last. Special strings are one token when complete and plain text before.

The stored ``counts`` has the tokens of the first n characters at place n (from 0); ``longest_prefix`` and ``tokens_at``
answer truncation and budget questions from it. A prefix may have more tokens than a longer one, so the answer is
looked up and not searched by halves.

Defined results: a NULL text is an empty one, of 0 bytes and tokens; repeated rows are counted each; an empty table has no
rows. A text is held by one task with four bytes a character beside it.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripflow.llm.common import arrow_type, rows_of, small_batches

# Fixed value: contracted endings that are pre-tokens of their own.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# The commonest form first: no two alternatives begin alike, so their order is free, but for the last of the inner ones.
UNIT = regex.compile(rf" ?\p{{L}}+|\s*(?:\p{{L}}+|\p{{N}}+|(?<! )(?:{'|'.join(ENDINGS)})|[^\s\p{{L}}\p{{N}}]+)|\s+")
SPACE = regex.compile(r"\s*")
CLASSES = [("a", regex.compile(r"\p{L}")), ("1", regex.compile(r"\p{N}")), ("!", regex.compile(r"[^\s\p{L}\p{N}]"))]
KEPT_UNITS, KEPT_PAIRS, KEPT_LENGTH = 400_000, 1_000_000, 40
BITS = 24
START = (1 << BITS) - 1  # in a token's place, where a pre-token starts


class Counter:
    """Counts for one tokenizer file; its tables are bounded by the vocabulary and the ``KEPT_`` limits."""

    def __init__(self, definition: str):
        tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        pre, model = parts["pre_tokenizer"] or {}, parts["model"]
        added = parts["added_tokens"]
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("not a byte-level tokenizer with its own pattern")
        if parts["normalizer"] or model.get("dropout") or model.get("ignore_merges") or not plain:
            raise ValueError("normalizers, dropout, whole-word look-ups and stretching special tokens are not supported")
        self.pre, self.model = tokenizer.pre_tokenizer, tokenizer.model
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        # Bytes as the vocabulary writes them: printable ones as they are, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.tokens = ahocorasick.Automaton()
        self.names = [""] * (max(model["vocab"].values()) + 1)
        special = set(names)
        for token, number in model["vocab"].items():
            if token not in special:
                self.tokens.add_word(token, (len(token), number))
                self.names[number] = token
        self.tokens.make_automaton()
        self.apart: dict[int, bool] = {}
        self.steps: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.same_class: set[str] = set()
        self.stand_in: dict[int, str] = {}
        self.blank = self.of_piece(" ")[-1]

    # --- one pre-token ---

    def stay_apart(self, before: int, token: int) -> bool:
        """Whether the merges leave two tokens as they are; ``before`` is ``START`` at the start of a pre-token."""
        pair = [token] if before == START else [before, token]
        found = [t.id for t in self.model.tokenize("".join(self.names[t] for t in pair))] == pair
        if len(self.apart) >= KEPT_PAIRS:
            self.apart.clear()
        self.apart[before << BITS | token] = found
        return found

    def of_piece(self, piece: str) -> list[int]:
        """Tokens of each prefix of a pre-token, by whole characters, the empty prefix first."""
        plain = piece.isascii()
        text = (piece if plain else piece.encode().decode("latin-1")).translate(self.letters)
        counts, last, known = [-1] * (len(text) + 1), [START] * (len(text) + 1), self.apart.get
        counts[0] = 0
        for end, (size, token) in self.tokens.iter(text):
            if counts[end + 1] < 0:
                start = end + 1 - size
                before = last[start]
                apart = known(before << BITS | token)
                if self.stay_apart(before, token) if apart is None else apart:
                    counts[end + 1], last[end + 1] = counts[start] + 1, token
        if plain:
            return counts
        return [0] + [counts[i] for i in accumulate(len(c.encode()) for c in piece)]

    # --- one unit ---

    def of_unit(self, unit: str, core_at: int) -> list[int]:
        """Tokens of each prefix of a unit that has ``core_at`` characters of white space in front."""
        space, core = unit[:core_at], unit[core_at:]
        if space == " " and core:
            return [0, self.blank, *self.of_piece(unit)[2:]]
        counts = self.of_piece(space)
        if not core:
            return counts
        joined = space.endswith(" ")
        base = 0
        if len(space) > 1:
            base = counts[-2]
        if space and not joined:
            base += self.of_piece(space[-1])[-1]
        behind = self.of_piece(" " + core)[2:] if joined else self.of_piece(core)[1:]
        if core in ENDINGS and not joined:
            # Until the ending is complete, the apostrophe is a pre-token and so are the letters.
            apostrophe = self.of_piece("'")[-1]
            letters = self.of_piece(core[1:])
            behind = [apostrophe + letters[i] for i in range(len(core) - 1)] + behind[-1:]
        return counts + [base + n for n in behind]

    def unit_steps(self, unit: str, core_at: int) -> bytes:
        counts = self.of_unit(unit, core_at)
        return array("i", map(sub, counts[1:], counts)).tobytes()

    def new_steps(self, unit: str) -> bytes:
        """Steps of a unit that was not met lately; those met since the last change of generations stay."""
        found = self.older.get(unit) or self.unit_steps(unit, SPACE.match(unit).end())
        if len(unit) <= KEPT_LENGTH:
            if len(self.steps) >= KEPT_UNITS:
                self.older, self.steps = self.steps, {}
            self.steps[unit] = found
        return found

    # --- texts ---

    def _cut(self, text: str) -> list[bytes]:
        """Steps of the units of a text without special strings."""
        if not text.isascii():
            self._learn_classes(text)
            shown = text.translate(self.stand_in) if self.stand_in else text
            if shown != text:
                return [self.unit_steps(text[slice(*m.span())], SPACE.match(m[0]).end()) for m in UNIT.finditer(shown)]
        return [self.steps.get(unit) or self.new_steps(unit) for unit in UNIT.findall(text)]

    def _learn_classes(self, text: str) -> None:
        """Characters that the library's Unicode version classes otherwise get a stand-in of the class it sees."""
        for c in set(text) - self.same_class:
            alike = [a for a, _ in CLASSES if len(self.pre.pre_tokenize_str(a + c)) == 1]
            if alike != [a for a, known in CLASSES if known.match(c)]:
                self.stand_in[ord(c)] = alike[0] if alike else "\t"
            self.same_class.add(c)

    def counts(self, text: str) -> np.ndarray:
        """Tokens of the first n characters, for every n from 0."""
        parts, last = [b"\0\0\0\0"], 0
        for m in self.special.finditer(text) if self.special else ():
            before = self._cut(text[last : m.start()])
            parts += before
            parts.append(self._into_special(text, last, before, m))
            last = m.end()
        parts += self._cut(text[last:])
        return np.cumsum(np.frombuffer(b"".join(parts), np.int32), dtype=np.int32)

    def _into_special(self, text: str, first: int, before: list[bytes], m: regex.Match) -> bytes:
        """Steps into a special string: before it is complete its characters may join the last two units."""
        units = before[-2:]
        tail_at = m.start() - sum(map(len, units)) // 4
        base = -sum(int(np.frombuffer(p, np.int32).sum()) for p in units)
        tail = b"".join(self._cut(text[tail_at : m.end() - 1]))
        upto = np.cumsum(np.frombuffer(tail, np.int32))[m.start() - tail_at :] + base
        return np.diff(np.concatenate([[0], upto, [1]])).astype(np.int32).tobytes()


@cache
def _definition(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


@cache
def _counter(definition: str) -> Counter:
    return Counter(definition)


def count_prefixes(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``n_bytes`` and ``counts`` (tokens of the first n characters at place n) of every row."""
    small_batches(spark)
    shared = _definition(spark, path)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = arrow_type(rows, "_id")

    def run(batches: Iterator) -> Iterator:
        counter = _counter(shared.value)
        for batch in batches:
            sizes, found = [], []
            for (text,) in rows_of([batch], "_text"):
                sizes.append(len(text.encode()) if text else 0)
                found.append(counter.counts(text or ""))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *found])
            counts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            columns = [batch.column("_id").cast(id_type), pa.array(sizes, pa.int64()), counts]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_bytes", "counts"])

    return rows.mapInArrow(run, f"_id {kind}, n_bytes bigint, counts array<int>")


def n_tokens(counts: Column) -> Column:
    return F.element_at(counts, -1).cast("bigint")


def tokens_at(counts: Column, characters: Column | int) -> Column:
    """Tokens of the first ``characters``; of the whole text, if it is shorter."""
    return F.element_at(counts, F.least(F.lit(characters) + 1, F.size(counts)).cast("int")).cast("bigint")


def longest_prefix(counts: Column, limit: int) -> Column:
    """The most characters that keep within ``limit`` tokens."""
    fits = F.array_position(F.transform(F.reverse(counts), lambda n: n <= limit), True)
    return F.when(n_tokens(counts) <= limit, F.size(counts) - 1).otherwise(F.size(counts) - fits).cast("bigint")
