"""Language identification by compression: the language whose Zstandard dictionary makes a text smallest.

A language's dictionary is raw content: whole texts of that language, up to ``dictionary_bytes``; where those fill less
than half, also ``PIECES`` pieces, spread evenly over and within the longer texts of the sample, so that a language whose
labelled texts are all long is learned too. Only a bounded
sample of labelled rows is gathered for it (``sample_rows`` a language, the lowest hashes of their ids; all dictionaries
together stay within ``total_bytes``, so that their broadcast is bounded however many languages there are), and what has
no room in a dictionary is dropped as it comes. Texts and dictionaries are reduced to lower-case letters with single blanks between
runs of them, so that capitals, table bars and symbols say nothing.

A text is compressed in pieces of ``PIECE`` bytes against each dictionary, so that the dictionary counts to its end, and
the sizes are summed over the whole text. Texts of up to ``SHORT_BYTES`` are compressed at a level that looks for short
matches too. Every piece stands behind a run of line breaks: without it, Zstandard leaves what saves only a few bytes
uncompressed, and short texts tie. A text of few words is compressed in several cuts, all its endings and beginnings by
words, whose summed sizes are finer than whole bytes.

Two margins must not be narrow: what the best dictionary saves of the second-best size, and of the size without any
dictionary. What is narrow depends on the length and is learned from up to ``CALIBRATION`` sampled texts that are in no
dictionary: the first margin must reach half of what all but ``CLEAN_LOST`` of true pieces of that length reach, the second
must exceed what all but ``NOISE_LEFT`` of pieces with their letters shuffled reach.

Defined results: ``und`` with score 0 for a NULL text or one without a letter, and for every text if nothing is
labelled; ties go to the first language by name, with score 0. ``rejected`` marks ``und`` and narrow margins.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import arrow_type, rows_of, small_batches

UNDETERMINED = "und"
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 64 * 1024
TOTAL_BYTES = 16 * 1024 * 1024
LEVEL, SHORT_LEVEL = 5, 12
SHORT_BYTES, FEW_WORDS = 1024, 12
PIECE = 4096
PIECES = 64
PAD = b"\n" * 200
# Texts kept to learn margins, one of HELD_BACK of a language's; lengths in bytes at which margins are learned.
CALIBRATION, HELD_BACK = 200, 5
LENGTHS = [8 << i for i in range(10)]
CLEAN_LOST, NOISE_LEFT = 0.01, 0.01
NO_LETTER = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    """Dictionaries by language, and by length in bytes the least saving over no dictionary and the least margin."""

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    limits: list[tuple[int, float, float]] = field(default_factory=lambda: [(1, 0.0, 0.0)])


def reduced(text: str) -> bytes:
    return NO_LETTER.sub(" ", text.lower()).strip().encode()


def learn(
    docs: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    total_bytes: int = TOTAL_BYTES,
) -> Model:
    """Dictionaries and margins from at most ``sample_rows`` labelled texts a language."""
    rows = docs.where(may_learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = dict(rows.groupBy(lang_col).count().collect())
    if not counts:
        return Model()
    room = min(dictionary_bytes, total_bytes // len(counts))
    # A share of each language by hash, so that the sample is gathered by one filter; twice the rows, to be cut below.
    cut = lambda n: int(min(1, 2 * sample_rows / n) * 2**31)
    bound = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, cut(n))))
    order = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(2**31))
    sample = rows.where((order < bound[F.col(lang_col)]) & (F.octet_length(text_col) <= room))
    out = dict.fromkeys(counts, b"")
    seen: dict[str, set[int]] = {lang: set() for lang in counts}
    aside: dict[str, list[bytes]] = {lang: [] for lang in counts}
    most_aside = max(4, CALIBRATION // len(counts))

    def add(lang: str, text: bytes) -> bool:
        fits = len(out[lang]) + len(text) < room
        if fits:
            out[lang] += text + b"\n"
        return fits

    for lang, text, _ in sample.select(lang_col, text_col, order.alias("_o")).orderBy("_o").toLocalIterator():
        text = reduced(text)
        if text and zlib.crc32(text) not in seen[lang] and len(seen[lang]) < sample_rows:
            seen[lang].add(zlib.crc32(text))
            kept_back = len(seen[lang]) % HELD_BACK == 0 or not add(lang, text)
            if kept_back and len(aside[lang]) < most_aside:
                aside[lang].append(text[:PIECE].decode(errors="ignore").encode())
    bare = {lang for lang, content in out.items() if 2 * len(content) < room}
    if bare:
        few = F.create_map(*(F.lit(x) for lang in sorted(bare) for x in (lang, cut(counts[lang]))))
        longer = rows.where((order < few[F.col(lang_col)]) & (2 * F.octet_length(text_col) > room))
        size = max(2, room // PIECES)
        for lang, pieces in _pieces(longer, text_col, lang_col, order, size):
            for piece in pieces:
                # Cut by bytes as well, so that in any script all pieces have room.
                add(lang, reduced(piece)[: size - 1].decode(errors="ignore").encode())
    model = Model({lang: content for lang, content in out.items() if content})
    model.limits = _limits(Classifier(model), aside)
    return model


def _limits(classifier: Classifier, aside: dict[str, list[bytes]]) -> list[tuple[int, float, float]]:
    """By length, the margins to be reached: on true pieces, and on the same with their letters shuffled."""
    rng, out = random.Random(7), []
    for length in LENGTHS:
        margins, savings = [], []
        for lang, texts in sorted(aside.items()):
            for text in texts:
                piece = _run_of_words(text, length, rng)
                if piece is None or lang not in classifier.languages:
                    continue
                sizes = classifier.sizes(piece)
                own = sizes[classifier.languages.index(lang)]
                others = [s for s, x in zip(sizes, classifier.languages) if x != lang]
                margins.append((min(others) - own) / min(others) if others else 1.0)
                letters = list(piece.decode())
                rng.shuffle(letters)
                *sizes, bare = classifier.sizes(" ".join("".join(letters).split()).encode())
                savings.append((bare - min(sizes)) / bare)
        if margins:
            least = max(0.0, float(np.quantile(margins, CLEAN_LOST))) / 2
            out.append((length, max(0.0, float(np.quantile(savings, 1 - NOISE_LEFT))), least))
    return out or [(1, 0.0, 0.0)]


def _run_of_words(text: bytes, length: int, rng: random.Random) -> bytes | None:
    """Whole words from somewhere in the text, of about this length."""
    words = text.split(b" ")
    if len(text) < length:
        return None
    words = words[rng.randrange(len(words)) :] + words
    ends = np.cumsum([len(w) + 1 for w in words])
    return b" ".join(words[: int(np.searchsorted(ends, length)) + 1])


def _pieces(longer: DataFrame, text_col: str, lang_col: str, order: Column, size: int):
    """Language and pieces of ``size`` characters of each text, about ``PIECES`` a language over all its texts."""
    counts = dict(longer.groupBy(lang_col).count().collect())
    if not counts:
        return
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, -(-PIECES // n))))
    n = share[F.col(lang_col)]
    step = F.greatest(F.length(text_col) - size, F.lit(0)) / F.greatest(n - 1, F.lit(1))
    # A single piece is taken from the middle.
    at = lambda i: F.when(n == 1, step / 2).otherwise(step * i).cast("int") + 1
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(text_col), at(i), F.lit(size)))
    taken = longer.select(lang_col, pieces.alias("_pieces"), order.alias("_o")).orderBy("_o")
    for lang, found, _ in taken.toLocalIterator():
        yield lang, found


def _frames(text: bytes, piece: int) -> tuple[bool, list[bytes]]:
    """Whether a text is short, and the parts it is compressed in."""
    if len(text) > SHORT_BYTES:
        return False, [PAD + text[i : i + piece] for i in range(0, len(text), piece)]
    words = text.split(b" ")
    if len(words) > FEW_WORDS:
        return True, [PAD + text]
    ends = [b" ".join(words[i:]) for i in range(len(words))]
    return True, [PAD + part for part in ends + [b" ".join(words[:i]) for i in range(1, len(words))]]


class Classifier:
    def __init__(self, model: Model, piece: int = PIECE):
        self.languages = sorted(model.dictionaries)
        self.piece = piece
        self.lengths = np.log2([n for n, *_ in model.limits])
        self.least_saving, self.least_margin = ([x[i] for x in model.limits] for i in (1, 2))
        options = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compressors = {}
        for short, level in ((False, LEVEL), (True, SHORT_LEVEL)):
            own = self.compressors[short] = []
            for lang in self.languages:
                content = zstandard.ZstdCompressionDict(model.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=level)
                own.append(zstandard.ZstdCompressor(level=level, dict_data=content, **options))
            own.append(zstandard.ZstdCompressor(level=level, **options))

    def sizes(self, text: bytes) -> list[int]:
        """Compressed sizes by language, and last without a dictionary."""
        short, frames = _frames(text, self.piece)
        return [sum(len(c.compress(f)) for f in frames) for c in self.compressors[short]]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the margin (what the best size saves of the second-best) and whether the text is rejected."""
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        letters = reduced(text)
        *sizes, bare = self.sizes(letters)
        best, *others = sorted(sizes)
        margin = (others[0] - best) / others[0] if others else 1.0
        length = np.log2(max(1, len(letters)))
        narrow = margin <= 0 or margin < np.interp(length, self.lengths, self.least_margin)
        narrow = narrow or (bare - best) / bare <= np.interp(length, self.lengths, self.least_saving)
        return self.languages[sizes.index(best)], margin, bool(narrow)


def identify(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``lang_pred``, ``score`` (the margin), ``rejected`` of every row."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = arrow_type(rows, "_id")

    def run(batches):
        classifier = Classifier(shared.value)
        for batch in batches:
            langs, scores, rejected = zip(*(classifier.classify(text) for (text,) in rows_of([batch], "_text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").cast(id_type),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["_id", "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(run, f"_id {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows whose language is found by sufficient margins, in one pass without a join; columns as they were."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        classifier = Classifier(shared.value)
        for batch in batches:
            keep = [not classifier.classify(text)[2] for (text,) in rows_of([batch], text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
