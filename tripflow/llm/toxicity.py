"""Toxic passages as maximum-scoring segments of token log-odds.

Learning: in a bounded sample of labelled documents (``sample_rows``, by hash of the id), count the documents of either
label that contain a word, and take its log-odds with an informative Dirichlet prior (the words' overall shares, worth
``PRIOR`` documents). Words whose log-odds are within ``MIN_Z`` of their deviation count as 0. Every token costs
a drift (``DRIFT``, and more where the mean score of a clean token is above 0), so that the expected score is negative.

Scoring: a linear-time scan finds all maximal segments of a text. A segment's score S has the extreme-value tail
P(max >= S) = 1 - exp(-K n exp(-lambda S)) in a clean text of n tokens. Lambda is the positive root of
sum p(s) exp(lambda s) = 1, where p are the shares of clean tokens under the same prior (a word that no clean text of the
sample holds is rare there, not impossible). K is the maximum-likelihood rate of n exp(-lambda M) over the clean texts'
best scores M, of which those without a segment say only that they lie above n. Segments with an expectation below
``MAX_E`` are significant passages; a document's statistic adds their surprise, and a logistic curve fitted to the
sample's labels turns it into a score.

Counting, log-odds and their test run in the plan; the driver receives the words that carry a score and three numbers for
each sampled text, whatever the texts' lengths. Whole texts are scanned. Defined results: a NULL or empty text has no segment and the score of a
text without any; repeated label rows count once, as toxic if one says so; without labels of both kinds nothing scores
above 0; repeated document rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import WORD_BYTES, arrow_schema, arrow_type, batch_of, rows_of, small_batches, stored

SAMPLE_ROWS = 20_000
PRIOR = 500.0
MIN_Z = 3.0
DRIFT = 0.05
MAX_E = 0.1
COUNTS = "word binary, toxic bigint, clean bigint, clean_tokens bigint, tokens bigint"
BEST = "toxic int, n bigint, best double"
STATISTIC = "toxic int, statistic double"


@dataclass
class Model:
    scores: dict[bytes, float] = field(default_factory=dict)
    drift: float = DRIFT
    rate: float = 1.0  # lambda
    k: float = 0.1
    intercept: float = -50.0
    slope: float = 0.0

    def segments(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """All maximal scoring segments, as (first, last + 1, score), left to right."""
        get, drift = self.scores.get, self.drift
        return maximal_segments([get(w, 0.0) - drift for w in words])

    def expectation(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-self.rate * score)

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Significant segments with their expectation."""
        found = ((a, b, s, self.expectation(s, len(words))) for a, b, s in self.segments(words))
        return [x for x in found if x[3] < MAX_E]

    def statistic(self, words: list[bytes]) -> float:
        return sum(-math.log(max(e, 1e-300)) for *_, e in self.passages(words))

    def probability(self, statistic: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.intercept + self.slope * math.log1p(statistic)))))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences in linear time: candidates are kept with the totals before and after them."""
    held: list[tuple[int, int, float, float]] = []  # first, end, total before, total after
    back: list[int] = []  # for each candidate, the nearest one to the left with a lower total before it
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, end, low, high = i, i + 1, before, total
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = back[j]
            if j < 0 or held[j][3] >= high:
                break
            first, low = held[j][0], held[j][2]
            del held[j:], back[j:]
        held.append((first, end, low, high))
        back.append(j)
    return [(a, b, high - low) for a, b, low, high in held]


def log_odds(counts: DataFrame) -> DataFrame:
    """Words with a clear log-odds ratio under an informative Dirichlet prior: ``word``, ``score`` and their token counts.

    ``counts`` has the documents of either label that hold a word (``toxic``, ``clean``), and how many there are under
    the empty word. A word counts once per document, so that a document which repeats one word cannot make it toxic;
    odds are against all words of that label's documents.
    """
    named = F.col("word") != F.lit(b"")
    of = lambda c, which: F.coalesce(F.sum(F.when(which, F.col(c))), F.lit(0)).cast("double")
    totals = counts.agg(of("toxic", ~named), of("clean", ~named), of("toxic", named), of("clean", named)).first()
    n_toxic, n_clean, total_a, total_b = totals
    n = n_toxic + n_clean
    if not n_toxic or not n_clean:
        return counts.select("word", F.lit(0.0).alias("score"), "clean_tokens", "tokens").where("false")
    share_a, share_b = n_toxic / n, n_clean / n
    prior_total = PRIOR * (total_a + total_b) / n
    prior = F.lit(PRIOR / n) * (F.col("toxic") + F.col("clean"))
    with_a, with_b = F.col("toxic") + prior * share_a, F.col("clean") + prior * share_b
    odds = lambda x, total, share: x / F.greatest(F.lit(total + prior_total * share) - x, F.lit(1e-9))
    delta = F.ln(odds(with_a, total_a, share_a) / odds(with_b, total_b, share_b))
    clear = F.abs("score") >= MIN_Z * F.sqrt(1 / with_a + 1 / with_b)
    return counts.where(named).withColumn("score", delta).where(clear).select("word", "score", "clean_tokens", "tokens")


def tail_rate(scores: list[float], shares: list[float], drift: float) -> float:
    """The positive root of sum p(s - drift) exp(x (s - drift)) = 1; what is left of the shares scores 0.

    Without a positive score there are no segments and any rate will do: 1.
    """
    if max(scores, default=0.0) <= drift:
        return 1.0
    rest = math.log(max(1e-300, 1 - sum(shares)))
    parts = [(math.log(p), s - drift) for p, s in zip(shares, scores) if p > 0] + [(rest, -drift)]

    def excess(x: float) -> float:
        terms = [p + x * s for p, s in parts]
        most = max(terms)
        return most + math.log(sum(math.exp(t - most) for t in terms))

    low, high = 0.0, 1.0
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a weak pull to 0 that keeps separable labels finite."""
    w = np.zeros(2)
    design = np.column_stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (y - p) - 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def learn(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on about ``sample_rows`` labelled documents, fewer if fewer are labelled; ``may_learn`` is over ``labels``."""
    usable = labels.where(may_learn & F.col(label_col).isNotNull())
    marked = usable.groupBy(F.col(id_col).alias("_label_id")).agg(F.max(label_col).cast("int").alias("_toxic"))
    known = marked.count()
    if not known:
        return Model()
    share = int(min(1, sample_rows / known) * 2**31)
    sample = marked.where(F.pmod(F.xxhash64("_label_id"), F.lit(2**31)) < share)
    rows = docs.select(id_col, text_col).join(F.broadcast(sample), docs[id_col] == sample["_label_id"])
    rows = rows.select("_toxic", F.col(text_col).cast("binary").alias("_text"))
    sums = [F.sum(c).alias(c) for c in ("toxic", "clean", "clean_tokens", "tokens")]
    counts = rows.mapInArrow(_count_words(arrow_schema(COUNTS)), COUNTS).groupBy("word").agg(*sums)
    counts = stored(spark, counts, "word_counts")
    found = [(bytes(w), *x) for w, *x in log_odds(counts).toLocalIterator()]
    if not found:
        return Model()
    model = Model(scores={w: s for w, s, *_ in found})
    none = F.lit(b"")
    of_all = [F.sum(F.when(F.col("word") != none, F.col(c))).cast("double") for c in ("clean_tokens", "tokens")]
    texts = F.sum(F.when(F.col("word") == none, F.col("toxic") + F.col("clean"))).cast("double")
    clean_tokens, tokens, n_texts = counts.agg(*of_all, texts).first()
    prior = PRIOR * tokens / n_texts
    shares = [(c + prior * t / tokens) / (clean_tokens + prior) for _, _, c, t in found]
    scores = list(model.scores.values())
    model.drift = DRIFT + max(0.0, sum(p * s for p, s in zip(shares, scores)))
    model.rate = tail_rate(scores, shares, model.drift)
    calibrate(spark, rows, model)
    return model


def _count_words(shape: pa.Schema):
    """Documents of either label that contain a word, and how often it stands; the empty word counts the documents."""

    def run(batches):
        toxic, clean, clean_tokens, tokens = Counter(), Counter(), Counter(), Counter()
        for label, text in rows_of(batches, "_toxic", "_text"):
            words = Counter(WORD_BYTES.findall(text.lower())) if text else Counter()
            tokens.update(words)
            if not label:
                clean_tokens.update(words)
            (toxic if label else clean).update(words.keys() | {b""})
        words = list(toxic.keys() | clean.keys())
        for i in range(0, len(words), 50_000):
            yield batch_of([(w, toxic[w], clean[w], clean_tokens[w], tokens[w]) for w in words[i : i + 50_000]], shape)

    return run


def calibrate(spark: SparkSession, rows: DataFrame, model: Model) -> None:
    """Fit K and the logistic curve on texts (``_toxic``, ``_text``), scanned where they lie; lambda and scores are given."""
    texts = _per_text(spark, rows, model, BEST, lambda m, words: (len(words), max((s for *_, s in m.segments(words)), default=0.0)))
    # n exp(-lambda M) is exponential with rate K over clean texts; of a text without a segment it is n or more.
    clean = [(n * math.exp(-model.rate * best), best > 0) for label, n, best in texts if not label and n]
    if clean:
        model.k = max(1, sum(seen for _, seen in clean)) / max(1e-300, sum(e for e, _ in clean))
    texts = _per_text(spark, rows, model, STATISTIC, lambda m, words: (m.statistic(words),))
    x = np.array([math.log1p(statistic) for _, statistic in texts])
    model.intercept, model.slope = _logistic(x, np.array([label for label, _ in texts], float))


def _per_text(spark: SparkSession, rows: DataFrame, model: Model, schema: str, of_words) -> list:
    """The label and numbers of each text."""
    shared, shape = spark.sparkContext.broadcast(model), arrow_schema(schema)

    def run(batches):
        found = []
        for label, text in rows_of(batches, "_toxic", "_text"):
            found.append((label, *of_words(shared.value, WORD_BYTES.findall(text.lower()) if text else [])))
        yield batch_of(found, shape)

    return rows.mapInArrow(run, schema).collect()


def score(
    spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``_id``, ``score`` (0 to 1), ``p_value`` of its best segment, ``passages`` (words a to b, score, expectation)."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = arrow_type(rows, "_id")
    schema = "score double, p_value double, passages array<struct<a:bigint,b:bigint,score:double,expectation:double>>"
    shape = arrow_schema(schema)

    def run(batches):
        model = shared.value
        for batch in batches:
            found = []
            for (text,) in rows_of([batch], "_text"):
                passages = model.passages(WORD_BYTES.findall(text.lower())) if text else []
                statistic = sum(-math.log(max(e, 1e-300)) for *_, e in passages)
                least = min((e for *_, e in passages), default=None)
                spans = [{"a": a, "b": b, "score": s, "expectation": e} for a, b, s, e in passages]
                found.append((model.probability(statistic), -math.expm1(-least) if passages else 1.0, spans))
            part = batch_of(found, shape)
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(id_type), *part.columns], names=["_id", *part.schema.names])

    return rows.mapInArrow(run, f"_id {kind}, {schema}")
