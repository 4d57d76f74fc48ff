"""Document quality by weak supervision: rules vote or abstain, and EM weighs them.

Every rule reads one measure of a text and votes good, bad or abstains. The votes of a document form one of at most
3^rules patterns; the patterns are counted over all documents (combined before the shuffle, so no key is hot), and EM
over that bounded table estimates each rule's accuracy on either class and the share of good documents. The posterior probability of a
document's pattern replaces a filter that asks all rules to pass. DataFrame functions only; the EM steps are sums over
the pattern table and need no row of the data.

Defined results: a NULL or empty text has no words, so every measure is 0 and it fails the base rule; rules abstain
where a measure has no meaning; repeated rows vote each; an empty table gives an empty result with the starting weights.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import row_key, stored

BLANK = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
ROUNDS = 100
START_RATES, START_GOOD = (0.95, 0.5), 0.8


# --- measures -----------------------------------------------------------------------------


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are sorted with their places, so equal ones are neighbours; the places are sorted again and cover up to
    three words each, less what the next one covers.
    """
    at = F.sequence(F.lit(0), F.size(words) - 3)
    window = lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
    )
    return F.when(F.size(words) >= 3, F.sort_array(F.transform(at, window)))


def _covered(ordered: Column) -> Column:
    again = F.filter(
        ordered,
        lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
    )
    return F.sort_array(F.transform(again, lambda x: x["i"]))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``_id``, ``_key`` and counts: words, their characters, symbols, lines, repeated lines and words, ends."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), row_key(F.col(text_col)).alias("_key"), text.alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.translate(x, BLANK, "") != "")
    cut = rows.select(
        "_id",
        "_key",
        F.regexp_extract_all("_text", F.lit(f"({WORD})"), 1).alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate("_text", BLANK, "")).cast("bigint").alias("word_chars"),
        _count(F.col("_text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        _count(F.col("_text"), ".!?").cast("bigint").alias("n_stops"),
        _count(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("bigint").alias("n_capitals"),
    )
    kept = ("_id", "_key", "word_chars", "n_symbols", "n_stops", "n_capitals")
    ordered = cut.select(
        *kept,
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("_ordered"),
    )
    places = ordered.withColumn("_places", _covered(F.col("_ordered"))).drop("_ordered")
    reach = F.transform(
        F.col("_places"), lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(3)))
    )
    total = F.aggregate(reach, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return places.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("bigint"))).drop("_places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# --- votes ---------------------------------------------------------------------------------


def _vote(part: Column, of: Column, good: float, bad: float) -> Column:
    """1 if the ratio is at most ``good``, -1 if over ``bad``, else 0; 0 where there is nothing to measure."""
    ratio = part / F.nullif(of, F.lit(0))
    return F.when(ratio <= good, 1).when(ratio > bad, -1).otherwise(0)


def rules() -> list[Column]:
    """Each rule's vote over the measures.

    Symbols are seen by two rules, as repetition is: EM knows a fault by votes that agree.
    """
    words, chars = F.col("n_words"), F.col("word_chars")
    mean = chars / F.nullif(words, F.lit(0))
    return [
        F.when(words >= 50, 1).when(words < 20, -1).otherwise(0),
        _vote(F.col("n_symbols"), words, 0.05, 0.2),
        _vote(F.col("n_symbols"), chars, 0.01, 0.03),
        _vote(F.col("n_dup_lines"), F.col("n_lines"), 0.1, 0.3),
        _vote(F.col("n_repeat_words"), words, 0.15, 0.5),
        _vote(F.col("n_capitals"), chars, 0.12, 0.3),
        F.when(mean.between(3, 10), 1).when((mean < 2) | (mean > 14), -1).otherwise(0),
        F.when(words < 20, 0).when(F.col("n_stops") * 100 >= words, 1).when(F.col("n_stops") * 400 < words, -1).otherwise(0),
    ]


# --- the label model ---------------------------------------------------------------------


def _posterior(votes: tuple[int, ...], rates: list[tuple[float, float]], good: float) -> float:
    odds = good / (1 - good)
    for v, (of_good, of_bad) in zip(votes, rates):
        odds *= _factor(v, of_good, of_bad)
    return odds / (1 + odds)


def _factor(vote: int, of_good: float, of_bad: float) -> float:
    """What a vote does to the odds of being good; abstaining does nothing."""
    return {1: of_good / of_bad, -1: (1 - of_good) / (1 - of_bad), 0: 1.0}[vote]


def fit(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[list[tuple[float, float]], float]:
    """Per rule the shares of good votes among good and among bad documents, and the share of good documents.

    EM over counted vote patterns. The two shares are a rule's accuracy on either class: a rule that praises nearly
    every text says little by it. A rule never counts against its own vote; one that would is taken as saying nothing.
    """
    size = len(next(iter(patterns), ()))
    rates, good = [START_RATES] * size, START_GOOD
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        weights = [(votes, n, _posterior(votes, rates, good)) for votes, n in sorted(patterns.items())]
        good = min(0.99, max(0.01, sum(n * p for _, n, p in weights) / total))
        for j in range(size):
            # A document of either kind is added at the starting rates, so that no rate is certain.
            up_good = START_RATES[0] + sum(n * p for votes, n, p in weights if votes[j] > 0)
            up_bad = START_RATES[1] + sum(n * (1 - p) for votes, n, p in weights if votes[j] > 0)
            all_good = 1 + sum(n * p for votes, n, p in weights if votes[j])
            all_bad = 1 + sum(n * (1 - p) for votes, n, p in weights if votes[j])
            if up_good / all_good >= up_bad / all_bad:
                rates[j] = (_clipped(up_good / all_good), _clipped(up_bad / all_bad))
            else:
                rates[j] = (_clipped((up_good + up_bad) / (all_good + all_bad)),) * 2
    return rates, good


def _clipped(rate: float) -> float:
    return min(0.999, max(0.001, rate))


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures of every row with ``base_failed``, ``votes`` (array) and ``posterior``."""
    votes = rules()
    found = measures(docs, id_col, text_col).withColumn("votes", F.array(*votes))
    found = stored(spark, found.withColumn("base_failed", base_failed()), "votes")
    patterns = {tuple(row.votes): row.n for row in found.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    rates, good = fit(patterns)
    # The odds of a document: the share's and those of the rules that voted.
    factors = (
        F.when(F.col("votes")[j] > 0, _factor(1, *r)).when(F.col("votes")[j] < 0, _factor(-1, *r)).otherwise(1.0)
        for j, r in enumerate(rates)
    )
    odds = reduce(Column.__mul__, factors, F.lit(good / (1 - good)))
    return found.withColumn("posterior", odds / (1 + odds))
