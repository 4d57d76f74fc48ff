"""Line de-duplication by site-relative frequency.

Of each host, the share of its pages that contain a line; lines above the boilerplate ratio are dropped from its pages.
Lines are compared without surrounding white space, blank ones are never dropped, and a page counts a line once.

A line's count is combined before the shuffle, which carries (host, MD5, count) and not the text. The lines
above the ratio are few: pages of a host hold on average L lines, so at most L / ratio of them exceed it. They return
to the pages as one array per host, by a join that Spark broadcasts only below its own threshold and otherwise splits at
hot hosts. All set operations on marks are hashed, so the time a page takes is linear in its lines.

A line on a single page is no repetition, and one on two may be a page and its copy: on hosts of few pages any ratio
would empty both. So a line needs ``min_pages`` pages besides the ratio, which changes nothing on hosts of
``min_pages / ratio`` pages or more.

Defined results: a NULL text stays NULL and counts as a page; a NULL host is a host of its own; repeated rows are pages
of their own; a text whose lines all go becomes empty; nothing is dropped below ``min_pages`` pages. Columns of any name
pass through.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tripflow.llm.common import small_batches, stored

RATIO = 0.1
MIN_PAGES = 3
BLANKS = " \t\r\x0b\x0c"


def _marks(text: Column) -> Column:
    """Marks of a text's distinct lines that are not blank."""
    bare = F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    # Text, since Spark hashes the elements of such arrays only if they are atomic and not binary.
    return F.array_distinct(F.transform(F.filter(bare, lambda x: x != ""), F.md5))


def boilerplate(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``_host``, ``_dropped`` (marks of lines on at least ``min_pages`` pages and over ``ratio`` of the host's)."""
    pages = docs.select(F.col(f"`{host_col}`").alias("_host"), F.col(f"`{text_col}`").alias("_text"))
    marks = pages.select("_host", F.explode(_marks(F.col("_text"))).alias("_mark"))
    counts = marks.groupBy("_host", "_mark").agg(F.count("*").alias("_on")).where(F.col("_on") >= min_pages)
    totals = pages.groupBy("_host").agg(F.count("*").alias("_pages"))
    same = counts["_host"].eqNullSafe(totals["_host"])
    over = counts.join(totals, same).where(F.col("_on") > ratio * F.col("_pages"))
    return over.groupBy(counts["_host"].alias("_host")).agg(F.collect_list("_mark").alias("_dropped"))


@F.pandas_udf(StructType().add("text", StringType()).add("n_dropped", LongType()))
def _without(text: pd.Series, marks: pd.Series) -> pd.DataFrame:
    """Texts without the lines of these marks."""
    texts, counts = [], []
    for t, found in zip(text, marks):
        if t is None or found is None or not len(found):
            texts.append(t)
            counts.append(0)
            continue
        drop, lines = set(found), t.split("\n")
        bare = (x.strip(BLANKS) for x in lines)
        kept = [x for x, b in zip(lines, bare) if not b or hashlib.md5(b.encode()).hexdigest() not in drop]
        texts.append("\n".join(kept))
        counts.append(len(lines) - len(kept))
    return pd.DataFrame({"text": pd.Series(texts, dtype=object), "n_dropped": counts})


def without_boilerplate(
    spark: SparkSession,
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``doc`` (a row's columns as a struct), ``text``, ``n_lines`` before and ``n_dropped`` of them."""
    small_batches(spark)
    found = stored(spark, boilerplate(docs, host_col, text_col, ratio, min_pages), "boilerplate")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    text = rows["doc"][text_col]
    joined = rows.join(found, rows["doc"][host_col].eqNullSafe(found["_host"]), "left")
    hit = F.when(F.col("_dropped").isNotNull(), F.array_intersect(_marks(text), F.col("_dropped")))
    return joined.select("doc", _without(text, hit).alias("new"), F.size(F.split(text, "\n", -1)).alias("n_lines")).select(
        "doc", "new.text", F.col("n_lines").cast("bigint").alias("n_lines"), "new.n_dropped"
    )


def drop_boilerplate(
    spark: SparkSession,
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    length_col: str | None = "n_chars",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Pages without their boilerplate lines; ``length_col``, where it exists, is the new text's length."""
    found = without_boilerplate(spark, docs, host_col, text_col, ratio, min_pages)
    old = lambda c: found["doc"][c]
    new = {text_col: found["text"]}
    if length_col in docs.columns:
        new[length_col] = F.coalesce(F.length("text"), old(length_col)).cast(docs.schema[length_col].dataType)
    return found.select(*(new.get(c, old(c)).alias(c) for c in docs.columns))
