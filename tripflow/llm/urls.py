"""URL filter whose pattern rules are indexed by their rarest literal token.

Rules are rows (``rule``, ``verdict``, ``rank``, ``pattern``, ``literals``): a regular expression over host and path, and
the literal tokens that every match must contain. The tokens' frequencies over all URLs pick the rarest literal of each
rule; the tokens of a URL fetch the rules filed under them, and only those run their expressions. The highest rank
decides, of equal ranks the longer rule, then the rule later by name.

Distinct URLs are judged once, so one that a third of the pages share is one row until its verdict is joined back. The
rules are not broadcast by this code: Spark does it below its own threshold, and else joins on the tokens. Defined
results: a NULL URL, or one without ``://``, has an empty host and path and the default verdict, as has an empty URL;
repeated rows are judged each; an empty table has no rows; columns of any name pass through.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import ascii_lower

RULES_SCHEMA = "rule string, verdict string, rank int, pattern string, literals array<string>"
# ASCII words end at any other character, as in the rules' expressions; so do runs of non-ASCII characters.
TOKEN = "[a-z0-9]+|[\\x{80}-\\x{10FFFF}]+"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def prefix_rule(host: str, path: str, verdict: str, rank: int = 1) -> tuple:
    """A rule for a host with its subdomains and the paths that start with ``path``.

    Its literals are the tokens of both that the rule itself ends: what stands last may go on in a URL.
    """
    quoted = re.sub(r"([^0-9A-Za-z])", r"\\\1", host + path)
    whole = re.sub("[A-Z]+", lambda m: m[0].lower(), host + path)
    literals = [m[0] for m in re.finditer("[a-z0-9]+|[\x80-\U0010ffff]+", whole) if m.end() < len(whole)]
    if not literals:
        raise ValueError(f"a rule needs a whole token: {host + path!r}")
    return f"{host}{path}", verdict, rank, f"(?s)^(?:[^/]*\\.)?{quoted}", list(dict.fromkeys(literals))


def pattern_rule(name: str, verdict: str, pattern: str, literals: list[str], rank: int = 0) -> tuple:
    return name, verdict, rank, pattern, literals


def tokens_of(where: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(where), F.lit(f"({TOKEN})"), 1))


def rarest_literals(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule filed under that of its literals which the fewest URLs contain; ``tokens`` has a row per URL and token."""
    listed = rules.select("rule", "verdict", "rank", "pattern", F.explode("literals").alias("token"))
    seen = tokens.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    return (
        listed.join(seen, "token", "left")
        .groupBy("rule", "verdict", "rank", "pattern")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct URLs with ``_host``, ``_path``, and ``_best`` (rule, verdict, rank) where a rule matches."""
    urls = pages.select(F.col(f"`{url_col}`").alias("_url")).where(F.col("_url").contains("://")).distinct()
    parts = urls.select("_url", F.concat(host_of(F.col("_url")), path_of(F.col("_url"))).alias("_where"))
    tokens = parts.select("_url", "_where", F.explode(tokens_of(F.col("_where"))).alias("token"))
    found = tokens.join(rarest_literals(tokens.select("token"), rules), "token")
    matching = found.where(F.call_function("regexp_like", F.col("_where"), F.col("pattern")))
    order = F.struct("rank", F.length("rule"), "rule")
    return matching.groupBy("_url").agg(F.max_by(F.struct("rule", "verdict", "rank"), order).alias("_best"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page`` (a row's columns as a struct), ``host``, ``path``, ``rule``, ``rank`` and ``verdict``."""
    judged = judge(pages, rules, url_col)
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("page"))
    url = F.coalesce(rows["page"][url_col], F.lit(""))
    return rows.join(judged, rows["page"][url_col] == judged["_url"], "left").select(
        "page",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.col("_best.rank").alias("rank"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )


def rules_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """Rules as a table; built from SQL rows, so that no Python runs on the executors."""
    quote = lambda s: "r'" + s + "'" if "'" not in s else None
    rows = ", ".join(
        f"({quote(rule)}, {quote(verdict)}, {rank}, {quote(pattern)}, array({', '.join(map(quote, literals))}))"
        for rule, verdict, rank, pattern, literals in rules
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(rule, verdict, rank, pattern, literals)")
