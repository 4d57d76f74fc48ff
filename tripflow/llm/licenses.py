"""License notices by an exact set-similarity join with templates.

A text block (a window of consecutive words, whatever the line breaks) holds a template if it contains at least
``threshold`` of the template's distinct words. A window has at most ``SPAN`` times as many words as the template, and one
starts at every word of the template, so that none is lost between two and far-off words are not put together. The join
is exact: words are ordered by their frequency over all documents, rarest first; a template's prefix is so long that a
block with enough of its words holds one of the prefix; a block needs as many distinct words as the threshold asks for;
and a shared word at some place of the order leaves room for only so many more. What passes is counted.

Short templates differ from their neighbours by a word or two, which containment does not see. So a block is verified: it
must hold the words that distinguish its template, and no word that makes it another license (``MARKS``). A notice without
a template of its own, such as CC BY-NC-SA, gets no label. Sentences that licenses share word for word stay ambiguous: MPL
1.1 has Apache's "you may not use this file", and NCSA begins like MIT.

The templates are fixed, so the prefix table and the template table have a bound and are broadcast. Whole texts are cut
into words, and only the surroundings of prefix words leave their row. DataFrame functions only.

Defined results: a NULL text is empty, with no words; words repeated in a block count once; of overlapping blocks the
one with the most shared words, then the shortest, then the last stands for all; equal blocks of a document count each
for its places but give its labels once; repeated rows are scanned each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import ascii_lower, row_key

THRESHOLD = 0.8
# Words of a block for one of its template, at most; wrapped comments may add a word on each line.
SPAN = 1.25
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# A character of a word before lower-casing.
LETTER = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"

# The phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices as licenses and their stewards publish them.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

_OTHER_CC = "nc noncommercial commercial sa sharealike alike nd noderivatives noderivs derivatives derivs"
# By template, the words that a block must hold, and those that end a block.
MARKS = {
    "Licensed under the Apache License, Version 2.0": ("apache", ""),
    "This work is licensed under a Creative Commons Attribution 4.0 International License": ("attribution", _OTHER_CC),
    "Licensed under CC BY-NC 4.0": ("nc", "sa nd"),
    "Licensed under CC BY-SA 4.0": ("sa", "nc nd"),
    "This work is licensed under the GNU General Public License, version 3": ("general public", ""),
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation": ("general public", ""),
    "Released under the MIT License": ("mit", ""),
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": ("software associated files", ""),
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": ("mozilla", ""),
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), 1)


def templates_table(spark: SparkSession, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """``template``, ``label``, ``tokens`` (distinct), ``needed`` (how many of them a block must hold), ``span`` (a block's
    words at most), ``must`` and ``ends`` (the words of ``MARKS``)."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(
        f"({i}, {', '.join(map(quote, (label, text, *MARKS.get(text, ('', '')))))})" for i, (label, text) in enumerate(templates)
    )
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, label, text, must, ends)")
    marks = [words_of(F.col(c)).alias(c) for c in ("must", "ends")]
    span = F.ceil(F.size(words_of(F.col("text"))) * F.lit(SPAN)).cast("int").alias("span")
    tokens = table.select("template", "label", F.array_distinct(words_of(F.col("text"))).alias("tokens"), span, *marks)
    needed = F.greatest(F.lit(1), F.ceil(F.size("tokens") * F.lit(threshold) - 1e-9)).cast("int")
    return tokens.select("*", needed.alias("needed"))


def token_order(spark: SparkSession, docs: DataFrame, text_col: str, templates: DataFrame) -> list[str]:
    """The templates' distinct words by the number of documents that hold them, rarest first.

    The list is bounded by the templates; the counts are over all documents.
    """
    listed = sorted({t for row in templates.select("tokens").collect() for t in row.tokens})
    known = F.array(*map(F.lit, listed))
    held = F.array_intersect(words_of(F.coalesce(F.col(text_col), F.lit(""))), known)
    counts = dict(docs.select(F.explode(held).alias("token")).groupBy("token").count().collect())
    return sorted(listed, key=lambda t: (counts.get(t, 0), t))


def join_tables(templates: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The prefix table (``token``, ``template``) and the templates with their tokens in the global order."""
    ordered = templates.select(
        "template", "label", "needed", "span", "must", "ends", F.array_intersect(F.array(*map(F.lit, order)), "tokens").alias("tokens")
    ).withColumn("prefix", F.slice("tokens", F.lit(1), F.size("tokens") - F.col("needed") + 1))
    return ordered.select(F.explode("prefix").alias("token"), "template"), ordered


def find_notices(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Blocks that hold a template: ``_id``, ``_key``, ``line``, ``block``, ``template``, ``label``, ``containment``.

    ``line`` is that of the block's first word, ``block`` its words. ``_key`` is a hash of the text: rows that repeat an
    id with another text stay apart.
    """
    table = templates_table(spark, templates, threshold)
    order = token_order(spark, docs, text_col, table)
    prefix, full = join_tables(table, order)
    listed = sorted({row.token for row in prefix.collect()})
    widest = max(row.span for row in table.select("span").collect())
    # Texts without any prefix word as a word of its own have no candidate block; one scan leaves them out.
    cut = docs.where(F.regexp_like(F.col(text_col), F.lit(f"(?i)(?<!{LETTER})(?:{'|'.join(listed)})(?!{LETTER})"))).select(
        F.col(id_col).alias("_id"),
        row_key(F.col(text_col)).alias("_key"),
        F.transform(F.split(text_col, "\n", -1), words_of).alias("_cut"),
    )
    in_line = F.flatten(F.transform("_cut", lambda words, i: F.array_repeat(i, F.size(words))))
    words = cut.select("_id", "_key", F.flatten("_cut").alias("_words"), in_line.alias("_lines"))
    # The outer form, since Spark would cut the words once more to leave out rows without any.
    hits = words.select("*", F.posexplode_outer("_words").alias("_at", "token")).where(F.col("token").isin(listed))
    first = F.greatest(F.col("_at") - (widest - 1), F.lit(0))
    near = lambda c: F.slice(c, first + 1, F.lit(2 * widest - 1))
    hits = hits.select("_id", "_key", "token", (F.col("_at") - first).alias("_at"), *(near(c).alias(c) for c in ("_words", "_lines")))
    pairs = hits.join(F.broadcast(prefix), "token").join(F.broadcast(full), "template")
    # From here on ``_at`` is the word's place in the template's own surroundings, ``_from`` where those begin.
    start = F.greatest(F.col("_at") - F.col("span") + 1, F.lit(0))
    own = F.slice("_words", start + 1, F.col("_at") - start + F.col("span"))
    pairs = pairs.withColumns({"_own": own, "_from": start, "_at": F.col("_at") - start})
    # Length filter, then positional filter: what stands around that word of it and of the later ones must be enough.
    # Blocks with an earlier word of the order are found around that word.
    rest = F.slice("tokens", F.array_position("tokens", F.col("token")).cast("int"), F.size("tokens"))
    pairs = pairs.where(F.size("_own") >= F.col("needed")).where(F.size(F.array_intersect(rest, "_own")) >= F.col("needed"))
    pairs = pairs.where(F.size(F.array_except("must", "_own")) == 0)
    starts = F.filter(F.sequence(F.lit(0), F.col("_at")), lambda i: F.array_contains("tokens", F.get("_own", i)))
    blocks = F.transform(starts, lambda i: F.struct(i.alias("i"), F.slice("_own", i + 1, F.col("span")).alias("w")))
    # A block goes on to the first word that ends it.
    stops = lambda w: F.array_min(F.filter(F.transform("ends", lambda t: F.array_position(w, t)), lambda p: p > 0))
    before = lambda w: F.slice(w, F.lit(1), F.coalesce(stops(w) - 1, F.size(w)).cast("int"))
    blocks = F.transform(blocks, lambda b: F.struct(b["i"].alias("i"), before(b["w"]).alias("w")))
    shared = F.transform(blocks, lambda b: F.struct(F.array_intersect("tokens", b["w"]).alias("has"), b["i"].alias("i"), b["w"].alias("w")))
    enough = F.filter(
        shared, lambda b: (F.size(b["has"]) >= F.col("needed")) & (F.size(F.array_except("must", b["has"])) == 0)
    )
    length = lambda b: F.array_max(F.transform(b["has"], lambda t: F.array_position(b["w"], t))).cast("int")
    best = F.array_max(
        F.transform(
            enough,
            lambda b: F.struct(F.size(b["has"]).alias("n"), (-length(b)).alias("less"), b["i"].alias("i"), b["has"][0].alias("leader")),
        )
    )
    found = pairs.withColumn("_best", best).where(F.col("_best").isNotNull())
    # A block comes with each of its prefix words; the first place of the first in the order speaks for it.
    block = F.slice("_own", F.col("_best.i") + 1, -F.col("_best.less"))
    leads = F.array_position(block, F.col("token")) == F.col("_at") - F.col("_best.i") + 1
    return found.where((F.col("_best.leader") == F.col("token")) & leads).select(
        "_id",
        "_key",
        F.get("_lines", F.col("_from") + F.col("_best.i")).alias("line"),
        F.array_join(block, " ").alias("block"),
        "template",
        "label",
        (F.col("_best.n") / F.size("tokens")).alias("containment"),
    )


def _places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    here = lambda i: reduce(Column.__and__, (F.get(words, i + k) == p for k, p in enumerate(parts)))
    last = F.size(words) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def base_notices(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES
) -> DataFrame:
    """Per row: ``_id``, ``_key``, ``n_words`` and ``places``, the word places of each phrase's label."""
    lower = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), row_key(F.col(text_col)).alias("_key"), lower.alias("_lower"))
    # Only texts that contain a phrase's last word are cut into words.
    ends = reduce(Column.__or__, (F.col("_lower").contains(p.split(" ")[-1]) for p in phrases))
    cut = rows.select(
        "_id",
        "_key",
        F.regexp_count("_lower", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(ends, words_of(F.col("_lower"))).alias("_words"),
    )
    named = [F.struct(F.lit(label).alias("label"), _places(F.col("_words"), p).alias("at")) for p, label in phrases.items()]
    none = F.array().cast("array<struct<label:string,at:array<int>>>")
    places = F.when(F.col("_words").isNotNull(), F.filter(F.array(*named), lambda x: F.size(x["at"]) > 0)).otherwise(none)
    return cut.select("_id", "_key", "n_words", places.alias("places"))
