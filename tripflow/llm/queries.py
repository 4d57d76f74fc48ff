"""The training-data operators bound to the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import bpe, common, decontaminate, language, licenses, lines, merkle, quality, simhash, token_counts, toxicity, trie, urls, warc
from tripflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The tokenizer's files are installed beside the interpreter; their place is a parameter of the operator.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- 1 -----------------------------------------------------------------------------------

# DuckDB: SHA-1 in hex to base32, ten hex digits (40 bits) to eight digits at a time.
_BASE32 = """
list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(((('0x' || substr(h, CAST(i // 8 * 10 + 1 AS INT), 10))::BIGINT >> CAST((7 - i % 8) * 5 AS INT)) & 31) + 1 AS INT), 1)),
  'string_agg', '')"""


# The record as it stands in a WARC file, line by line.
_RECORD = f"""
concat_ws(chr(13) || chr(10), 'WARC/1.1', 'WARC-Type: ' || record_type, 'WARC-Record-ID: <urn:record:' || page_id || '>',
  'WARC-Date: {warc.DATE}', 'WARC-Target-URI: ' || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A'),
  'WARC-Payload-Digest: sha1:' || payload_digest,
  CASE WHEN refers_to IS NOT NULL THEN concat_ws(chr(13) || chr(10), 'WARC-Profile: {warc.PROFILE}', 'WARC-Refers-To: <urn:record:' || refers_to || '>') END,
  'Content-Type: application/http; msgtype=response',
  'Content-Length: ' || (strlen(http) + CASE WHEN refers_to IS NULL THEN payload_bytes ELSE 0 END), '', http)
  || CASE WHEN refers_to IS NULL THEN payload ELSE '' END || repeat(chr(13) || chr(10), 2)"""


@_query(
    "op1_warc",
    f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
m AS (SELECT *, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
r AS (SELECT page_id, url, payload, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
    concat_ws(chr(13) || chr(10), 'HTTP/1.1 200 OK', 'Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(payload), '', '') AS http
  FROM m),
w AS (SELECT *, {_RECORD} AS record FROM r)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, CAST(strlen(record) AS BIGINT) AS record_bytes,
  sha256(record) AS record_sha256
FROM w""",
)
def op1(spark, d):
    pages = _table(spark, d, "pages")
    path = scratch_path(spark, "archive")
    warc.write_archive(spark, pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_records(warc.original_records(spark, path)).select(
        F.col("record").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast(kind).alias("refers_to"),
        F.octet_length("warc").cast("bigint").alias("record_bytes"),
        F.sha2("warc", 256).alias("record_sha256"),
    )


# --- 2 -----------------------------------------------------------------------------------


def _contract2(found: DataFrame) -> DataFrame:
    hit = decontaminate.covered(F.col("spans"))
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("items_sha256"),
        F.size("near").cast("bigint").alias("n_near"),
    ).withColumn("contaminated", decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@_query(
    "op2_decontaminate",
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
spots AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, i, n FROM spots JOIN g USING (n, phrase)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
sets AS (SELECT phrase, list_distinct(string_split(phrase, ' ')) AS need FROM (SELECT DISTINCT phrase FROM g)),
holds AS (SELECT doc_id, phrase FROM (SELECT DISTINCT doc_id, unnest(w) AS word FROM d)
  JOIN (SELECT phrase, len(need) AS k, unnest(need) AS word FROM sets) USING (word) GROUP BY doc_id, phrase, k HAVING count(*) = k),
places AS (SELECT doc_id, phrase, need, w, unnest(range(1, len(w) + 1)) AS i FROM holds JOIN sets USING (phrase) JOIN d USING (doc_id)),
near AS (SELECT DISTINCT doc_id, phrase FROM places WHERE list_contains(need, w[i]) AND list_has_all(w[i : i + {decontaminate.NEAR_SPAN - 1}], need)),
nears AS (SELECT doc_id, count(*) AS n_near
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM near JOIN g USING (phrase)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN nears USING (doc_id)""",
)
def op2(spark, d):
    docs, items = _table(spark, d, "documents"), _table(spark, d, "benchmark")
    return _contract2(decontaminate.contamination(spark, docs, items, near_span=decontaminate.NEAR_SPAN))


# --- 3 -----------------------------------------------------------------------------------


@_query("op3_simhash")
def op3(spark, d):
    found = simhash.near_duplicates(spark, _table(spark, d, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- 4 -----------------------------------------------------------------------------------


def held_out_language():
    return common.in_bucket(F.col("doc_id"), 3, 1)


def learnable_language():
    return F.col("doc_id").isNotNull() & ~held_out_language()


@_query("op4_language")
def op4(spark, d):
    docs = _table(spark, d, "documents")
    model = language.learn(docs, learnable_language())
    found = language.identify(spark, docs, model)
    return found.withColumnRenamed("_id", "doc_id").select(
        "doc_id", held_out_language().alias("held_out"), "lang_pred", "score", "rejected"
    )


# --- 5 -----------------------------------------------------------------------------------


@_query(
    "op5_lines",
    r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, source, l, list_transform(l, lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS t FROM d),
totals AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
counts AS (SELECT source, line, count(*) AS n
  FROM (SELECT source, unnest(list_distinct(t)) AS line FROM p) WHERE line <> '' GROUP BY source, line),
over AS (SELECT source, line FROM counts JOIN totals USING (source) WHERE n >= 3 AND n > 0.1::DOUBLE * pages),
e AS (SELECT doc_id, source, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS raw, unnest(t) AS line FROM p),
k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (o.line IS NOT NULL) AS n_dropped,
  coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (o.line IS NULL), '') AS text
  FROM e LEFT JOIN over o ON e.source IS NOT DISTINCT FROM o.source AND e.line = o.line GROUP BY doc_id)
SELECT doc_id, source, n_lines, n_dropped, k.text AS text FROM documents JOIN k USING (doc_id)""",
)
def op5(spark, d):
    found = lines.without_boilerplate(spark, _table(spark, d, "documents"))
    return found.select("doc.doc_id", "doc.source", "n_lines", "n_dropped", "text")


# --- 6 -----------------------------------------------------------------------------------


@_query("op6_bpe")
def op6(spark, d):
    return bpe.digests(spark, _table(spark, d, "documents"), RANKS, public_tokenizers.PATTERN)


# --- 7 -----------------------------------------------------------------------------------


@_query("op7_toxicity")
def op7(spark, d):
    docs, labels = _table(spark, d, "documents"), _table(spark, d, "labels")
    held_out = common.in_bucket(F.col("doc_id"), 5, 0)
    model = toxicity.learn(spark, docs, labels, F.col("doc_id").isNotNull() & ~held_out)
    found = toxicity.score(spark, docs, model).withColumnRenamed("_id", "doc_id")
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "p_value", "passages"
    )


# --- 8 -----------------------------------------------------------------------------------


@_query("op8_licenses")
def op8(spark, d):
    docs = _table(spark, d, "documents")
    found = licenses.find_notices(spark, docs)
    noticed = found.groupBy("_id", "_key").agg(
        F.collect_set("label").alias("_found"), F.max("containment").alias("_best")
    )
    base = licenses.base_notices(docs)
    same = base["_id"].eqNullSafe(noticed["_id"]) & (base["_key"] == noticed["_key"])
    at = F.flatten(F.transform("places", lambda p: p["at"]))
    labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_distinct(F.concat(labels, F.coalesce("_found", F.array().cast("array<string>")))))
    return base.join(noticed, same, "left").select(
        base["_id"].alias("doc_id"),
        "n_words",
        F.size(at).cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size(at) > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )


# --- 9 -----------------------------------------------------------------------------------

# The rules of the contract, as (host, path, verdict).
BASE_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_EDGE, _END = "(^|[^a-z0-9])", "([^a-z0-9]|$)"
# The method's own rules: words that mark gambling, adult and trial-software sites, and file types that hold no text.
BLOCKED_WORDS = "bets betting casino gambling jackpot poker porn sex viagra warez xxx".split()
BLOCKED_TYPES = "exe zip gz mp4 mp3 iso apk".split()
RULES = [
    *(urls.prefix_rule(*rule) for rule in BASE_RULES),
    *(urls.pattern_rule(f"word:{w}", "block", f"(?i){_EDGE}{w}{_END}", [w]) for w in BLOCKED_WORDS),
    *(urls.pattern_rule(f"type:{t}", "block", f"(?i)/[^/]*\\.{t}$", [t]) for t in BLOCKED_TYPES),
]
_REGEX_ROWS = ", ".join(f"('{name}', '{verdict}', {rank}, '{pattern}')" for name, verdict, rank, pattern, _ in RULES).replace("\\/", "/")


@_query(
    "op9_urls",
    f"""
WITH r(rule, verdict, rank, pattern) AS (VALUES {_REGEX_ROWS}),
p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT page_id, arg_max({{'rule': rule, 'verdict': verdict, 'rank': rank}}, {{'a': rank, 'b': length(rule), 'c': rule}}) AS best
  FROM p JOIN r ON regexp_matches(host || path, pattern) GROUP BY page_id)
SELECT page_id, host, path, CASE WHEN best.rank = 1 THEN best.rule END AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (page_id)""",
)
def op9(spark, d):
    found = urls.filter_urls(_table(spark, d, "pages"), urls.rules_table(spark, RULES))
    return found.select("page.page_id", "host", "path", F.when(F.col("rank") == 1, F.col("rule")).alias("rule"), "verdict")


# --- 10 ----------------------------------------------------------------------------------


@_query("op10_quality")
def op10(spark, d):
    found = quality.judge(spark, _table(spark, d, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"),
        "posterior",
        "votes",
    )


# --- 11 ----------------------------------------------------------------------------------

# DuckDB: unsigned CRC-32 of a number's decimal digits, bit by bit.
def _crc32(number: str) -> str:
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    bits = f"list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {step})"
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {bits}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', n_chars, 'text']))})"


@_query(
    "op11_merkle",
    f"""
WITH RECURSIVE
leaves AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_crc32("doc_id")} % 7 = 0 THEN {_leaf_sql("CAST(n_chars AS HUGEINT) + 1")} END AS claim FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
tree AS (SELECT lang, 0 AS level, idx, n, leaf AS h FROM ranked
  UNION ALL SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
    FROM tree WHERE n > 1 GROUP BY lang, level, idx // 2, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (SELECT 0 AS level, idx, n, subroot AS h FROM subroots
  UNION ALL SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
heights AS (SELECT lang, max(level) AS height FROM tree GROUP BY lang),
steps AS (
  SELECT r.doc_id, r.lang, r.leaf, t.level, (r.idx >> t.level) & 1 AS is_right, s.h AS sibling
  FROM ranked r JOIN (SELECT DISTINCT lang, level FROM tree WHERE n > 1) t ON t.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM r.lang AND s.level = t.level AND s.idx = xor(r.idx >> t.level, 1)
  UNION ALL
  SELECT r.doc_id, r.lang, r.leaf, h.height + t.level, (g.idx >> t.level) & 1, s.h
  FROM ranked r JOIN heights h ON h.lang IS NOT DISTINCT FROM r.lang JOIN subroots g ON g.lang IS NOT DISTINCT FROM r.lang
  CROSS JOIN (SELECT DISTINCT level FROM top WHERE n > 1) t
  LEFT JOIN top s ON s.level = t.level AND s.idx = xor(g.idx >> t.level, 1)),
listed AS (SELECT doc_id, lang, leaf, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256,
  list({{'r': is_right, 's': sibling}} ORDER BY level) AS path FROM steps GROUP BY doc_id, lang, leaf),
folding AS (SELECT r.doc_id, r.lang, r.leaf, coalesce(claim, r.leaf) AS h, 1 AS step, path, proof_sha256
  FROM ranked r LEFT JOIN listed l ON r.doc_id IS NOT DISTINCT FROM l.doc_id AND r.lang IS NOT DISTINCT FROM l.lang AND r.leaf = l.leaf
  UNION ALL SELECT doc_id, lang, leaf, sha256(CASE WHEN path[step].s IS NULL THEN h WHEN path[step].r = 1 THEN path[step].s || h
    ELSE h || path[step].s END), step + 1, path, proof_sha256 FROM folding WHERE step <= coalesce(len(path), 0))
SELECT f.doc_id, f.leaf, g.subroot, t.h AS root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root,
  f.h = t.h AS verified
FROM folding f JOIN subroots g ON g.lang IS NOT DISTINCT FROM f.lang CROSS JOIN (SELECT h FROM top WHERE n = 1) t
WHERE f.step > coalesce(len(f.path), 0)""",
)
def op11(spark, d):
    docs = _table(spark, d, "documents")
    hashed = lambda n_chars: merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang")), n_chars, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claim = F.when(tampered, hashed(F.col("n_chars").cast("decimal(38,0)") + 1))
    leaves = docs.select(
        F.col("lang").alias("_group"), F.col("doc_id").alias("_id"), hashed(F.col("n_chars")).alias("_leaf"), claim.alias("_claim")
    )
    found = merkle.verify(merkle.proofs(spark, merkle.build(spark, leaves)))
    shown = lambda c: F.lower(F.hex(c))
    return found.select(
        F.col("_id").alias("doc_id"),
        shown("_leaf").alias("leaf"),
        shown("_subroot").alias("subroot"),
        shown("_root").alias("root"),
        shown("_siblings").alias("proof_sha256"),
        shown("_folded").alias("folded_root"),
        (F.col("_folded") == F.col("_root")).alias("verified"),
    )


# --- 12 ----------------------------------------------------------------------------------

COUNTED = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


@_query("op12_token_counts")
def op12(spark, d):
    found = token_counts.count_prefixes(spark, _table(spark, d, "documents"), COUNTED)
    counts = F.col("counts")
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_bytes",
        token_counts.n_tokens(counts).alias("n_tokens"),
        (token_counts.n_tokens(counts) > TOKEN_LIMIT).alias("over_limit"),
        token_counts.longest_prefix(counts, TOKEN_LIMIT).alias("chars_within_limit"),
    )


# --- 13 ----------------------------------------------------------------------------------


@_query(
    "op13_prefix_trie",
    f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS l FROM t GROUP BY conv_id),
h AS (SELECT conv_id, l, {_crc32("conv_id")} % 9 AS h FROM c),
b AS (SELECT h.conv_id, list_concat(coalesce(o.l, [])[1 : h.h], h.l[h.h + 1 :]) AS l
  FROM h LEFT JOIN c o ON o.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, len(l) AS size, d, l[1 : d] AS prefix, CASE WHEN d > 0 THEN strlen(l[d].t) ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(len(l) + 1)) AS d FROM b)),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends FROM p GROUP BY prefix, d),
k AS (SELECT a.*, m.conv_id AS parent_conv_id, (SELECT count(*) FROM n c WHERE c.d = a.d + 1 AND c.prefix[1 : a.d] = a.prefix) AS n_children
  FROM n a LEFT JOIN n m ON m.d = a.d - 1 AND m.prefix = a.prefix[1 : a.d - 1]),
up AS (SELECT k.*, unnest(range(d + 1)) AS u FROM k),
s AS (SELECT prefix[1 : u] AS prefix, u AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM up GROUP BY prefix[1 : u], u)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(ends) AS ends_sha256
FROM k JOIN s USING (prefix, d)""",
)
def op13(spark, d):
    opening = F.crc32(F.col("conv_id").cast("string")) % 9
    rebuilt = common.stored(spark, trie.rebuild(spark, _table(spark, d, "conversations"), opening), "rebuilt")
    return trie.prefix_nodes(spark, trie.sequences(spark, rebuilt))
