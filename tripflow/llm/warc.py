"""Content-addressed web archive: payload bytes stored once by SHA-256, exact record headers apart from them.

An archive is two tables below one folder: ``payloads`` (``digest``, ``payload``) and ``headers`` (``digest``,
``header``: the WARC header block and, before a response's payload, the HTTP header, byte for byte). Records are put
together again by a join. Of the records with an equal payload of at least ``min_bytes``, that of the smallest id is
the response and the others revisit it.

Only digests are shuffled to elect responses; payloads are combined by digest before their one shuffle, so a payload
that a third of all pages share moves once per task. The digest is verified twice: when stored (records under one
SHA-256 must agree in SHA-1 and length) and when read (both digests of the stored bytes are computed anew).

Defined results: a NULL payload is empty; rows that repeat id and payload are the same record twice, both responses or
both revisits; a NULL id is never the smallest unless all are NULL and stands as a name without an id; NULL URLs give an
empty target; line breaks in a URL or in an id of text are percent-encoded, so that a header stays one line, and ids are
read back as they were; an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# RFC 4648, by value of five bits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
ESCAPES = [("%", "%25"), ("\r", "%0D"), ("\n", "%0A")]
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hex digits are eight base32 digits."""
    digest = F.sha1(payload)
    parts = (F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31))
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _escaped(value: Column) -> Column:
    for plain, coded in ESCAPES:
        value = F.replace(value.cast("string"), F.lit(plain), F.lit(coded))
    return value


def _unescaped(value: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def _http(n: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n, F.lit("\r\n\r\n"))


def _header(record: str, refers: str, url: str, sha1: str, n: str, date: str) -> Column:
    """Exact bytes of a record up to its payload."""
    http = _http(F.col(n))
    line = lambda name, *value: F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))
    target = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "\r", "%0D"), "\n", "%0A")
    named = lambda c: F.concat(F.lit("<urn:record"), F.coalesce(F.concat(F.lit(":"), _escaped(F.col(c))), F.lit("")), F.lit(">"))
    response = F.col(refers).isNull() & ~F.col("_revisit")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", named(record)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col(sha1)),
        F.when(response, F.lit("")).otherwise(F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", named(refers)))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(response, F.col(n)).otherwise(F.lit(0))).cast("string")),
        F.lit("\r\n"),
        http,
    ).cast("binary")


def write_archive(
    spark: SparkSession,
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = DATE,
) -> None:
    """Write one record per row of ``pages`` to the archive at ``path``, a folder all executors share."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.sha2(payload, 256).alias("digest"),
        sha1_base32(payload).alias("_sha1"),
        F.octet_length(payload).cast("bigint").alias("_n"),
    )
    same = rows.groupBy("digest").agg(
        F.min("_id").alias("_first"),
        *(f(c).alias(f"_{k}{c}") for c in ("_sha1", "_n") for k, f in (("low", F.min), ("high", F.max))),
    )
    agree = (F.col("_low_sha1") == F.col("_high_sha1")) & (F.col("_low_n") == F.col("_high_n"))
    first = F.when(agree, F.col("_first")).otherwise(F.raise_error(F.lit("two payloads share a digest")))
    elected = same.select("digest", first.alias("_first"))
    revisit = (F.col("_n") >= min_bytes) & ~F.col("_id").eqNullSafe(F.col("_first"))
    records = rows.join(elected, "digest").select(
        "digest", "_id", "_url", "_sha1", "_n", revisit.alias("_revisit"), F.when(revisit, F.col("_first")).alias("_refers")
    )
    headers = records.select("digest", _header("_id", "_refers", "_url", "_sha1", "_n", date).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    payloads = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    once = payloads.groupBy("digest").agg(F.first("payload").alias("payload"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?md)^{name}: ([^\r\n]*)\r$", 1)


def _named(value: Column) -> Column:
    """The id in a record's name; a name without one, or a header that is missing, has none."""
    name = "(?s)^<urn:record:(.*)>$"
    return F.when(F.regexp_like(value, F.lit(name)), _unescaped(F.regexp_extract(value, name, 1)))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Records by their headers: ``digest``, ``header``, ``record``, ``record_type``, ``sha1``, ``refers``, ``url``."""
    table = spark.read.schema("digest string, header binary").parquet(f"{path}/headers")
    # The WARC header ends at the first empty line; what follows is the HTTP header.
    text = F.substring_index(F.decode("header", "UTF-8"), "\r\n\r\n", 1)
    head = F.concat(text, F.lit("\r\n"))
    return table.select("digest", "header", head.alias("_head")).select(
        "digest",
        "header",
        _named(_field(F.col("_head"), "WARC-Record-ID")).alias("record"),
        _field(F.col("_head"), "WARC-Type").alias("record_type"),
        F.regexp_replace(_field(F.col("_head"), "WARC-Payload-Digest"), "^sha1:", "").alias("sha1"),
        _named(_field(F.col("_head"), "WARC-Refers-To")).alias("refers"),
        _field(F.col("_head"), "WARC-Target-URI").alias("url"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their digests computed anew; bytes that do not fit their key fail the read."""
    table = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    fits = F.sha2("payload", 256) == F.col("digest")
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    return table.select(
        F.when(fits, F.col("digest")).otherwise(wrong).alias("digest"),
        "payload",
        sha1_base32(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record with the payload it holds or revisits, joined by digest."""
    joined = read_headers(spark, path).join(read_payloads(spark, path), "digest")
    wrong = F.raise_error(F.concat(F.lit("header and payload differ in record "), F.col("record")))
    checked = F.when(F.col("sha1") == F.col("payload_digest"), F.col("payload_digest")).otherwise(wrong)
    return joined.withColumn("payload_digest", checked)


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` and ``warc``: each record as it stands in a WARC file, headers, block and closing line breaks; and the
    ``digest`` columns of the payload it holds or revisits."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_archive(spark, path).select(
        "record", "payload_digest", "payload_bytes", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("warc")
    )


def read_records(records: DataFrame) -> DataFrame:
    """Records parsed from their bytes: ``record_type``, ``refers`` and ``url`` beside the columns of ``original_records``.

    A record whose id, length, block or payload differs from what its archive says fails the read.
    """
    end = "\r\n\r\n"
    # Bytes as they are: the payload need not be text.
    head = F.substring_index(F.col("warc").cast("string"), end, 1)
    parsed = records.withColumn("_head", F.concat(head, F.lit("\r\n"))).select(
        "*",
        _named(_field(F.col("_head"), "WARC-Record-ID")).alias("_record"),
        _field(F.col("_head"), "WARC-Type").alias("record_type"),
        _named(_field(F.col("_head"), "WARC-Refers-To")).alias("refers"),
        _field(F.col("_head"), "WARC-Target-URI").alias("url"),
        F.regexp_replace(_field(F.col("_head"), "WARC-Payload-Digest"), "^sha1:", "").alias("_sha1"),
        _field(F.col("_head"), "Content-Length").cast("bigint").alias("_length"),
    )
    start = F.octet_length("_head") + 2
    block = F.substring("warc", start + 1, F.col("_length").cast("int"))
    http = F.substring_index(block.cast("string"), end, 1)
    payload = F.substring(block, F.octet_length(http) + len(end) + 1, F.col("_length").cast("int"))
    whole = (F.octet_length("warc") == start + F.col("_length") + len(end)) & (F.substring("warc", -len(end), len(end)) == end.encode())
    alike = F.col("record").eqNullSafe(F.col("_record")) & (F.col("_sha1") == F.col("payload_digest"))
    response = F.col("record_type") == "response"
    held = F.when(response, sha1_base32(payload) == F.col("_sha1")).otherwise(F.octet_length(payload) == 0)
    wrong = F.raise_error(F.concat(F.lit("record does not read back: "), F.coalesce("record", F.lit("without an id"))))
    fits = F.when(whole & alike & held, F.col("record_type")).otherwise(wrong)
    return parsed.withColumn("record_type", fits).drop("_head", "_record", "_sha1", "_length")
