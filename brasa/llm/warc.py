"""Content-addressed archive of web pages.

An archive is two tables.  ``payloads`` holds the bytes of every different payload once, under their SHA-256; ``headers``
holds each record's header exactly, with the digest of its payload.  Of the records with equal payloads the one with
the largest page_id is a response, the others are revisits that refer to it.  ``read_records`` reconstructs the original
records - header, payload, closing line breaks - by joining the two.

Digests are verified twice.  On writing, the payloads that fall under one SHA-256 must agree in length and in a second,
unrelated hash; on reading, the bytes must give the length and the SHA-1 that the record's header states.  Otherwise the
job fails.

Copies of a payload are reduced before the shuffle, and the join of headers to payloads is a plain one whose large
groups can be split, so a payload that a third of all records share meets in no one task.

Defined cases: null html is the empty payload, which is stored like any other; a null url is written as an empty one,
and line breaks in a url are percent-encoded, as a header line can't hold them.  A record with null page_id is a revisit if
any record of its payload has an id, else a response.  Rows that repeat the largest page_id of a payload are responses
all.  Payloads shorter than ``min_bytes`` have responses only.  An empty table gives empty archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.llm.common import table
from brasa.session import new_table_path

# The alphabets of base 32, that of the digests (RFC 4648) and that of Spark's conv()
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BREAK = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: five hex digits are four base-32 ones."""
    digest = F.sha1(payload)
    fives = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fives), CONV32, BASE32)


def _header(record_type: Column, page_id: Column, url: Column, n_bytes: Column, digest: Column,
            refers_to: Column) -> Column:
    """A record's header up to and with the blank line before its payload."""
    name = F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))
    target = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), record_type),
              F.concat(F.lit("WARC-Record-ID: "), name), F.concat(F.lit("WARC-Target-URI: "), target),
              F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
              F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">")),
              F.lit("Content-Type: text/html; charset=utf-8"),
              F.concat(F.lit("Content-Length: "), n_bytes.cast("string"))]
    return F.concat(F.concat_ws(BREAK, *fields), F.lit(BREAK + BREAK))


def write_archive(spark: SparkSession, pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                  html: str = "html", min_bytes: int = 0) -> None:
    """Write ``pages`` as the archive at ``path`` (tables ``payloads`` and ``headers``)."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    records = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                           payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    same = (F.min(F.octet_length("payload")) == F.max(F.octet_length("payload"))) & (
        F.min(F.xxhash64("payload")) == F.max(F.xxhash64("payload")))
    unique = records.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.first("payload").alias("payload"),
                                           same.alias("same"))
    checked = F.when(F.col("same"), F.col("payload")).otherwise(
        F.raise_error(F.lit("different payloads under one SHA-256")).cast("binary"))
    unique.select("digest", "response_id", checked.alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads")
    responses = spark.read.parquet(f"{path}/payloads").select("digest", "response_id")
    joined = records.select("page_id", "url", "digest", F.octet_length("payload").alias("n_bytes"),
                            base32_sha1(F.col("payload")).alias("sha1")).join(responses, "digest")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    headers = joined.select("digest", _header(
        F.when(revisit, "revisit").otherwise("response"), F.col("page_id"), F.col("url"), F.col("n_bytes"),
        F.col("sha1"), F.when(revisit, F.col("response_id"))).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: header and payload (binary), verified against the header."""
    headers, payloads = (spark.read.parquet(f"{path}/{t}") for t in ("headers", "payloads"))
    records = headers.join(payloads.select("digest", "payload"), "digest")
    right = (_field("Content-Length").cast("long") == F.octet_length("payload")) & (
        _field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))))
    return records.select("header", F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload does not match its record's header")).cast("binary")).alias("payload"))


def record_bytes(records: DataFrame) -> DataFrame:
    """Each record as the bytes of an archive file."""
    return records.select(F.concat(F.encode("header", "UTF-8"), F.col("payload"),
                                   F.lit((BREAK * 2).encode())).alias("record"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "llm-archive")
    write_archive(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    urn = r"^<urn:page:(-?\d+)>$"
    return read_records(spark, path).select(
        F.regexp_extract(_field("WARC-Record-ID"), urn, 1).try_cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), urn, 1).try_cast("long").alias("refers_to"))


ORACLE = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS body, unhex(sha1(coalesce(html, ''))) AS raw FROM pages
), bits AS (
    SELECT page_id, body, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST(substr(CAST(CAST(raw AS BIT) AS VARCHAR), 5 * CAST(i AS INT) + 1, 5) AS BIT)::BIT::INT, 1), ''
               ORDER BY i) FROM range(32) r(i)) AS digest
    FROM hashed
)
SELECT page_id, octet_length(encode(body)) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM bits WINDOW same AS (PARTITION BY body)
"""
