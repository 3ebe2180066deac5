"""Content-addressed web archive.

``headers``: one row per record with its exact header bytes. ``payloads``: the
bytes of every distinct payload once, under its SHA-256. Records are rebuilt by
joining the two on the digest. A payload table is verified on writing (a second
hash and the length agree for all rows of a digest, the stored bytes hash to
their key).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads shorter than this are stored by digest too, but always written as a
#: full response: a revisit record would be longer than what it saves.
MIN_REVISIT_BYTES = 100

#: Fixed lines of the WARC/1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


@dataclass(frozen=True)
class Archive:
    headers: str
    payloads: str


def _record_id(page: Column) -> Column:
    """A name-based id: the md5 of the page id, laid out as a UUID."""
    h = F.md5(F.coalesce(page.cast("string"), F.lit("null")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = "1970-01-01T00:00:00Z",
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> Archive:
    """Write one record per row of ``pages`` below ``path``.

    Of records with equal payloads of at least ``min_revisit_bytes`` the one with
    the smallest id is the response, others are revisits of it; shorter payloads
    are all responses. Null payloads are empty, null urls an empty target. Rows
    repeated with the smallest id are all responses. A null id never is the
    smallest unless all are null. Extra columns are not archived.
    """
    raw = F.coalesce(F.col(payload_col), F.lit(""))
    src = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                       (raw if dict(pages.dtypes)[payload_col] == "binary" else F.encode(raw, "UTF-8"))
                       .cast("binary").alias("payload"))
    src = src.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint"))
    slim = src.select("page_id", "url", "digest", "payload_bytes", F.xxhash64("payload").alias("second"))
    by_digest = slim.groupBy("digest").agg(
        F.min("page_id").alias("first_id"),
        ((F.min("second") == F.max("second"))
         & (F.min("payload_bytes") == F.max("payload_bytes"))).alias("same"))
    rec = slim.join(by_digest, "digest")
    revisit = ((F.col("payload_bytes") >= min_revisit_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    rec = rec.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "%0A")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.when(F.col("record_type") == "revisit",
               F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first_id")))),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("X-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))),
        F.when(F.col("record_type") == "revisit",
               F.concat(F.lit("X-Refers-To-Page: "), F.coalesce(F.col("first_id").cast("string"), F.lit("null")))),
        F.concat(F.lit("Content-Length: "),
                 F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    out = Archive(os.path.join(path, "headers"), os.path.join(path, "payloads"))
    guard = F.when(F.col("same"), F.encode(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF)), "UTF-8")) \
        .otherwise(F.raise_error(F.concat(F.lit("two payloads share digest "), F.col("digest"))))
    rec.select("digest", guard.alias("header")).write.mode("overwrite").parquet(out.headers)
    stored = src.select("digest", "payload").dropDuplicates(["digest"])
    stored.write.mode("overwrite").parquet(out.payloads)
    return out


def read_records(spark: SparkSession, archive: Archive, verify: bool = True) -> DataFrame:
    """``header, payload, record, digest``: every record rebuilt by a join on the
    digest. ``payload`` is the full payload, also of revisits; ``record`` is the
    original record (header, block, closing line ends), where a revisit has no
    block. With ``verify`` a stored payload that does not hash to its key fails."""
    head = spark.read.parquet(archive.headers)
    body = spark.read.parquet(archive.payloads)
    if verify:
        body = body.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
                               .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))))
    both = head.join(body, "digest")
    block = F.when(field(F.decode("header", "UTF-8"), "WARC-Type") == "response", F.col("payload")) \
        .otherwise(F.lit(b""))
    return both.select("header", "payload", "digest",
                       F.concat("header", block, F.lit((CRLF + CRLF).encode())).alias("record"))


def field(header: Column, name: str) -> Column:
    """A header field's value, null where it is absent."""
    got = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"\r\n{name}: ")), got)


def read_pages(spark: SparkSession, archive: Archive) -> DataFrame:
    """``page_id, url, payload, record_type, refers_to`` parsed from the rebuilt records."""
    rec = read_records(spark, archive)
    cut = F.instr(F.decode("record", "ISO-8859-1"), F.lit(CRLF + CRLF))
    rec = rec.withColumn("h", F.decode(F.substring("record", F.lit(1), cut + F.lit(3)), "UTF-8"))
    block = F.expr("substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - 4)")
    kind = field(F.col("h"), "WARC-Type")
    number = lambda c: F.when(c != "null", c).cast("bigint")
    return rec.select(number(field(F.col("h"), "X-Page-ID")).alias("page_id"),
                      field(F.col("h"), "WARC-Target-URI").alias("url"),
                      F.when(kind == "response", block).otherwise(F.col("payload")).alias("payload"),
                      kind.alias("record_type"), number(field(F.col("h"), "X-Refers-To-Page")).alias("refers_to"))


def export_warc(spark: SparkSession, archive: Archive, path: str) -> None:
    """Write the rebuilt records as plain WARC files (payloads must be UTF-8): the
    text writer ends each record with the two line ends the format asks for."""
    rec = read_records(spark, archive)
    text = F.decode(F.expr("substring(record, 1, octet_length(record) - 4)"), "UTF-8")
    rec.select(text.alias("value")).write.mode("overwrite").option("lineSep", CRLF + CRLF).text(path)
