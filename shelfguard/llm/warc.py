"""Content-addressed WARC archive: payloads stored once, headers apart.

Writing. A page's payload (its html in UTF-8) is addressed by its SHA-256. Payloads
of one address meet in a grouping that keeps one copy, compressed, and the smallest
page_id, its owner: map-side combination leaves one copy per task of a payload that a third
of all pages share. The store is a Parquet table (address, owner, size, gzip member).
Exact record headers are a second table: the owner's record is a ``response``, every
other a ``revisit`` that refers to it (WARC 1.1, identical-payload-digest).

Reading. Records are rebuilt by joining headers with payloads on the address, and
concatenated: header, payload (none for a revisit), two line ends. A payload travels to its own response only; a revisit
gets the length and digest of what it refers to. Every payload read is hashed again: its SHA-256 must be its address,
its SHA-1 what the header says, and the header's Content-Length the bytes that stand in the record;
otherwise the read fails.

Defined results: a null html is the empty payload; equal payloads of any length, the
empty one included, are stored once; a null url gives an empty WARC-Target-URI, and line ends in a url are
left out of its header (they would end the field). Rows that repeat
the owner's page_id and payload are that response again. Rows without page_id are
responses only if no page with an id has their payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches
from shelfguard.session import scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records carry the crawl's date; the tables have none, so it is a parameter.
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payloads(pages: DataFrame) -> DataFrame:
    """pages with address, payload_digest, payload_bytes and the gzip member."""
    result = T.StructType(
        [
            T.StructField("address", T.BinaryType()),
            T.StructField("payload_digest", T.StringType()),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("member", T.BinaryType()),
        ]
    )

    @F.pandas_udf(result)
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [x.encode("utf-8") if isinstance(x, str) else b"" for x in batch]
            yield pd.DataFrame(
                {
                    "address": [hashlib.sha256(x).digest() for x in raw],
                    "payload_digest": [sha1_base32(x) for x in raw],
                    "payload_bytes": [len(x) for x in raw],
                    # mtime 0: the same payload always gives the same bytes
                    "member": [gzip.compress(x, 6, mtime=0) for x in raw],
                }
            )

    return in_small_batches(pages).withColumn("_p", hashed(F.col("html"))).select("page_id", "url", "_p.*")


def write_archive(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write the archive of ``pages`` (page_id, url, html) under ``path``: payloads/ and headers/."""
    spark = pages.sparkSession
    rows = _payloads(pages)
    # Smallest page_id first; rows without one last. One copy of the member travels with it.
    own = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "payload_digest", "payload_bytes", "member"))
    store = rows.groupBy("address").agg(own.alias("o"))
    store = store.select("address", F.col("o.page_id").alias("owner"), "o.payload_digest", "o.payload_bytes", "o.member")
    store.write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/payloads")

    owners = spark.read.parquet(f"{path}/payloads").select("address", "owner", "payload_digest", "payload_bytes")
    # Only hashes of the pages are needed here: nothing but ids, urls and addresses is shuffled.
    address = F.unhex(F.sha2(F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")), 256))
    heads = pages.select("page_id", "url", address.alias("address")).join(owners, "address")
    heads = heads.withColumn("owns", F.col("page_id").eqNullSafe(F.col("owner")))
    record_id = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("owns"), F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", record_id),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(
            ~F.col("owns"),
            F.concat(
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("owner").cast("string"), F.lit("none")), F.lit(">"))),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(F.col("owns"), F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit("\r\n"),
    )
    heads.select("page_id", "address", header.alias("header")).write.mode("overwrite").parquet(f"{path}/headers")


def parse_header(header: str) -> dict[str, str]:
    lines = header.split("\r\n")
    return {"version": lines[0]} | dict(x.split(": ", 1) for x in lines[1:] if x)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Headers as written, with the fields read back from their text."""
    heads = spark.read.parquet(f"{path}/headers")
    refers = F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?[0-9]+)>\r\n", 1)
    return heads.select(
        "page_id", "address", "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n", 1).alias("payload_digest"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
        _field("Content-Length").cast("long").alias("content_length"),
    )


def _unpacked(stored: DataFrame, bytes_too: bool) -> DataFrame:
    """``stored`` (address, member, more) with the payload unpacked and verified against its address."""
    fields = [T.StructField("payload_bytes", T.LongType()), T.StructField("stored_digest", T.StringType())]
    if bytes_too:
        fields.append(T.StructField("payload", T.BinaryType()))

    @F.pandas_udf(T.StructType(fields))
    def unpack(address: pd.Series, member: pd.Series) -> pd.DataFrame:
        raw = []
        for a, m in zip(address, member, strict=True):
            try:
                x = gzip.decompress(m)
            except (OSError, EOFError, zlib.error) as e:
                raise ValueError(f"payload {a.hex()} can't be unpacked") from e
            if hashlib.sha256(x).digest() != a:
                raise ValueError(f"payload {a.hex()} has other content than its address says")
            raw.append(x)
        out = {"payload_bytes": [len(x) for x in raw], "stored_digest": [sha1_base32(x) for x in raw]}
        return pd.DataFrame(out | ({"payload": raw} if bytes_too else {}))

    more = [c for c in stored.columns if c != "member"]
    return in_small_batches(stored).withColumn("_p", unpack("address", "member")).select(*more, "_p.*")


def _checked(good: Column, value: Column, message: str) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.lit(message)))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record: page_id, its header's fields, ``payload_bytes`` (of the full payload) and ``record``, its exact bytes."""
    heads = read_headers(spark, path)
    store = spark.read.parquet(f"{path}/payloads").select("address", "member")
    # Joined while packed, and with responses only: a payload travels once, however often it is revisited.
    responses = _unpacked(heads.where("record_type = 'response'").join(store, "address"), bytes_too=True)
    revisits = heads.where("record_type <> 'response'").join(_unpacked(store, bytes_too=False), "address")
    out = responses.unionByName(revisits.withColumn("payload", F.lit(b"")))
    digest = _checked(F.col("payload_digest") == F.col("stored_digest"), F.col("payload_digest"), "a header's digest differs from its payload's")
    length = F.octet_length("payload") == F.col("content_length")
    body = _checked(F.coalesce(length, F.lit(False)), F.col("payload"), "a header's Content-Length differs from its record's")
    record = F.concat(F.encode("header", "UTF-8"), body, F.lit(b"\r\n\r\n"))
    return out.withColumn("payload_digest", digest).withColumn("record", record).drop("stored_digest", "payload", "content_length")


def op8_warc(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages.select("page_id", "url", "html"), path)
    return read_records(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.sha2("record", 256).alias("record_sha256"),
    )


#: Base32 by groups of five hex digits (20 bits, four characters).
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {5 * g + 1}, 5) AS INTEGER) >> {shift}) & 31) + 1, 1)"
    for g in range(8) for shift in (15, 10, 5, 0)
)
SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
o AS (SELECT payload, min(page_id) AS owner FROM p GROUP BY payload),
r AS (
  SELECT page_id, url, payload, {_BASE32} AS payload_digest, CASE WHEN page_id <> owner THEN owner END AS refers_to FROM p JOIN o USING (payload))
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       sha256(array_to_string([
         'WARC/1.1', 'WARC-Type: ' || CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END, 'WARC-Record-ID: <urn:page:' || page_id || '>',
         'WARC-Date: {DATE}', 'WARC-Target-URI: ' || replace(replace(coalesce(url, ''), chr(13), ''), chr(10), ''), 'WARC-Payload-Digest: sha1:' || payload_digest]
         || CASE WHEN refers_to IS NULL THEN []::VARCHAR[] ELSE ['WARC-Refers-To: <urn:page:' || refers_to || '>', 'WARC-Profile: {PROFILE}'] END
         || ['Content-Type: text/html; charset=utf-8', 'Content-Length: ' || CASE WHEN refers_to IS NULL THEN strlen(payload) ELSE 0 END,
             '', CASE WHEN refers_to IS NULL THEN payload ELSE '' END, '', ''], chr(13) || chr(10))) AS record_sha256
FROM r
"""
