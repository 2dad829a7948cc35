"""WARC archives written and read as a chunked record table.

An oversized payload is never one value of the archive: it is cut into
segments (a ``response`` record and its ``continuation`` records), so every
row that is written or read is one record identifier, one segment number and
at most ``SEGMENT`` bytes. Archives are plain WARC 1.1 text made by Spark's
text writer and read in splits with the record's first line as separator. A
segment never holds that line, nor completes it with the bytes around it:
payloads are also cut inside each ``WARC/1.1``. Readers stream the segments of
a record in order, carrying the SHA-1 and the length, and check both against
the header; the writer hashes and cuts a payload as the one value it is in the
table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import map_batches, scratch_dir, written
from tessera.operators.joins import checked_broadcast

SEGMENT = 1 << 16
#: Digests, some 60 bytes each, that may be broadcast.
FEW = 100_000
SEPARATOR = "\r\n\r\nWARC/1.1\r\n"
#: The alphabet of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
#: The separator without its first three bytes: no beginning of it recurs inside it. Hadoop's reader, at the edge of its
#: buffer, misses a separator that begins inside a false start, as after a payload that ends in a line end.
READ_SEPARATOR = SEPARATOR[3:]


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 20 bits (five hex digits) give four letters."""
    digest = F.sha1(data)
    letters = []
    for i in range(8):
        part = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(part, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def classified(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)`` of every page.

    Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the smallest page_id is the response. The minimum is a partial
    aggregate over digests; only digests of more than one row are
    joined back, to pages that stay where they are while those digests are
    few enough to be broadcast. Beyond that, a payload of very many pages is a
    skewed join that AQE splits.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        base32_sha1(F.encode(html, "UTF-8")).alias("payload_digest"))
    first = (base.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages")).where("pages > 1").drop("pages"))
    first = checked_broadcast(written(first, "digests"), FEW)
    revisit = F.coalesce(F.col("first") < F.col("page_id"), F.col("first").isNotNull() & F.col("page_id").isNull())
    return (base.join(first, ["payload_digest", "payload_bytes"], "left")
            .select("page_id", "url", "html", "payload_bytes", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first")).alias("refers_to")))


def segments(records: DataFrame) -> DataFrame:
    """Chunked record table ``(row, page_id, ..., segment, data)``: payloads in pieces of at most ``SEGMENT`` bytes.

    A revisit and an empty payload have one segment without data.
    """
    stored = F.when(F.col("record_type") == "revisit", "").otherwise(F.col("html"))
    cut = (records.withColumn("row", F.monotonically_increasing_id())
           .select("row", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
                   F.posexplode(F.split(stored, r"(?<=WA)(?=RC/1\.1)")).alias("piece", "text")))
    data = cut.withColumn("bytes", F.encode("text", "UTF-8")).drop("text")
    last = F.greatest(F.ceil(F.octet_length("bytes") / SEGMENT) - 1, F.lit(0)).cast("int")
    return data.select("*", F.explode(F.sequence(F.lit(0), last)).alias("part")).select(
        "row", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "piece", "part",
        F.expr(f"substring(bytes, part * {SEGMENT} + 1, {SEGMENT})").alias("data"))


def write_archives(records: DataFrame, path: str) -> None:
    """Archives below ``path``, one per task; each text row is one WARC record, its line end the second CRLF."""
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when((F.col("piece") == 0) & (F.col("part") == 0), F.col("record_type")).otherwise("continuation"),
        F.lit("\r\nWARC-Record-ID: <urn:record:"), F.col("row"), F.lit(":"), F.col("piece"), F.lit(":"), F.col("part"),
        F.lit(">\r\nWARC-Segment-Origin-ID: <urn:record:"), F.col("row"),
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes"),
        F.lit("\r\nX-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nX-Refers-To-Page: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length("data"), F.lit(END))
    (segments(records).select(F.concat(head, F.col("data").cast("string"), F.lit("\r\n")).alias("value"))
     .write.option("lineSep", "\r\n").text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Chunked record table of the archives: ``(record, piece, part, warc_type, page_id, refers_to, ..., data)``."""
    raw = spark.read.schema("value string").option("lineSep", READ_SEPARATOR).text(path)
    at = F.instr("value", END)
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: (.*?)\r?$", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    rows = raw.select(F.col("value").substr(F.lit(1), at).alias("head"), F.col("value").cast("binary").alias("bytes")).select(
        field("WARC-Type").alias("warc_type"), field("WARC-Target-URI").alias("url"),
        F.split(F.regexp_extract("head", r"WARC-Record-ID: <urn:record:([0-9:]+)>", 1), ":").alias("id"),
        field("WARC-Payload-Digest").alias("digest"), number(field("X-Payload-Length")).alias("payload_bytes"),
        number(field("X-Page-Id")).alias("page_id"), number(field("X-Refers-To-Page")).alias("refers_to"),
        number(field("Content-Length")).cast("int").alias("n"),
        (F.octet_length("head") + 3).cast("int").alias("skip"), "bytes")
    return rows.select(
        F.col("id")[0].cast("long").alias("record"), F.col("id")[1].cast("int").alias("piece"),
        F.col("id")[2].cast("int").alias("part"), "warc_type", "url", "page_id", "refers_to", "payload_bytes",
        F.substring("digest", 6, 32).alias("payload_digest"), "n", F.expr("substring(bytes, skip + 1, n)").alias("data"))


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per record from segments in order; the digest and the length are carried from batch to batch."""
    now, sha, size = None, None, 0

    def finished() -> dict:
        digest = base64.b32encode(sha.digest()).decode()
        if now.warc_type == "response" and (digest != now.payload_digest or size != now.payload_bytes):
            raise ValueError(f"record {now.record}: payload does not match its header")
        return {"page_id": now.page_id, "payload_bytes": now.payload_bytes, "payload_digest": now.payload_digest,
                "record_type": now.warc_type, "refers_to": now.refers_to}

    for batch in batches:
        out = []
        for row in batch.astype({"page_id": "Int64", "refers_to": "Int64"}).itertuples(index=False):
            if len(row.data) != row.n:
                raise ValueError(f"record {row.record}: segment {row.piece}.{row.part} is cut short")
            if now is None or row.record != now.record:
                if now is not None:
                    out.append(finished())
                now, sha, size = row._replace(data=None), hashlib.sha1(), 0
            sha.update(row.data)
            size += row.n
        if out:
            yield _frame(out)
    if now is not None:
        yield _frame([finished()])


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record of the archives.

    A record of one segment is checked where it is read. Segments of a longer
    one meet by its number and are streamed in order; no payload is put
    together. Raises if a payload does not match its header.
    """
    table = read_archives(spark, path).drop("url")
    response = F.col("warc_type") == "response"
    single = (F.col("piece") == 0) & (F.col("part") == 0) & (~response & (F.col("n") == 0) | response
                                                             & (F.col("n") == F.col("payload_bytes")))
    sound = (F.octet_length("data") == F.col("n")) & (~response | (base32_sha1(F.col("data")) == F.col("payload_digest")))
    whole = table.where(single).select(
        "page_id", "payload_bytes",
        F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.concat(
            F.lit("record "), F.col("record"), F.lit(": payload does not match its header")))).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), "refers_to")
    parts = table.where(~F.coalesce(single, F.lit(False))).repartition("record").sortWithinPartitions("record", "piece", "part")
    return whole.unionByName(map_batches(parts, _summed, "page_id long, payload_bytes long, payload_digest string, "
                                                         "record_type string, refers_to long"))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)`` and read the archives back.

    Other columns are ignored. A null html is the empty payload, a null url
    ``about:blank``. All rows of the smallest page_id of a payload are
    responses; a null page_id revisits any other. An empty table gives
    archives without a record and no rows.
    """
    path = scratch_dir(pages.sparkSession, "warc")
    write_archives(classified(pages, min_bytes), path)
    return read_records(pages.sparkSession, path)
