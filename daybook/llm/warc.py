"""WARC archives without repeated payloads.

Spark's text writer puts the records down: a record is one value, and the blank lines that end
it are the line separator, so archives lie on any store Spark knows and are committed by task.
Reading goes by the Content-Length of each record, never by its separator.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook import storage
from daybook.llm.frames import stored

# The base-32 alphabet of RFC 4648, the profile of revisit records, line ends.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"

PAGE = "page_id bigint, url string, html string"
HEADERS = (
    "page_id bigint, record_id string, record_type string, uri string, payload_digest string, "
    "refers_to_id string, payload_bytes bigint, sound boolean"
)


def payload_digest(payload: Column) -> Column:
    """SHA-1 of the payload in upper-case base 32; 20 bits of it make four letters."""
    bits = F.sha1(payload.cast("binary"))

    def letter(at: int) -> Column:
        twenty = F.conv(F.substring(bits, at // 4 * 5 + 1, 5), 16, 10).cast("int")
        return F.substring(F.lit(ALPHABET), F.shiftright(twenty, 15 - at % 4 * 5).bitwiseAND(F.lit(31)) + 1, F.lit(1))

    return F.concat(*[letter(at) for at in range(32)])


def _record_id(page: Column) -> Column:
    """A URN made from the page alone, so that a task run again writes the same records."""
    hexes = F.md5(F.concat(F.lit("page/"), page.cast("string")).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in cuts]), F.lit(">"))


def originals(headers: DataFrame, least: int = 0) -> DataFrame:
    """(payload_digest, original): of equal payloads of `least` bytes or more the largest page_id.

    Only headers are shuffled, added up per task first, so a payload that most pages share is one
    row per task. Payloads that occur once are left out.
    """
    return (
        headers.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.min("page_id").alias("__least"))
        .where("original > __least")
        .drop("__least")
    )


def records(pages: DataFrame, date: str, least: int = 0) -> DataFrame:
    """One row (record) per page: a response, or a revisit of the response with its payload.

    A NULL html is an empty payload. A page without page_id is a response without the page
    field and never an original. Rows that repeat an original's page_id are responses too.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "").alias("uri"),
        html.alias("payload"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"),
        payload_digest(html).alias("payload_digest"),
    )
    # Stored, so that the join rests on plain shuffles and Spark may split a hot payload's part.
    found = stored(originals(sized.select("page_id", "payload_bytes", "payload_digest"), least), "originals")
    again = F.col("original") > F.col("page_id")
    resolved = sized.join(found, "payload_digest", "left").withColumn("again", F.coalesce(again, F.lit(False)))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END + END))
    block = F.concat(http, F.when(F.col("again"), F.lit("")).otherwise(F.col("payload")))
    own = F.coalesce(
        _record_id(F.col("page_id")),
        _record_id(F.concat(F.coalesce("uri", F.lit("")), F.lit("/"), F.col("payload_digest"))),
    )

    def line(name: str, value: Column) -> Column:
        """A header line, or nothing where the value is NULL."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))

    revisit = {
        "WARC-Profile": F.lit(PROFILE),
        "WARC-Refers-To": _record_id(F.col("original")),
        "WARC-Refers-To-Date": F.lit(date),
    }
    return resolved.select(
        F.concat(
            F.lit("WARC/1.1" + END),
            line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
            line("WARC-Record-ID", own),
            line("WARC-Date", F.lit(date)),
            line("WARC-Target-URI", F.col("uri")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            *[line(name, F.when(F.col("again"), value)) for name, value in revisit.items()],
            line("Page-ID", F.col("page_id")),
            line("Content-Type", F.lit("application/http; msgtype=response")),
            line("Content-Length", F.octet_length(block)),
            F.lit(END),
            block,
        ).alias("record")
    )


def write_archives(
    pages: DataFrame, path: str, date: str = "2026-01-01T00:00:00Z", least: int = 0, per_archive: int = 5000
) -> None:
    """Writes compressed archives of at most `per_archive` records below `path`."""
    (
        records(pages, date, least)
        .write.option("lineSep", END * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_archive)
        .text(path)
    )


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of one archive, found by its lengths."""
    at = 0
    while at < len(archive):
        if not archive.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        head_end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:head_end].decode("utf-8").split(END)[1:]
        fields = dict(line.split(": ", 1) for line in lines)
        start = head_end + 4
        end = start + int(fields["Content-Length"])
        yield fields, archive[start:end]
        at = end + 4


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_id", "record_type", "uri", "payload_digest", "refers_to_id", "payload_bytes", "sound"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.bool_()]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, block in parse(gzip.decompress(content.as_py())):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                whole = fields["WARC-Type"] == "response"
                page = fields.get("Page-ID")
                rows.append(
                    (
                        None if page is None else int(page),
                        fields["WARC-Record-ID"],
                        fields["WARC-Type"],
                        fields.get("WARC-Target-URI"),
                        digest,
                        fields.get("WARC-Refers-To"),
                        len(payload) if whole else None,
                        not whole or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest,
                    )
                )
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives, checked against its digest where it has a payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_headers, HEADERS)


def resolved_headers(spark: SparkSession, path: str) -> DataFrame:
    """`read_headers` with payload_bytes of revisits and `refers_to`, from the original's record."""
    headers = read_headers(spark, path)
    whole = headers.where("record_type = 'response' and page_id is not null").groupBy("record_id").agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("__bytes")
    )
    return (
        headers.join(whole.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left")
        .withColumn("payload_bytes", F.coalesce("payload_bytes", "__bytes"))
        .drop("__bytes")
    )


def deduplicated(pages: DataFrame) -> DataFrame:
    """Pages written as archives below the shared folder and read back, one row per record."""
    spark = pages.sparkSession
    path = storage.scratch(spark, "warc")
    write_archives(pages, path)
    return resolved_headers(spark, path)
