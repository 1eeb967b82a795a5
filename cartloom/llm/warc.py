"""WARC archives in which a payload is kept once.

Payload digests are grouped (sums before the shuffle, so a payload that a third of all records share
is no burden), every record learns the original of its payload, and the archives are written with
fresh headers: ``response`` with the payload, ``revisit`` with the HTTP header alone and a reference
to the response. Headers alone are shuffled; the few revisits then go to where the payloads are read,
unless there are more than may be broadcast, when records are shuffled by page. Writing and reading go
through Spark's own sinks and sources, so any shared file system works; an archive is a text file
whose records end in two line breaks, packed with gzip as a whole (the sink knows no other way).

Payloads of like size share archives, so that an archive unpacks to about 64 MB at most; a longer
payload has one of its own. Columns besides page_id, url and html are not read.

Defined results: a null html is an empty payload; a null url gives no target header, line breaks in
it are escaped; rows that repeat the smallest page_id of a payload all stay responses; a null page_id
is never an original where its payload has a page_id; an empty table gives archives without records.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartloom.llm.shared import stored

#: Bytes that an archive unpacks to, and records in it, at most.
ARCHIVE_BYTES = 64 << 20
RECORDS_PER_FILE = 2_000
#: Payloads up to so many bytes share archives of the most records; every further class is four times as long.
SHORT_BYTES = ARCHIVE_BYTES // RECORDS_PER_FILE
#: Revisits that are sent to all tasks, at most; one takes about 200 bytes there.
BROADCAST_REVISITS = 300_000
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Base 32 of a 160-bit hex digest: eight letters for every ten hex digits."""
    parts = []
    for start in range(1, 41, 10):
        number = F.conv(F.substring(hex_digest, start, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            letter = F.shiftright(number, shift).bitwiseAND(F.lit(31)).cast("int")
            parts.append(F.substring(F.lit(_BASE32), letter + 1, F.lit(1)))
    return F.concat(*parts)


def payloads(pages: DataFrame) -> DataFrame:
    """Page, url, payload, its length and hex digest.

    The base 32 form names the digest 32 times; it is made where the digest is a column already.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    found = pages.select("page_id", "url", html.alias("payload"))
    return found.withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_sha1": F.sha1(F.col("payload").cast("binary")),
        }
    )


def headers_of(records: DataFrame) -> DataFrame:
    """Page, length and digest of every record, computed once: grouping and joining start from here."""
    return stored(records.select("page_id", "payload_bytes", "payload_sha1"), "headers")


def resolve_revisits(records: DataFrame, min_bytes: int = 0, headers: DataFrame | None = None) -> DataFrame:
    """Add ``original``: the smallest page_id with the same payload, null for originals.

    Only payloads found more than once take part in the join of headers. ``headers`` spares making them again.
    """
    found = (headers_of(records) if headers is None else headers).where(F.col("payload_bytes") >= min_bytes)
    shared = found.groupBy("payload_sha1", "payload_bytes").agg(
        F.min("page_id").alias("original"), F.count(F.lit(1)).alias("copies")
    )
    shared = shared.where(F.col("copies") > 1).drop("copies")
    revisits = (
        found.join(shared, ["payload_sha1", "payload_bytes"])
        .where(~F.col("page_id").eqNullSafe(F.col("original")) & F.col("original").isNotNull())
        .select("page_id", "payload_sha1", "original")
        .distinct()
    )
    revisits = stored(revisits, "revisits")
    keys = (records["page_id"].eqNullSafe(revisits["page_id"])) & (
        records["payload_sha1"] == revisits["payload_sha1"]
    )
    few = revisits.count() <= BROADCAST_REVISITS
    # Without the hint against it Spark goes by the size of files, which tells little of rows in memory.
    right = F.broadcast(revisits) if few else revisits.hint("merge")
    return records.join(right, keys, "left").select(records["*"], revisits["original"])


def _id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def record_text(resolved: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One WARC record per row, without the line breaks that end it."""
    revisit = F.col("original").isNotNull()
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))

    def header(name: str, value: Column | str, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))
        return line if when is None else F.when(when, line).otherwise(F.lit(""))

    return resolved.select(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            header("WARC-Record-ID", _id(F.col("page_id"))),
            header("WARC-Date", _DATE),
            header("WARC-Target-URI", uri, uri.isNotNull()),
            header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("payload_sha1")))),
            header("WARC-Profile", _PROFILE, revisit),
            header("WARC-Refers-To", _id(F.col("original")), revisit),
            header("Content-Type", "application/http; msgtype=response"),
            header("Content-Length", F.octet_length(block).cast("string")),
            F.lit("\r\n"),
            block,
        ).alias("value")
    )


def size_class(length: Column) -> Column:
    """0 for lengths up to ``SHORT_BYTES``, one more for every four times that."""
    times = F.greatest(length / SHORT_BYTES, F.lit(1.0))
    return F.ceil(F.log(4.0, times)).cast("int")


def records_per_file(number: int) -> int:
    """So many records of the longest payloads of a class fill an archive; one at least."""
    return max(1, RECORDS_PER_FILE // 4**number)


def write_archives(resolved: DataFrame, folder: str, headers: DataFrame | None = None) -> None:
    """Write all records, class by class of what they take in an archive: a revisit holds no payload.

    There is a class per four times of length, so a handful, and each is a pass over the records.
    ``headers`` spares reading the payloads to see which classes there are.
    """
    sizes = resolved if headers is None else headers
    classes = {0} | {row[0] for row in sizes.select(size_class(F.col("payload_bytes"))).distinct().collect()}
    held = F.when(F.col("original").isNull(), F.col("payload_bytes")).otherwise(F.lit(0))
    for number in sorted(classes):
        own = resolved if len(classes) == 1 else resolved.where(size_class(held) == number)
        (
            record_text(own)
            .write.mode("append")
            .option("lineSep", _END)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", records_per_file(number))
            .text(folder)
        )


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        at = start + int(fields["Content-Length"])
        yield fields, archive[start:at]
        if archive[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record not ended at byte {at}")
        at += 4


RECORDS = (
    "record_type string, record_id string, target_uri string, payload_digest string,"
    " refers_to string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all archives; the payload of a revisit is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out: list[tuple] = []
                for fields, block in parse(gzip.decompress(content.as_py())):
                    head = block.index(b"\r\n\r\n") + 4
                    kind = fields["WARC-Type"]
                    length = int(_LENGTH.search(block[:head])[1])
                    if kind == "response" and length != len(block) - head:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} is not whole")
                    out.append((
                        kind,
                        fields["WARC-Record-ID"],
                        fields.get("WARC-Target-URI"),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        fields.get("WARC-Refers-To"),
                        length,
                        block[head:] if payload and kind == "response" else None,
                    ))
                columns = list(zip(*out)) or [()] * 7
                kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = [part.split()[0] for part in RECORDS.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, RECORDS)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` to deduplicated archives in ``folder`` and describe the records read back."""
    spark = pages.sparkSession
    records = payloads(pages)
    headers = headers_of(records)
    write_archives(resolve_revisits(records, headers=headers), folder, headers)
    return read_archives(spark, folder, payload=False).select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
