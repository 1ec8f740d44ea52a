"""WARC archives in which repeated payloads are revisit records.

Every page becomes a record. Only headers are shuffled: by payload digest, each group of
equal payloads finds its smallest id. That page's record is the response, the others
are revisits of it; payloads below ``least_bytes`` are all responses. Payloads are in no
join that shuffles: revisits are written from headers alone, and the responses from a scan of the pages that
leaves out revisits by bitmaps of row numbers, up to 256 MB of them at a time.

The archives are written by Spark's text writer: a record's header block, an empty line and
the payload are one value, and the blank lines that end a record are the line
separator, so the files are plain WARC 1.1, gzipped. Reading parses records by their Content-Length, never by
looking for separators, so a payload may hold anything. Files are bounded by ``file_bytes``.

A null payload counts as empty. Equal means equal in SHA-1, SHA-256 and length. Rows of equal
id and payload are records each: the one stored first is the response. Rows without
id come after all ids. Headers are dated by the time of writing, unless a date is given. Ids and addresses may not break a header: control characters in
them are percent-encoded. An empty table writes an empty archive. Other columns
take no part.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from negsift.operators.positions import MAP_BYTES, by_position
from negsift.session import scratch_path, stored

FILE_BYTES = 16 << 20
BITMAP_ROWS = 32_768  # of one of Spark's bitmaps
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENDS = "\r\n\r\n"
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from its 40 hex digits: 5 bits a character."""
    digits = F.sha1(payload)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: the digits of base32
    groups = [F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 10).cast("long") for i in range(8)]  # 20 bits each
    letters = [F.substring(F.lit(alphabet), (F.shiftright(g, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for g in groups for k in range(4)]
    return F.concat(*letters)


def header_value(value: Column) -> Column:
    """Without control characters, which would end the line."""
    out = F.regexp_replace(F.coalesce(value, F.lit("")), "%(?=0D|0A|00|20)", "%25")
    for plain, code in (("\r", "%0D"), ("\n", "%0A"), ("\0", "%00")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def headers(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Pages with ``row``, stored: what tells rows apart must not change between two reads."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"), F.octet_length(payload).cast("long").alias("bytes"),
        base32_sha1(payload).alias("sha1"), F.sha2(payload, 256).alias("sha256"),
    )
    return stored(rows, "pages")


def revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Headers of the pages that revisit another: their own, and ``of_row, of_id, of_url`` of the response.

    Groups are reduced to one row by minimum before the shuffle; what joins with a large group is that row.
    """
    digest = ["sha1", "sha256", "bytes"]
    large = rows.filter(F.col("bytes") >= least_bytes).select("row", "page_id", "url", *digest)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row", "url")
    first = large.groupBy(*digest).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    met = large.join(first, digest).filter(F.col("row") != F.col("first.row"))
    of = [F.col(f"first.{c}").alias(name) for c, name in (("row", "of_row"), ("page_id", "of_id"), ("url", "of_url"))]
    return met.select("row", "page_id", "url", "bytes", "sha1", *of)


def responses(rows: DataFrame, revisit: DataFrame, map_bytes: int = MAP_BYTES) -> DataFrame:
    """The ``rows`` that revisit nothing, payloads where they are read.

    Row numbers rise from file to file. Where the bitmaps are too many for one broadcast, ranges of rows are
    read one after the other, each with its own; a range skips the files of the others.
    """
    spots = revisit.select(F.col("row").alias("pos"))
    buckets = spots.select(F.bitmap_bucket_number("pos").alias("bucket")).distinct()
    size = buckets.count() * BITMAP_ROWS // 8
    cuts: list[int] = []
    if size > map_bytes:
        parts = -(-2 * size // map_bytes)  # half full, since the cuts are approximate
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        cuts = sorted(set(buckets.select(F.percentile_approx("bucket", shares, 100 * parts)).first()[0]))
    pages, out = rows.withColumnRenamed("row", "pos"), None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        within = F.lit(True)
        if lo is not None:
            within &= F.col("pos") > lo * BITMAP_ROWS
        if hi is not None:
            within &= F.col("pos") <= hi * BITMAP_ROWS
        part = by_position(pages.filter(within), spots.filter(within), False, [], map_bytes)
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("pos", "row")


def record_id(row: Column, page_id: Column) -> Column:
    """A URN that holds the id, so that archives can be joined without a list of records."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def writing_time() -> Column:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def records(rows: DataFrame, revisit: DataFrame, date: str | None = None) -> DataFrame:
    """One value per record, fresh headers and, for responses, the payload."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    written = F.lit(date) if date else writing_time()

    def head(kind: str) -> list[Column]:
        return [
            F.lit("WARC/1.1\r\n"),
            line("WARC-Type", F.lit(kind)),
            line("WARC-Record-ID", record_id(F.col("row"), F.col("page_id"))),
            line("WARC-Date", written),
            line("WARC-Target-URI", header_value(F.col("url"))),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            line("WARC-Payload-Length", F.col("bytes").cast("string")),
            line("Content-Type", F.lit("text/html; charset=utf-8")),
        ]

    of = [
        line("WARC-Profile", F.lit(PROFILE)),
        line("WARC-Refers-To", record_id(F.col("of_row"), F.col("of_id"))),
        line("WARC-Refers-To-Target-URI", header_value(F.col("of_url"))),
        line("WARC-Refers-To-Date", written),
        line("Content-Length", F.lit("0")),
    ]
    own = [line("Content-Length", F.col("bytes").cast("string"))]
    first = F.concat(*head("response"), *own, F.lit("\r\n"), F.col("payload"))
    again = F.concat(*head("revisit"), *of, F.lit("\r\n"))
    return responses(rows, revisit).select(first.alias("value")).union(revisit.select(again.alias("value")))


def write_archives(
    pages: DataFrame, path: str, id_col="page_id", url_col="url", payload_col="html", least_bytes: int = 0,
    file_bytes: int = FILE_BYTES, date: str | None = None,
) -> None:
    """Write a deduplicated archive of ``pages`` to the new folder ``path``."""
    rows = headers(pages, id_col, url_col, payload_col)
    out = records(rows, stored(revisits(rows, least_bytes), "revisits"), date)
    total, most = rows.agg(F.coalesce(F.sum(F.col("bytes") + 512), F.lit(0)), F.count(F.lit(1))).first()
    # About file_bytes of uncompressed records in a file, at the mean size of a record.
    limit = max(1, most * file_bytes // max(total, 1))
    out.write.option("lineSep", ENDS).option("compression", "gzip").option("maxRecordsPerFile", limit).text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and payload of each record."""
    at = 0
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        block = archive[at:stop]
        many = int(_LENGTH.search(block)[1])
        fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n")[1:])
        yield {k.lower(): v for k, v in fields.items()}, archive[stop + 4 : stop + 4 + many]
        at = stop + 4 + many + len(ENDS)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """A row per record of all archives under ``path``.

    ``record_id, page_id, record_type, url, refers_to_record, payload_bytes,
    payload_digest, matches`` and, if asked for, ``payload``. ``matches``: a response's
    payload has the length and digest that its header names.
    """
    schema = "record_id string, page_id long, record_type string, url string, refers_to_record string, payload_bytes long, payload_digest string, matches boolean"
    schema += ", payload binary" if keep_payload else ""
    names = [c.strip().split()[0] for c in schema.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()][: len(names)]

    def rows_of(archive: bytes) -> Iterator[tuple]:
        import hashlib

        for head, payload in parse(archive):
            kind = "revisit" if head["warc-type"] == "revisit" else "response"
            digest, length = head["warc-payload-digest"].removeprefix("sha1:"), int(head["warc-payload-length"])
            real = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            good = kind == "revisit" or (real == digest and len(payload) == length)
            page = head["warc-record-id"].split(":")[2]
            row = (
                head["warc-record-id"], int(page) if page else None, kind, head.get("warc-target-uri"), head.get("warc-refers-to"),
                length, digest, good, payload,
            )
            yield row[: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for content in batch.column(0):
                held = []
                for row in rows_of(gzip.decompress(content.as_py())):
                    held.append(row)
                    if len(held) == 500:
                        yield _batch(held, types, names)
                        held = []
                if held:
                    yield _batch(held, types, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, schema)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def resolved(read: DataFrame) -> DataFrame:
    """Revisits joined to the responses they name: ``refers_to`` is the response's id.

    A revisit whose response is missing, or has another digest, has a null ``refers_to``.
    """
    wanted = read.filter("record_type = 'revisit'").select("refers_to_record").distinct()
    targets = read.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("_digest")
    ).join(wanted, "refers_to_record", "left_semi")
    same = F.when(F.col("_digest") == F.col("payload_digest"), F.col("refers_to"))
    return read.join(targets, "refers_to_record", "left").withColumn("refers_to", same).drop("_digest")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives, read them back, resolve the revisits."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes=least_bytes)
    return resolved(read_archives(pages.sparkSession, path, keep_payload=False))
