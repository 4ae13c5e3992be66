"""WARC archives: writing segmented records and reassembling them (operator 4).

Writing: every page becomes a response record, or a revisit of the page with an equal payload and
the largest id. The payload travels in a chunked HTTP message. Messages longer than
`segment_bytes` are split into segment records: the first names its number, every continuation
also names the record it continues, and the last one the total length. Records are built from
column expressions and written by Spark's text writer (gzip), so files appear by task commit.

Reading: archives are parsed by their declared lengths. Continuations are grouped by the record
they continue, wherever they lie, ordered by segment number, and joined once numbers and total
length are complete; then the chunked framing is decoded and the digest verified. Broken
records are reported, not dropped.

Defined results: a null payload is empty; null and repeated page ids are allowed: null ids count
as the smallest, and of equal payloads all pages with the largest id are responses; a null url
leaves out that header; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import batched, quoted, read, rows_of, saved
from haulmetric.session import scratch_dir

VERSION = "WARC/1.1"
#: Between two records; the writer puts it as its line separator.
RECORD_END = "\r\n\r\n"
LINE = "\r\n"


@dataclass(frozen=True)
class Archive:
    """revisit_from: smallest payload that others may revisit; file_records bounds a file."""

    revisit_from: int = 1000
    chunk_bytes: int = 4096
    segment_bytes: int = 16_384
    file_records: int = 4000
    date: str = "2024-01-01T00:00:00Z"


# --- writing ----------------------------------------------------------------------------


def _pieces(data: Column, size: int) -> Column:
    """A binary cut into pieces of `size` bytes; one empty piece for an empty binary."""
    count = F.greatest(F.ceil(F.length(data) / size), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.substring(data, k * size + 1, F.lit(size)))


def _text(data: Column) -> Column:
    """The same bytes as a string; nothing looks at their encoding on the way to the file."""
    return data.cast("string")


def _chunked(payload: Column, size: int) -> Column:
    """Chunked transfer framing: size in hex, bytes, and a chunk of size 0 at the end."""
    framed = F.transform(
        F.filter(_pieces(payload, size), lambda p: F.length(p) > 0),
        lambda p: F.concat(F.lower(F.hex(F.length(p).cast("long"))), F.lit(LINE), _text(p), F.lit(LINE)),
    )
    return F.concat(F.array_join(framed, ""), F.lit("0" + LINE + LINE))


def _headers(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(LINE))) for name, value in pairs]
    return F.concat(F.lit(VERSION + LINE), *(F.coalesce(line, F.lit("")) for line in lines), F.lit(LINE))


def _one_line(value: Column) -> Column:
    """A header value without line breaks."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, archive: Archive = Archive()) -> DataFrame:
    """One row (value) per WARC record of rows (page_id, url, payload)."""
    rows = pages.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload").cast("long"))
    large = F.col("size") >= archive.revisit_from
    keepers = (
        rows.filter(large)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1")
        .select(F.col("digest").alias("d"), F.col("size").alias("s"), "keeper", F.lit(True).alias("shared"))
    )
    # Only digests that occur twice are on the other side; a hot one is split by Spark.
    rows = rows.join(keepers, F.expr("digest = d AND size = s"), "left").withColumn(
        "revisit", F.coalesce(F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.lit(False))
    )
    name = F.concat_ws(":", F.col("page_id").cast("string"), F.col("digest"), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("name", F.md5(name))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}"),
        F.when(F.col("revisit"), F.lit(LINE)).otherwise(
            F.concat(F.lit(f"Transfer-Encoding: chunked{LINE}{LINE}"), _chunked(F.col("payload"), archive.chunk_bytes))
        ),
    )
    urn = lambda c: F.concat(F.lit("<urn:uuid:"), c, F.lit(">"))
    page = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    cut = (
        rows.withColumn("block", http.cast("binary"))
        .withColumn("total", F.length("block"))
        .select("*", F.posexplode(_pieces(F.col("block"), archive.segment_bytes)).alias("k", "part"))
        .withColumn("segments", F.ceil(F.greatest(F.col("total"), F.lit(1)) / archive.segment_bytes))
    )
    first, split = F.col("k") == 0, F.col("segments") > 1
    last = split & (F.col("k") == F.col("segments") - 1)
    head = _headers(
        ("WARC-Type", F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", urn(F.when(first, F.col("name")).otherwise(F.md5(F.concat_ws(":", "name", "k"))))),
        ("WARC-Date", F.lit(archive.date)),
        ("WARC-Target-URI", _one_line(F.col("url"))),
        ("WARC-Segment-Number", F.when(split, (F.col("k") + 1).cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(~first, urn(F.col("name")))),
        ("WARC-Segment-Total-Length", F.when(last, F.col("total").cast("string"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Profile", F.when(first & F.col("revisit"), F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(first & F.col("revisit"), page(F.col("keeper")))),
        # An extension field: the page that the record is of.
        ("X-Page-ID", F.when(first, page(F.col("page_id")))),
        ("Content-Type", F.when(first, "application/http;msgtype=response")),
        ("Content-Length", F.length("part").cast("string")),
    )
    return cut.select(F.concat(head, _text(F.col("part"))).alias("value"))


# Fixed value: the profile of revisits that share a payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_archives(pages: DataFrame, path: str, archive: Archive = Archive()) -> None:
    """Write rows (page_id, url, payload) as gzipped archives below `path`."""
    (
        records(pages, archive)
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", archive.file_records)
        .text(path)
    )


# --- reading ----------------------------------------------------------------------------


def unzipped(data: bytes) -> bytes:
    """Contents of a gzip file of any number of members; other data as it is."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join([*parts, data])


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by the declared lengths."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in data[at:stop].decode(errors="replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, block
        at = stop + 4 + size


def dechunked(body: bytes) -> bytes:
    """The bytes inside chunked transfer framing; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = stop + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("chunk does not end where it should")
        parts.append(body[stop + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    coding = [x for x in head.lower().split(b"\r\n") if x.startswith(b"transfer-encoding:")]
    return dechunked(body) if coding and coding[0].endswith(b"chunked") else body


def same_digest(declared: str | None, payload: bytes) -> bool:
    """Whether a declared SHA-1, in hex or base 32, is the payload's; other kinds are not tested."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() != "sha1":
        return True
    found = hashlib.sha1(payload).digest()
    return value.lower() == found.hex() or value == base64.b32encode(found).decode()


_RECORD = pa.schema(
    [
        ("record", pa.string()), ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()),
        ("kind", pa.string()), ("page", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()),
        ("block", pa.binary()),
    ]
)
_RECORD_DDL = (
    "record string, origin string, segment long, total long, kind string, page string, "
    "refers_to string, digest string, block binary"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below `path`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (content,) in rows_of(batches, ("content",)):
                for h, block in parse(unzipped(content)):
                    number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
                    yield (
                        h.get("warc-record-id"), h.get("warc-segment-origin-id"),
                        int(number) if number else None, int(total) if total else None,
                        h.get("warc-type"), h.get("x-page-id"), h.get("warc-refers-to"),
                        h.get("warc-payload-digest"), block,
                    )

        yield from batched(made(), _RECORD)

    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema(schema).load(path)
    return files.select("content").mapInArrow(work, _RECORD_DDL)


def reassembled(found: DataFrame) -> DataFrame:
    """Whole records: those of one piece as they are, and segments put together.

    Adds `complete`: segment numbers run from 1 without gaps and the lengths add up.
    """
    names = ["record", "kind", "page", "refers_to", "digest"]
    single = found.filter("segment IS NULL").select(*names, "block", F.lit(True).alias("complete"))
    parts = found.filter("segment IS NOT NULL").withColumn("origin", F.coalesce("origin", "record"))
    head = F.struct(*(F.col(c) for c in names))
    grouped = parts.groupBy("origin").agg(
        # One record's segments, so no more than one payload.
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max(F.when(F.col("segment") == 1, head)).alias("head"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    whole = grouped.withColumn("block", block).select(
        *(F.col("head")[c].alias(c) for c in names),
        "block",
        F.coalesce(
            F.array_compact(numbers).eqNullSafe(F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long")))
            & (F.length("block") == F.col("total")),
            F.lit(False),
        ).alias("complete"),
    )
    return single.unionByName(whole)


def payloads(whole: DataFrame) -> DataFrame:
    """(page, kind, refers_to, size, sha1, sound) of whole records, payloads decoded."""
    schema = pa.schema(
        [("page", pa.string()), ("kind", pa.string()), ("refers_to", pa.string()), ("declared", pa.string()),
         ("size", pa.int64()), ("sha1", pa.string()), ("sound", pa.bool_())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for page, kind, refers_to, declared, block, complete in rows_of(
                batches, ("page", "kind", "refers_to", "digest", "block", "complete")
            ):
                if kind == "revisit":
                    yield page, kind, refers_to, declared, None, None, complete
                    continue
                try:
                    body = payload_of(block)
                except ValueError:
                    yield page, kind, refers_to, declared, None, None, False
                    continue
                sound = complete and same_digest(declared, body)
                yield page, kind, refers_to, declared, len(body), hashlib.sha1(body).hexdigest(), sound

        yield from batched(made(), schema)

    return whole.mapInArrow(
        work, "page string, kind string, refers_to string, declared string, size long, sha1 string, sound boolean"
    )


def resolved(found: DataFrame) -> DataFrame:
    """Give revisits the size and digest of the response they refer to."""
    declared = F.substring_index("declared", ":", -1)
    origin = (
        found.filter("kind = 'response'")
        .groupBy(F.col("page").alias("p"), F.col("sha1").alias("d"))
        .agg(F.min("size").alias("of_size"))
    )
    revisit = (
        found.filter("kind = 'revisit'")
        .withColumn("want", declared)
        .join(origin, F.expr("refers_to = p AND want = d"), "left")
        .select("page", "kind", "refers_to", F.col("of_size").alias("size"), F.col("d").alias("sha1"),
                (F.col("sound") & F.col("d").isNotNull()).alias("sound"))
    )
    return found.filter("kind = 'response'").select(revisit.columns).unionByName(revisit)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(
        quoted("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    path = f"{scratch_dir(spark, 'warc')}/archives"
    write_archives(pages, path)
    found = resolved(saved(payloads(reassembled(read_records(spark, path))), "payloads"))
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).cast("long")
    return found.select(
        F.when(F.col("page").isNotNull(), number("page")).alias("page_id"),
        F.col("size").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to"), "sound",
    )


def oracle_sql() -> str:
    """DuckDB SQL of op4."""
    least = Archive().revisit_from
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, encode(coalesce(html, '')) AS raw FROM pages),
k AS (SELECT *, octet_length(raw) AS size,
             max(page_id) OVER (PARTITION BY body) AS keeper FROM p),
r AS (SELECT *, size >= {least} AND page_id <> keeper AS revisit FROM k)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN keeper END AS refers_to, true AS sound
FROM r"""
