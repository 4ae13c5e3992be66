import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from haulmetric.llm import warc

SMALL = warc.Archive(chunk_bytes=7, segment_bytes=100, revisit_from=50)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, payload binary")


def roundtrip(spark, rows, path, archive=SMALL):
    warc.write_archives(pages(spark, rows).repartition(3), path, archive)
    return warc.resolved(warc.payloads(warc.reassembled(warc.read_records(spark, path))))


def test_segments_and_chunks_of_any_bytes_come_back(spark, tmp_path):
    rng = random.Random(1)
    nasty = b"\r\n\r\nWARC/1.1\r\n0\r\n\r\n\x00\xff\xfe"
    rows = [(k, f"http://x/{k}", bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 6, 7, 99, 100, 101, 700])))) for k in range(60)]
    rows += [(100 + k, None, nasty * k) for k in range(12)]
    found = {r.page: r for r in roundtrip(spark, rows, f"{tmp_path}/a").collect()}
    assert len(found) == len(rows)
    for page, _, payload in rows:
        row = found[f"<urn:page:{page}>"]
        assert row.sound and (row.size, row.sha1) == (len(payload), hashlib.sha1(payload).hexdigest())


def test_continuations_are_found_in_other_files(spark, tmp_path):
    payload = bytes(range(256)) * 5
    warc.write_archives(pages(spark, [(1, "u", payload)]), f"{tmp_path}/a", SMALL)
    records = warc.read_records(spark, f"{tmp_path}/a")
    assert records.filter("kind = 'continuation'").count() > 5
    mixed = records.orderBy(F.rand(3)).repartition(4)
    row = warc.payloads(warc.reassembled(mixed)).first()
    assert row.sound and row.sha1 == hashlib.sha1(payload).hexdigest()


@pytest.mark.parametrize("lost", [1, 2, 7])
def test_a_lost_segment_is_reported(spark, tmp_path, lost):
    warc.write_archives(pages(spark, [(1, "u", b"abc" * 300), (2, "u", b"x")]), f"{tmp_path}/a", SMALL)
    records = warc.read_records(spark, f"{tmp_path}/a").filter(F.coalesce("segment", F.lit(0)) != lost)
    found = warc.payloads(warc.reassembled(records)).collect()
    assert sorted(r.sound for r in found) == [False, True]


def test_records_of_other_writers():
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = b"WARC/1.0\r\ncontent-length:0\r\nwarc-type: metadata\r\n\r\n\r\n\r\n"
    parsed = list(warc.parse(warc.unzipped(gzip.compress(one) + gzip.compress(two))))
    assert [(h["warc-type"], b) for h, b in parsed] == [("warcinfo", b"abc"), ("metadata", b"")]
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse(one[:-6]))
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: v\r\n\r\n") == b"abc"
    assert warc.same_digest("sha1:VKQHX5GYAEVMS4SEAZDVLRMIOZ3DNRAB", b"x") is False
    assert warc.same_digest("sha1:" + hashlib.sha1(b"x").hexdigest(), b"x")


def test_ties_nulls_and_header_breaks(spark, tmp_path):
    big = "é\r\n" * 500
    rows = [(1, "u", big), (5, "u\r\nX: y", big), (5, None, big), (None, "a", big), (7, "a", "tiny"), (8, "a", "tiny"), (9, "b", None), (None, "z", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    found = warc.op4_warc(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and all(r.sound for r in found)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in found)
    assert kinds == [
        (0, "response", 0), (0, "revisit", 5), (1, "revisit", 5), (5, "response", 0), (5, "response", 0),
        (7, "response", 0), (8, "response", 0), (9, "response", 0),
    ]
    frame.limit(0).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert warc.op4_warc(spark, f"{tmp_path}/none").count() == 0
