import gzip
import io

import pytest

from pyspark.sql import functions as F

from sonomart.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, first int")


def test_round_trip_with_revisits(spark):
    big, small = "é" * 80, "tiny"
    rows = [(5, "http://a", big), (3, "http://b\nX: y", big), (9, None, big), (4, "u", small), (6, "u", small), (7, "u", None), (8, "u", ""),
            (None, "u", big + "?"), (2**60 + 1, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (3, "again", big), (10, "z", "z" * 300_000)]
    manifest, folder = warc.write(pages(spark, rows), file_bytes=600)
    assert manifest.count() > 1 and sum(r.records for r in manifest.collect()) == len(rows)
    got = warc.read(manifest, folder).collect()
    assert all(r.verified for r in got)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(5, "revisit", 3), (3, "response", None), (3, "response", None), (9, "revisit", 3), (4, "response", None), (6, "response", None),
            (7, "response", None), (8, "response", None), (None, "response", None), (2**60 + 1, "response", None), (10, "response", None)]
    assert sorted([(r.page_id, r.record_type, r.refers_to) for r in got], key=key) == sorted(want, key=key)
    by_id = {r[0]: r for r in rows}
    for r in got:
        assert r.payload_bytes == len((by_id[r.page_id][2] or "").encode())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (by_id[r.page_id][2] or "").encode()
    assert {r.url for r in got if r.page_id == 3} == {"http://b\nX: y", "again"}
    empty, where = warc.write(pages(spark, rows).limit(0))
    assert warc.read(empty, where).count() == 0


def test_any_gzip_reader_opens_the_files_and_damage_is_found():
    import hashlib
    digest = hashlib.sha256(b"body").hexdigest()
    data = b"".join(warc.member(warc.record(i, "u", b"body", digest, None)) for i in range(3))
    assert gzip.decompress(data).count(b"WARC/1.1") == 3
    assert [r[0] for r in warc.read_stream(io.BytesIO(data))] == [0, 1, 2]
    wrong = warc.member(warc.record(0, "u", b"body", "0" * 64, None)) + data
    assert [r[6] for r in warc.read_stream(io.BytesIO(wrong), strict=False)] == [False, True, True, True]
    for broken in (wrong, data[:-9], data[:40] + b"\0\0\0" + data[43:], data + b"rest"):
        with pytest.raises(ValueError):
            list(warc.read_stream(io.BytesIO(broken)))


def test_files_are_read_by_many_tasks(spark):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 40) for i in range(60)], "page_id long, url string, html string").repartition(6)
    manifest, folder = warc.write(df, file_bytes=400)
    assert manifest.count() > 8
    read = warc.read(manifest, folder)
    tasks = read.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == spark.sparkContext.defaultParallelism and read.count() == 60
    assert warc.read(manifest.limit(0), folder).count() == 0


def test_pages_cross_no_shuffle_where_few_payloads_are_shared(spark):
    df = spark.createDataFrame([(i, "u", "same page " * 30) for i in range(10)], "page_id long, url string, html string")
    text = warc.plan_records(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
