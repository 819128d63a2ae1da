"""WARC round trip, index lookups, edge cases."""

import gzip
import hashlib
import io
import uuid

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from pricewise.llm import warc
from pricewise.session import scratch_path


@pytest.fixture()
def folder(spark):
    return scratch_path(spark, f"warc-{uuid.uuid4().hex}")


def expected(rows):
    data = [(i, u, (h or "").encode()) for i, u, h in rows]
    least = {}
    for i, _, p in data:
        if i is not None and len(p) >= 100:
            least[p] = min(least.get(p, i), i)
    many = {p for p in least if sum(x[2] == p for x in data) > 1}
    return sorted(((i, u, len(p), hashlib.sha256(p).hexdigest(), "revisit" if p in many and least[p] != i else "response",
                    least[p] if p in many and least[p] != i else None) for i, u, p in data), key=str)


def round_trip(spark, rows, folder):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "1 as key", "2 as offset")
    directory = warc.write_index(warc.write_archives(pages, folder), folder)
    back = warc.read_back(spark, directory, folder).collect()
    number = lambda x: None if x is None else int(x)
    got = sorted(((number(r.page_id), r.url, r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in back), key=str)
    return got, back, directory


def test_edge_cases(spark, folder):
    big = "é<p>" * 200_000
    rows = [(1, "http://a.example/x", None), (2, None, ""), (3, "http://b.example/", "s" * 99), (4, "http://b.example/", "s" * 99), (9, "http://c", "d" * 100),
            (5, "http://www.c.example:8080/q?a=1#f", "d" * 100), (5, "http://www.c.example:8080/q?a=1#f", "d" * 100), (7, "http://c/\r\nX: 1\ty", big), (8, "u", big),
            (None, "n", "d" * 100), (None, "n", "\r\n\r\nWARC/1.1" * 20), (11, "http://[bad", "x\x85 y" * 50)]
    got, back, _ = round_trip(spark, rows, folder)
    want = [(i, u.replace("\r", "%0D").replace("\n", "%0A").replace("\t", "%09") if u else u, *x) for i, u, *x in expected(rows)]
    assert got == sorted(want, key=str)
    html = {r.page_id: r.html for r in back if r.record_type == "response" and r.page_id}
    assert html["7"] == big and html["1"] == "" and html["11"] == "x\x85 y" * 50


def test_empty(spark, folder):
    assert round_trip(spark, [], folder)[0] == []


def test_given_pages_files_and_lookup(spark, folder):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got, back, directory = round_trip(spark, rows, folder)
    assert got == expected(rows)
    # every archive is a chain of gzip members that hold WARC records
    store, root = fs.FileSystem.from_uri(folder)
    names = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.GzipFile(fileobj=io.BytesIO(store.open_input_file(n).read())).read() for n in names)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    # lookups find exactly the captures of a key
    urls = pages.select("url").limit(40).union(spark.createDataFrame([("http://none.example/",), (None,), ("",)], "url string"))
    found = warc.lookup(urls, directory, folder).collect()
    want = {}
    for i, u, _ in rows:
        want.setdefault(warc.url_key(u), set()).add(str(i))
    asked = [r.url for r in urls.collect()]
    for u in asked:
        assert {r.page_id for r in found if r.url == u} == want.get(warc.url_key(u), set())


def test_lookup_over_many_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 7)
    rows = [(i, f"http://h{i % 9}.example/{i % 3}", f"p{i}") for i in range(300)]
    _, _, directory = round_trip(spark, rows, folder)
    assert directory.count() > 20
    found = warc.lookup(spark.createDataFrame([("http://h4.example/1",), ("http://h0.example/0",)], "url string"), directory, folder).collect()
    assert sorted(int(r.page_id) for r in found if r.url == "http://h4.example/1") == [i for i in range(300) if i % 9 == 4 and i % 3 == 1]
    assert sorted(int(r.page_id) for r in found if r.url == "http://h0.example/0") == [i for i in range(300) if i % 9 == 0 and i % 3 == 0]


def test_many_repeated_digests_are_joined_without_a_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 1)
    rows = [(i, f"http://h/{i}", f"{i % 40}" * 120) for i in range(130)]
    assert round_trip(spark, rows, folder)[0] == expected(rows)


def test_records_are_read_by_many_tasks_of_like_size(spark, folder):
    rows = [(i, f"http://h/{i}", "".join(map(str, range(i, i + 3000)))) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    captures = warc.write_archives(pages, folder)
    directory = warc.write_index(captures, folder)
    total = captures.agg(F.sum("length")).first()[0]
    assert directory.agg(F.sum("record_bytes")).first()[0] == total
    sizes = [r.s for r in warc.read_back(spark, directory, folder).groupBy(F.spark_partition_id()).agg(F.sum("payload_bytes").alias("s")).collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism // 2 and max(sizes) <= 0.5 * sum(sizes)
    assert warc.read_tasks(spark, 1 << 50) == (1 << 25, warc.READ_BYTES) and warc.read_tasks(spark, 0)[1] == warc.MIN_READ_BYTES


def test_keys():
    assert warc.url_key("https://M.Example.com/A b?x=1#f") == "com,example,m)/a%20b?x=1"
    assert warc.url_key(None) == "" and warc.url_key("http://h:8080") == "h:8080)/"
