import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from samples import shared  # noqa: F401

from lineweft.llm import warc, zipfiles

BIG = "<p>naïve 日本語</p>" * 100
PAGES = [
    (1, "http://a.example/x?q=1", BIG, 1),
    (2, "http://a.example/y", BIG, 2),
    (2, "http://a.example/y", BIG, 2),
    (None, "http://b.example/", BIG, 3),
    (3, None, "short", 4),
    (4, "http://b.example/\r\nX-Bad: 1 ü", "short", 5),
    (5, "", None, 6),
    (6, "no url at all [", "", 7),
    (7, "http://c.example/", "x" * 999, 8),
    (8, "http://c.example/", "x" * 999, 9),
    (9, "http://c.example/", "y" * 1000, 10),
    (10, "http://c.example/", "y" * 1000, 11),
    (11, "http://c.example/", "long\r\n\r\n " * 200_000, 12),
    (None, None, "z" * 2000, 13),
    (None, None, "z" * 2000, 13),
]


def expected(rows):
    """Rows as the contract has them, by brute force."""
    out = []
    groups = {}
    for n, (id, _, html, _) in enumerate(rows):
        groups.setdefault(html or "", []).append((id is not None, id or 0, n))
    for n, (id, url, html, _) in enumerate(rows):
        data = (html or "").encode()
        first = max(groups[html or ""])
        revisit = len(data) >= 1000 and first[2] != n
        out.append((id, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    first[1] if revisit and first[0] else None, b"" if revisit else data))
    return sorted(out, key=repr)


def read(archives):
    found = warc.read_archives(archives).withColumn("id", warc.source_id().cast("bigint"))
    found = found.withColumn("of", warc.source_id(name="x-refers-to-source-id").cast("bigint"))
    assert found.where("error IS NOT NULL").count() == 0
    return found


@pytest.mark.parametrize("zip64,archive_bytes", [(False, 1 << 20), (True, 1)])
def test_round_trip(spark, tmp_path, zip64, archive_bytes):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string, row int").repartition(3)
    archives = warc.write_archives(pages, str(tmp_path), archive_bytes=archive_bytes, zip64=zip64)
    got = read(archives).select(
        "id", "headers", "payload_bytes", "payload_digest", "record_type", "of", "payload"
    ).collect()
    urls = {id: url for id, url, _, _ in PAGES}
    rows = sorted(((r[0], urls[r[0]] if r[0] else None, *r[2:6], bytes(r[6])) for r in got), key=repr)
    assert rows == sorted(((r[0], r[1] if r[0] else None, *r[2:]) for r in expected(PAGES)), key=repr)
    ids = {r.headers["warc-record-id"] for r in got}
    assert len(ids) == len(PAGES) and all(r.headers["warc-refers-to"] in ids for r in got if r.record_type == "revisit")
    for path in [r.path for r in archives.collect()]:  # the standard library reads them too
        with zipfile.ZipFile(path) as z:
            assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            lines = z.read("indexes/index.cdxj").splitlines()
            assert lines == sorted(lines)
            assert gzip.decompress(z.read("archive/data.warc.gz")).count(b"WARC/1.1\r\n") == len(lines)


def test_empty_table_and_members(spark, tmp_path):
    nothing = spark.createDataFrame([], "page_id bigint, url string, html string")
    archives = warc.write_archives(nothing, str(tmp_path))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0
    one = warc.write_archives(nothing.union(spark.sql("SELECT 1, 'u', 'text'")), str(tmp_path))
    assert {r.name for r in warc.archive_members(one).collect()} == {"archive/data.warc.gz", "indexes/index.cdxj"}


def _record(n, packed):
    body = b"HTTP/1.1 200 OK\r\n\r\n" + b"b" * n
    data = b"WARC/1.0\r\nWARC-Type: response\r\nX-Source-Id: %d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, len(body), body)
    return gzip.compress(data) if packed else data


@pytest.mark.parametrize("packed", [False, True])
def test_foreign_archives_without_index_and_with_bytes_before(spark, tmp_path, packed):
    name = "archive/x.warc.gz" if packed else "archive/x.warc"
    sizes = [0, 5, 3_000_000, 7]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z, z.open(zipfile.ZipInfo("pages/p.jsonl"), "w") as f:
        f.write(b"{}")
    with zipfile.ZipFile(buffer, "a") as z, z.open(zipfile.ZipInfo(name), "w", force_zip64=True) as f:
        for n in sizes:
            f.write(_record(n, packed))
    path = tmp_path / "own.zip"
    path.write_bytes(b"#!/bin/sh\n" + buffer.getvalue())
    found = read(spark.createDataFrame([(str(path),)], "path string"))
    assert sorted((r.id, r.payload_bytes) for r in found.collect()) == sorted((n, n) for n in sizes)


def test_damage_is_a_row(spark, tmp_path):
    good = warc.write_archives(spark.sql("SELECT 1 page_id, 'u' url, 'some text' html"), str(tmp_path)).first().path
    data = bytearray(open(good, "rb").read())
    packed, cut, spoilt, none = (tmp_path / n for n in ("packed.zip", "cut.zip", "spoilt.zip", "none.zip"))
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"x" * 100)
    cut.write_bytes(data[:-1])
    at = data.index(b"\x1f\x8b") + 40
    data[at] ^= 0xFF
    spoilt.write_bytes(data)
    none.write_bytes(b"")
    paths = [str(p) for p in (good, packed, cut, spoilt, none, tmp_path / "missing.zip")]
    rows = warc.read_archives(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert sorted(r.path for r in rows) == sorted(paths)
    assert [r.path for r in rows if r.error is None] == [good]


def test_directory_entries_of_both_kinds():
    for zip64 in (False, True):
        stream = io.BytesIO()
        writer = zipfiles.StoredWriter(stream, zip64)
        for n in range(200):
            writer.begin(f"m{n}é")
            assert writer.write(b"a" * n) == 0 and writer.write(b"b") == n
            writer.finish()
        writer.close()
        stream.size = lambda s=stream: len(s.getvalue())
        found = list(zipfiles.members(stream))
        assert [(m.name, m.size, m.stored) for m in found] == [(f"m{n}é", n + 1, True) for n in range(200)]
        start = zipfiles.content_start(stream, found[9])
        assert stream.getvalue()[start : start + 10] == b"a" * 9 + b"b"
        with zipfile.ZipFile(stream) as z:
            assert z.testzip() is None and len(z.namelist()) == 200


def test_url_keys_and_ids_survive(spark, tmp_path):
    assert warc.url_key("HTTP://www.A.example:80/P?x=1") == "example,a,www)/p?x=1"
    assert warc.url_key(None) == ")/" and " " not in warc.url_key("http://[bad/ x")
    rows = [("a+b %\n", "u", "t"), ("é/", None, "t"), ("", "", "")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string").withColumn("payload", F.lit(1))
    found = warc.read_archives(warc.write_archives(pages, str(tmp_path))).select(warc.source_id().alias("id"))
    assert sorted(r.id for r in found.collect()) == sorted(r[0] for r in rows)
