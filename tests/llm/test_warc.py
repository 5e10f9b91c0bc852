import base64
import hashlib

import pytest

from varloom.llm import queries, warc
from varloom.session import new_folder

SF = "/root/testdata/sf0.001"


def mark(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, pages, **options):
    archives = warc.write_archives(pages, new_folder(spark, "test-warc"), **options)
    return archives, warc.read_archives(archives, with_payload=True).collect()


def test_records_come_back_byte_for_byte(tmp_path):
    texts = [f"<p>page {i} of many pages with much in common {'x' * (i % 9)}</p>".encode() for i in range(500)]
    texts += [b"", b"\r\n\r\n", "ä\x00😀".encode(), b"z" * 3_000_000]
    archive = warc.Archive(str(tmp_path))
    for i, t in enumerate(texts):
        archive.add(warc.record(i, f"http://a/{i} %20\r\nX: y", t, None, warc.digest(t)))
    path, records, size = archive.close()
    assert records == len(texts) and size < sum(map(len, texts)) / 5
    for chunk in (97, 1 << 20):
        rows = [warc.parse(r) for r in warc.read_archive(path, chunk)]
        assert [r["payload"] for r in rows] == texts
        assert [r["page_id"] for r in rows] == list(range(len(texts)))
        assert rows[3]["url"] == "http://a/3 %20\r\nX: y"


def test_archives_begin_with_a_dictionary_frame(tmp_path):
    archive = warc.Archive(str(tmp_path))
    for i in range(2000):
        archive.add(warc.record(i, "http://a/", f"<html><body>entry {i} and {i * 7}</body></html>".encode(), None, "A"))
    path = archive.close()[0]
    data = open(path, "rb").read()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    size = int.from_bytes(data[4:8], "little")
    assert data[8 + size : 12 + size] == warc.FRAME


def test_cut_archives_are_an_error(tmp_path):
    archive = warc.Archive(str(tmp_path))
    archive.add(warc.record(1, None, b"some text" * 100, None, "A"))
    path = archive.close()[0]
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-5])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_archive(path))


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op3_warc(spark, SF).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest) for r in rows} == {
        (k, len((t or "").encode()), mark(t)) for k, t in pages.items()
    }
    assert len(rows) == len(pages)


def test_revisits_refer_to_the_largest_key(spark):
    pages = spark.createDataFrame(
        [(1, "u1", "same"), (5, None, "same"), (5, None, "same"), (3, "u3", "same"), (7, "u7", "other"), (8, "u", None), (9, "u", ""), (None, "n", "same")],
        "page_id long, url string, html string",
    )
    archives, rows = round_trip(spark, pages)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.url) for r in rows), key=repr)
    assert got == sorted(
        [
            (1, "revisit", 5, 4, "u1"), (5, "response", None, 4, None), (5, "response", None, 4, None), (3, "revisit", 5, 4, "u3"),
            (7, "response", None, 5, "u7"), (8, "revisit", 9, 0, "u"), (9, "response", None, 0, "u"), (None, "revisit", 5, 4, "n"),
        ],
        key=repr,
    )
    assert {r.payload for r in rows if r.record_type == "revisit"} == {None}
    assert {r.payload_digest for r in rows if r.payload_bytes == 4} == {mark("same")}
    assert sum(r.records for r in archives.collect()) == 8
    small = round_trip(spark, pages, least_bytes=5)[1]
    assert {r.record_type for r in small} == {"response"}


def test_archives_are_bounded_and_clashing_names_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5_000)
    pages = spark.range(100).selectExpr("id AS page_id", "'u' AS url", "repeat('ab', 50) || id AS html", "1 AS key", "2 AS sha", "3 AS data")
    archives, rows = round_trip(spark, pages)
    assert archives.count() > 3 and sorted(r.page_id for r in rows) == list(range(100))
    assert round_trip(spark, pages.limit(0))[1] == []
