from __future__ import annotations

import hashlib
import io
from types import SimpleNamespace

import pytest
from llm_frames import empty
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from caseloom.llm import warc


def test_round_trip(spark):
    long = "<p>" + "ä" * 600 + "</p>"
    rows = [(1, "http://a/", long), (5, "http://b/\r\nX: y", long), (3, None, long), (7, "u", "short"), (8, "u", "short"), (9, "u", None),
            (10, "u", ""), (11, "u", "WARC/1.1\r\n\r\n" * 200), (None, "u", long), (5, "http://b/", long)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, h string")
    folder = warc.write_pages(pages.toDF("page_id", "url", "html", "html"))
    got = warc.read_pages(spark, folder).collect()
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [r for r in got if r.page_id == page]
        again = html == long and page != 5
        assert {r.record_type for r in same} == {"revisit" if again else "response"}
        assert {r.refers_to for r in same} == {5 if again else None}
        assert {(r.payload_bytes, r.payload_digest) for r in same} == {(len(raw), hashlib.sha1(raw).hexdigest())}
    assert {r.url for r in got if r.page_id == 3} == {None}
    assert {bytes(r.payload) for r in got if r.page_id == 11} == {b"WARC/1.1\r\n\r\n" * 200}


def test_predicates_are_pushed_down_and_payloads_skipped(spark):
    reader = warc.WarcReader({"path": "x"})
    other = GreaterThan(("http_length",), 5)
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("record_id",), ("a", "b")), other])) == [other]
    assert reader.wanted == {"warc-type": {"revisit"}, "warc-record-id": {"a", "b"}}

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    raw = warc.record("response", "urn:x-page:1", "u", None, "d", b"z" * 9_000, "2020-01-01T00:00:00Z")
    raw += warc.record("revisit", "urn:x-page:2", "u", "urn:x-page:1", "d", b"z" * 9_000, "2020-01-01T00:00:00Z")
    stream = Counted(raw)
    rows = list(warc.records(stream, {"warc-type": {"revisit"}}, True))
    assert [(r[0], r[1], r[3], r[5], r[6]) for r in rows] == [("revisit", "urn:x-page:2", "urn:x-page:1", 9_000, None)] and stream.taken == 0


def test_files_of_lost_tasks_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    folder = warc.write_pages(pages, str(tmp_path / "w"))
    (tmp_path / "w" / "pages-lost.warc").write_bytes(b"half a record")
    assert warc.read_pages(spark, folder).count() == 1
    assert warc.read_pages(spark, warc.write_pages(empty(spark, "page_id long, url string, html string"))).count() == 0


def test_schemes_of_hadoop_are_opened_by_arrow(monkeypatch):
    opened = []
    monkeypatch.setattr(warc, "pafs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=opened.append), LocalFileSystem=warc.pafs.LocalFileSystem))
    for uri in ("s3a://b/k", "s3n://b/k", "hdfs://h/p"):
        warc.file_system(uri)
    assert opened == ["s3://b/k", "s3://b/k", "hdfs://h/p"]
    monkeypatch.undo()
    assert warc.SCHEMES == {"s3a": "s3", "s3n": "s3"}
    with pytest.raises(Exception, match="nosuchscheme|Unrecognized"):
        warc.file_system("nosuchscheme://a/b")
    fs, path = warc.file_system("file:///tmp/x")
    assert path == "/tmp/x" and warc.file_system("/tmp/x")[1] == "/tmp/x"
