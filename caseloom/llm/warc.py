"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one partition per archive file. Of each
record the header block is parsed first; a record that fails the predicates on type or
header fields is skipped by its length, and its payload is neither read nor decoded.
Predicates come from options or are pushed down from filters. Writers put each task's
records into files of their own and list them in a manifest when the whole job has
succeeded, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from caseloom.llm.common import bounded, column, first_column, on_workers
from caseloom.session import cut_lineage, run_path

MANIFEST = "manifest.json"
#: Bytes after which a task begins another file.
FILE_BYTES = 256 << 20
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1_000
#: Repeated payloads whose digests may be broadcast, below 30 MB; with more, pages are shuffled by digest.
BROADCAST_PAYLOADS = 200_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-page:"

#: Header field behind each column that a predicate can be pushed down for.
FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to_id": "warc-refers-to",
    "digest": "warc-payload-digest",
}
# Schemes that Hadoop and Arrow call by different names.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
SCHEMA = "record_type string, record_id string, target_uri string, refers_to_id string, digest string, http_length long, payload binary"
ARROW = pa.schema([(n, pa.string()) for n in FIELDS] + [("http_length", pa.int64()), ("payload", pa.binary())])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a local path or any URI that Arrow opens; Hadoop's names of a scheme are known, too."""
    scheme, mark, rest = path.partition("://")
    if mark:
        return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def archive_files(folder: str) -> list[str]:
    """Files of a folder's manifest; of a folder without one, every ``.warc`` and ``.warc.gz``."""
    fs, root = file_system(folder)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [root]
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            return [f"{root}/{name}" for name in json.loads(f.read())]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted(i.path for i in found if i.path.endswith((".warc", ".warc.gz")))


def clean_field(value: str) -> str:
    """A header value: line ends and other control characters in percent form."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, record_id: str, uri: str | None, refers_to: str | None, digest: str, payload: bytes, date: str) -> bytes:
    """One record: response with its payload, or revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", clean_field(uri)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows ``(page_id, url, payload, record_type, refers_to)`` to archive files."""

    def __init__(self, options: dict):
        self.folder, self.date = options["path"], options.get("date", "2020-01-01T00:00:00Z")
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator):
        fs, root = file_system(self.folder)
        fs.create_dir(root, recursive=True)
        files, sink, size = [], None, 0
        for batch in iterator:
            names = ("page_id", "url", "payload", "record_type", "refers_to")
            for page, url, payload, kind, target in zip(*(column(batch, n) for n in names), strict=True):
                if sink is None or size > self.file_bytes:
                    if sink:
                        sink.close()
                    files.append(f"pages-{uuid.uuid4().hex}.warc")
                    sink, size = fs.open_output_stream(f"{root}/{files[-1]}"), 0
                payload = payload or b""
                own = f"{RECORD_URN}{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"
                other = f"{RECORD_URN}{target}" if target is not None else None
                raw = record(kind, own, url, other, hashlib.sha1(payload).hexdigest(), payload, self.date)
                sink.write(raw)
                size += len(raw)
        if sink:
            sink.close()
        return Written(files)

    def commit(self, messages):
        fs, root = file_system(self.folder)
        fs.create_dir(root, recursive=True)
        names = sorted(name for m in messages if m for name in m.files)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, root = file_system(self.folder)
        for name in (name for m in messages if m for name in m.files):
            fs.delete_file(f"{root}/{name}")


@dataclass
class ArchiveFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    """Reads archives; option ``payload=none`` leaves payloads out, ``record_type`` picks types."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payload = options.get("payload", "bytes") != "none"
        self.wanted: dict[str, set[str]] = {}
        if options.get("record_type"):
            self.wanted["warc-type"] = set(options["record_type"].split(","))

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if name in FIELDS and all(isinstance(v, str) for v in values):
                field = FIELDS[name]
                self.wanted[field] = self.wanted[field] & values if field in self.wanted else values
            else:
                yield f

    def partitions(self):
        return [ArchiveFile(p) for p in archive_files(self.folder)] or [ArchiveFile("")]

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = file_system(self.folder)
        rows, size = [], 0
        with fs.open_input_file(partition.path) as raw:
            stream = io.BufferedReader(raw, 1 << 20)
            if partition.path.endswith(".gz"):
                stream = gzip.GzipFile(fileobj=stream)
            for row in records(stream, self.wanted, self.payload):
                rows.append(row)
                size += len(row[-1] or b"") + 200
                if size > 8 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def records(stream, wanted: dict[str, set[str]], payload: bool):
    """Rows of the records that pass ``wanted``; others are skipped behind their header."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not the beginning of a WARC record")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        for name in ("warc-record-id", "warc-refers-to"):
            if name in head:
                head[name] = head[name].strip("<>")
        length = int(head["content-length"])
        if any(head.get(name) not in values for name, values in wanted.items()):
            stream.seek(length, io.SEEK_CUR)
            continue
        http_length, body, read = None, None, 0
        if head.get("content-type", "").startswith("application/http"):
            while read < length:
                line = stream.readline()
                read += len(line)
                if not line.strip():
                    break
                if line.lower().startswith(b"content-length:"):
                    http_length = int(line.split(b":", 1)[1])
        if payload and head.get("warc-type") != "revisit":
            body = stream.read(length - read)
        else:
            stream.seek(length - read, io.SEEK_CUR)
        yield (*(head.get(field) for field in FIELDS.values()), http_length, body)


class Warc(DataSource):
    """Data source ``warc``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let its filters be pushed down."""
    on_workers(spark)
    spark.dataSource.register(Warc)
    spark.conf.set(PUSHDOWN, "true")


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, payload, record_type, refers_to)`` for rows ``(page_id, url, html)``.

    Of rows with equal payloads of at least ``least_bytes`` that with the largest id is
    the response and the others revisit it. Rows that tie for the largest id are all
    responses, and so is a row without id in a group without any.
    """
    raw = F.coalesce("html", F.lit("")).cast("binary")
    rows = first_column(pages, "page_id", "url", "html").select("page_id", "url", raw.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = rows.filter(F.col("size") >= least_bytes).groupBy(F.col("digest"), F.col("size"))
    first = groups.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = cut_lineage(first, "first")  # a row per payload that is there more than once
    joined = rows.join(F.broadcast(first) if bounded(first, BROADCAST_PAYLOADS) else first, ["digest", "size"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = REVISIT_BYTES) -> str:
    """Write a record per row of ``pages``; the folder, by default a fresh one in the shared folder.

    Null and empty pages have an empty payload; very long ones are one record each; missing ids and
    addresses stay missing; repeated rows give a record each, all but one of them revisits if
    they are long enough; an empty table gives an archive without records; further columns
    are not looked at.
    """
    register(pages.sparkSession)
    folder = folder or run_path(pages.sparkSession, "warc")
    with_revisits(pages, least_bytes).write.format("warc").mode("append").option("path", folder).save()
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload)`` of an archive folder.

    Length and digest of a response are taken from the payload that was read; those
    of a revisit, whose payload is not there, from its header fields. Null and empty
    pages have an empty payload; missing ids and addresses stay missing; repeated
    rows give a record each; an empty table gives an archive without records.
    """
    register(spark)
    read = spark.read.format("warc").option("path", folder)

    def page(name):
        return F.when(F.col(name).startswith(RECORD_URN), F.substring(name, len(RECORD_URN) + 1, 30).cast("long"))

    head = [page("record_id").alias("page_id"), "record_type", page("refers_to_id").alias("refers_to"), F.col("target_uri").alias("url")]
    full = read.load().filter(F.col("record_type") == "response")
    full = full.select(*head, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "payload")
    again = read.option("payload", "none").load().filter(F.col("record_type") == "revisit")
    again = again.select(*head, F.col("http_length").alias("payload_bytes"), F.regexp_replace("digest", "^sha1:", "").alias("payload_digest"), "payload")
    return full.unionByName(again)
