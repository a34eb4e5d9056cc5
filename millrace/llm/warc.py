"""WARC archives with an index first: write records and their places, then read chosen records by byte ranges.

Each task writes its rows to files of its own (one gzip member a record) under a name that
no other attempt has, and returns an index row per record. The index is written as Parquet,
so it names only files of attempts that succeeded; a lost executor's files are never read.
Of records with equal payloads (by SHA-1, from ``revisit_from`` bytes on) the one of the
smallest id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import kernel as K
from millrace.llm.common import ranges_for, staging

#: Bytes after which a task begins its next file; gap and size up to which reads are joined.
FILE_BYTES, GAP_BYTES, READ_BYTES = 256 << 20, 64 << 10, 8 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of archive that a task reads at most, and at least where the cluster has cores for it.
MOST_READ, LEAST_READ = 64 << 20, 1 << 20
_INDEX = ["file", "offset", "length", "url", "digest", "id", "record_type"]


def _place(uri: str):
    """File system and path of a URI for pyarrow: its own kinds, Hadoop's other names for them, else whatever fsspec knows."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    named = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "viewfs": "viewfs"}.get(scheme, scheme)
    if rest and named not in ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "mock"):
        import fsspec

        return fs.PyFileSystem(fs.FSSpecHandler(fsspec.filesystem(scheme))), rest
    return fs.FileSystem.from_uri(f"{named}://{rest}" if rest else uri)


def _field(value: str) -> str:
    """A header value: control characters and line ends by percent codes."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(id_: object, url: str | None, payload: bytes, digest: str, refers_to: object | None) -> bytes:
    """One WARC/1.1 record, uncompressed. A revisit keeps the HTTP head, whose Content-Length is the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if id_ is None else _field(str(id_))}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {_field(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{_field(str(refers_to))}>"] if refers_to is not None else []
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """``id, url, record_type, digest, refers_to, payload_bytes, payload`` of a record; one that contradicts itself fails."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = body.partition(b"\r\n\r\n")
    n = int(http.decode().lower().rpartition("content-length: ")[2].split("\r\n")[0])
    page = lambda x: x and (x.removeprefix("<urn:page:").removesuffix(">") or None)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return {"id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "digest": digest, "refers_to": page(fields.get("WARC-Refers-To")), "payload_bytes": n, "payload": payload if fields["WARC-Type"] == "response" else None}


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name = None, 0, ""
        for batch in batches:
            rows = []
            for id_, url, html, sha1, first in zip(*(batch.column(c) for c in ("id", "url", "html", "sha1", "first")), strict=True):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                    store, place = _place(name)
                    out = store.open_output_stream(place, compression=None)  # members are compressed one by one
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                id_, first = id_.as_py(), first.as_py()
                refers = first if first is not None and first != id_ else None
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(record(id_, url.as_py(), payload, digest, refers)) + pack.flush()
                out.write(member)
                rows.append((name, at, len(member), url.as_py(), digest, id_, "response" if refers is None else "revisit"))
                at += len(member)
            if rows:
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), batch.column("id").type, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _INDEX)
        if out is not None:
            out.close()

    return run


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 0) -> DataFrame:
    """Write every row as a record below ``path/archive`` and return the index, ``path/index``.

    Index: ``file, offset, length, url, digest, id, record_type``, digest as bare base32
    SHA-1. A null payload is empty; a null url has no URI field; rows of a null id are
    revisits where another row has their payload. Rows that repeat the response's id are
    responses as well. Extra columns are ignored; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    same = rows.filter(F.octet_length("html") >= revisit_from).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    kind = rows.schema["id"].dataType.simpleString()
    store, place = _place(f"{path}/archive")
    store.create_dir(place)
    index = rows.join(same, "sha1", "left").select("id", "url", "html", "sha1", "first").mapInArrow(K.released(_write(f"{path}/archive")), f"file string, offset long, length long, url string, digest string, id {kind}, record_type string")
    with staging(spark):
        index.write.parquet(f"{path}/index")
    return spark.read.schema(index.schema).parquet(f"{path}/index")


def ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """Rising (offset, length) -> reads of (offset, length, which rows), neighbours joined."""
    out: list[list] = []
    for i, (at, n) in enumerate(rows):
        if out and at - out[-1][1] <= GAP_BYTES and at + n - out[-1][0] <= READ_BYTES:
            out[-1][1] = max(out[-1][1], at + n)
            out[-1][2].append(i)
        else:
            out.append([at, at + n, [i]])
    return [(a, b - a, which) for a, b, which in out]


_RECORD = ["id", "url", "record_type", "digest", "refers_to", "payload_bytes", "payload"]


def _read(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            files, places = batch.column("file").to_pylist(), list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist(), strict=True))
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] != name:
                    if source is not None:
                        source.close()
                    name = files[at]
                    store, place = _place(name)
                    source = store.open_input_file(place)
                for begin, n, which in ranges(places[at:end]):
                    raw = source.read_at(n, begin)
                    found = [parse_record(zlib.decompress(raw[places[at + i][0] - begin :][: places[at + i][1]], 31)) for i in which]
                    cols = [pa.array([f[c] for f in found], t) for c, t in zip(_RECORD, [pa.string()] * 5 + [pa.int64(), pa.binary()], strict=True)]
                    yield pa.RecordBatch.from_arrays(cols[: 7 if payloads else 6], _RECORD[: 7 if payloads else 6])
                at = end
        if source is not None:
            source.close()

    return run


def read_warc(index: DataFrame, *, payloads: bool = False) -> DataFrame:
    """The records of the given index rows: ``id, url, record_type, digest, refers_to, payload_bytes`` (and ``payload``, null of revisits).

    Rows are put in order of (file, offset), dealt to tasks by ranges of it, so that a file may
    be read by several, and near ones read at once. The number of tasks follows the bytes to
    read, not the index's. Ids are strings as in the archive. A response whose payload isn't
    its digest's fails the read.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(ranges_for(size, MOST_READ), min(ranges_for(size, LEAST_READ), 4 * cores))
    chosen = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    schema = "id string, url string, record_type string, digest string, refers_to string, payload_bytes long" + ", payload binary" * payloads
    return chosen.mapInArrow(K.released(_read(payloads)), schema)
