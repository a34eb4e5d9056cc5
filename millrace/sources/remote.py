"""Lines of files on a web server, as a Spark data source: byte ranges for tasks, offsets for streams.

``spark.read.format("http_lines").option("url", ..)`` gives ``part, place, start, value``: a part is
a range of bytes that one task fetches, and holds the lines that begin in it; ``place`` counts
them from 0, ``start`` is a line's first byte. Lines end in a newline; the last one may not. A
server that knows no ranges is read by one task. A broken connection is taken up where it broke.
If the file changes meanwhile (its entity tag, where the server gives one) the read fails.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.window import Window

from millrace.functions.text import trim
from millrace.staging import drop_staged, staged

#: Bytes of a part, of one read from the connection, and of a step back in search of the last newline; lines of an Arrow batch.
PART_BYTES, READ_BYTES, BACK_BYTES, BATCH_LINES = 64 << 20, 1 << 20, 1 << 16, 8192
#: Times that a broken connection is taken up, seconds waited before the first (doubled each time), and seconds until a silent one counts as broken.
RETRIES, WAIT, TIMEOUT = 5, 0.2, 60
SCHEMA = "part int, place long, start long, value string"


class Changed(OSError):
    """The file isn't the one that the read began with."""


def _open(url: str, begin: int, tag: str | None):
    headers = {"Range": f"bytes={begin}-", "Accept-Encoding": "identity"} | ({"If-Match": tag} if tag else {})
    try:
        return urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=TIMEOUT)  # noqa: S310
    except urllib.error.HTTPError as e:
        if e.code == 412:
            raise Changed(url) from e
        raise


def describe(url: str) -> tuple[int | None, str | None]:
    """``size, tag`` of a file: its bytes, or None where the server knows no ranges, and its strong entity tag."""
    request = urllib.request.Request(url, headers={"Range": "bytes=0-0", "Accept-Encoding": "identity"})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as r:  # noqa: S310
            tag = r.headers.get("ETag")
            tag = tag if tag and not tag.startswith("W/") else None
            total = (r.headers.get("Content-Range") or "").rpartition("/")[2]
            return (int(total), tag) if r.status == 206 and total.isdigit() else (None, tag)
    except urllib.error.HTTPError as e:
        if e.code == 416:  # nothing at byte 0
            return 0, None
        raise


def _bytes(url: str, begin: int, size: int | None, tag: str | None) -> Iterator[bytes]:
    """The file from a byte on. Short or broken answers are taken up from the byte that is missing."""
    at, left = begin, RETRIES
    while size is None or at < size:
        got = at
        try:
            with _open(url, at, tag) as r:
                if r.status != 206 and at:
                    raise OSError(f"{url} knows no ranges, and the connection broke at byte {at}")
                while block := r.read(READ_BYTES):
                    at += len(block)
                    yield block
            if size is None:
                if (told := r.headers.get("Content-Length")) and at < int(told):
                    raise OSError(f"{url} ended at byte {at} of {told}")
                return
        except Changed:
            raise
        except urllib.error.HTTPError as e:
            if e.code < 500:
                raise
        except OSError:
            if size is None and at:
                raise
        if got == at:
            left -= 1
            if left < 0:
                raise OSError(f"{url} gives nothing at byte {at}")
            time.sleep(WAIT * 2 ** (RETRIES - left - 1))
        else:
            left = RETRIES


def lines_of(blocks: Iterator[bytes], begin: int, stop: int | None, skip: bool) -> Iterator[tuple[int, bytes]]:
    """(first byte, line) of the lines that begin before ``stop``; ``skip``: the bytes up to the first newline belong to an earlier line."""
    held: list[bytes] = []
    start = begin
    for block in blocks:
        *whole, rest = block.split(b"\n")
        for piece in whole:
            line = b"".join([*held, piece])
            held = []
            if not skip:
                if stop is not None and start >= stop:
                    return
                yield start, line
            start, skip = start + len(line) + 1, False
        held.append(rest)
        if not skip and stop is not None and start >= stop:
            return
    if (line := b"".join(held)) and not skip:
        yield start, line


class _Range(InputPartition):
    def __init__(self, part: int, begin: int, stop: int | None, size: int | None, tag: str | None):
        self.part, self.begin, self.stop, self.size, self.tag = part, begin, stop, size, tag


def _ranges(begin: int, stop: int, size: int, tag: str | None, step: int) -> list[_Range]:
    return [_Range(i, at, min(stop, at + step), size, tag) for i, at in enumerate(range(begin, stop, step))]


def _read(url: str, p: _Range) -> Iterator[pa.RecordBatch]:
    begin = max(p.begin - 1, 0)  # the byte before tells whether a line begins here
    found: list[tuple[int, bytes]] = []
    place = 0

    def batch() -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([p.part] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), pa.array([s for s, _ in found], pa.int64()), pa.array([line.decode("utf-8", "replace") for _, line in found], pa.string())],
            ["part", "place", "start", "value"],
        )

    for line in lines_of(_bytes(url, begin, p.size, p.tag), begin, p.stop, p.begin > 0):
        found.append(line)
        if len(found) == BATCH_LINES:
            yield batch()
            place, found = place + len(found), []
    if found:
        yield batch()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.step, self.parts = options["url"], int(options.get("partBytes", PART_BYTES)), int(options.get("parts", 0))

    def partitions(self) -> list[_Range]:
        size, tag = describe(self.url)
        ranges = [_Range(0, 0, None, None, tag)] if size is None else _ranges(0, size, size, tag, self.step)
        return (ranges[: self.parts] if self.parts else ranges) or [_Range(0, 0, 0, 0, tag)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _read(self.url, partition)


class _Stream(DataSourceStreamReader):
    """A file that is only ever appended to; its offset is the byte after a newline, so a line that isn't finished waits."""

    def __init__(self, options: dict):
        self.url, self.step, self.at = options["url"], int(options.get("partBytes", PART_BYTES)), 0

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        size, _ = describe(self.url)
        if size is None:
            raise OSError(f"{self.url} knows no ranges: it can't be a stream")
        stop = size
        while stop > self.at:
            begin = max(self.at, stop - BACK_BYTES)
            got = b""
            for block in _bytes(self.url, begin, stop, None):
                got += block
                if len(got) >= stop - begin:
                    break
            if (k := got[: stop - begin].rfind(b"\n")) >= 0:
                self.at = begin + k + 1
                break
            stop = begin
        return {"at": self.at}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self.at = max(self.at, end["at"])
        # appending changes the tag, so it isn't asked for
        return _ranges(start["at"], end["at"], end["at"], None, self.step)

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _read(self.url, partition)

    def commit(self, end: dict) -> None:
        pass


class HttpLines(DataSource):
    """Options: ``url``; ``partBytes``, the bytes of a task; ``parts``, to read only so many from the beginning."""

    @classmethod
    def name(cls) -> str:
        return "http_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def is_remote(path: str) -> bool:
    return path.startswith(("http://", "https://"))


def read_lines(spark: SparkSession, url: str, *, part_bytes: int = PART_BYTES, parts: int | None = None) -> DataFrame:
    """``line_number, raw`` of a remote file, as ``jsonl.read_lines`` gives them; of its first ``parts`` only, where that is given.

    The file is fetched once: its lines are staged and numbered from the counts of their parts.
    """
    spark.dataSource.register(HttpLines)
    read = spark.read.format("http_lines").option("url", url).option("partBytes", part_bytes)
    lines = staged((read.option("parts", parts) if parts else read).load(), "lines")
    sizes = lines.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row per part
    numbered = lines.join(F.broadcast(before), "part").select((F.col("before") + F.col("place") + 1).alias("line_number"), trim(F.col("value")).alias("raw"))
    numbered.staged_at = lines.staged_at
    return numbered


def first_lines(spark: SparkSession, url: str, *, skip: int, limit: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """As many parts from the beginning of a remote file as hold ``limit`` lines with something on them after the first ``skip``; twice as many at each try."""
    parts = 1
    size, _ = describe(url)
    while True:
        found = read_lines(spark, url, part_bytes=part_bytes, parts=parts)
        if size is None or parts * part_bytes >= size or found.filter((F.col("line_number") > skip) & (F.col("raw") != "")).count() >= limit:
            return found
        drop_staged(found)
        parts *= 2


def stream_lines(spark: SparkSession, url: str, *, part_bytes: int = PART_BYTES) -> DataFrame:
    """``raw, file, start`` of the lines of a remote file that grows."""
    spark.dataSource.register(HttpLines)
    lines = spark.readStream.format("http_lines").option("url", url).option("partBytes", part_bytes).load()
    return lines.select(trim(F.col("value")).alias("raw"), F.lit(url).alias("file"), "start")
