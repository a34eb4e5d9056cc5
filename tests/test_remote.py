"""Lines from a web server: exact numbers whatever the ranges, broken connections, servers without ranges, files that change or grow."""

from __future__ import annotations

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from millrace.sources import jsonl, remote
from millrace.streaming import worker


class Files(BaseHTTPRequestHandler):
    body, ranges, tag, cut, asked = b"", True, None, 0, []

    def do_GET(self):
        whole, kind = Files.body, Files
        given = self.headers.get("Range", "")[6:]
        begin, _, end = given.partition("-")
        kind.asked.append(given)
        if self.headers.get("If-Match") not in (None, kind.tag):
            return self.answer(412, b"")
        if not kind.ranges:
            return self.answer(200, whole)
        if int(begin) >= len(whole):
            return self.answer(416, b"")
        part = whole[int(begin) : int(end) + 1 if end else None]
        self.answer(206, part, f"bytes {begin}-{int(begin) + len(part) - 1}/{len(whole)}")

    def answer(self, status: int, part: bytes, span: str | None = None) -> None:
        self.send_response(status)
        self.send_header("Content-Length", str(len(part)))
        if span:
            self.send_header("Content-Range", span)
        if Files.tag:
            self.send_header("ETag", Files.tag)
        self.end_headers()
        if Files.cut and len(part) > Files.cut:
            part = part[: Files.cut]  # the connection breaks
            self.close_connection = True
        self.wfile.write(part)

    def log_message(self, *args) -> None:
        pass


@pytest.fixture
def url():
    Files.body, Files.ranges, Files.tag, Files.cut, Files.asked = b"", True, None, 0, []
    server = ThreadingHTTPServer(("127.0.0.1", 0), Files)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/reviews.jsonl"
    server.shutdown()


TEXT = "".join(f'{{"rating": {i % 6}, "text": "é{"x" * (i * 7 % 60)} {i}"}}\n' if i % 9 else "\n" if i % 2 else "  \t\r\n" for i in range(400))


@pytest.mark.parametrize("part", [1, 7, 64, 1000, 1 << 20])
def test_lines_begin_in_one_range_each(part):
    """Each line once, wherever the ranges are cut: within characters, before and after newlines."""
    for body in (TEXT[:1200].encode(), b"\n\nab\n\nc", b"no newline", b"a\nb\n"):
        blocks = lambda at, body=body: iter([body[i : i + 5] for i in range(at, len(body), 5)])
        found = []
        for begin in range(0, len(body), part):
            at = max(begin - 1, 0)
            found += remote.lines_of(blocks(at), at, begin + part, begin > 0)
        lines = body.split(b"\n")
        assert [x for _, x in found] == (lines[:-1] if lines[-1] == b"" else lines)
        assert all(body[s : s + len(x)] == x for s, x in found)


def test_numbers_are_the_local_readers(spark, tmp_path, url):
    (tmp_path / "in.jsonl").write_text(TEXT)
    Files.body = TEXT.encode()
    local = sorted(map(tuple, jsonl.read_lines(spark, str(tmp_path / "in.jsonl")).collect()))
    found = remote.read_lines(spark, url, part_bytes=1500)
    assert sorted(map(tuple, found.collect())) == local and len({a for a in Files.asked if a != "0-0"}) == -(-len(Files.body) // 1500)
    Files.cut = 700  # every answer breaks off
    assert sorted(map(tuple, remote.read_lines(spark, url, part_bytes=1500).collect())) == local
    Files.cut, Files.ranges = 0, False
    assert sorted(map(tuple, remote.read_lines(spark, url, part_bytes=1500).collect())) == local
    Files.cut = 700
    with pytest.raises(Exception, match="ended at byte|IncompleteRead|knows no ranges"):
        remote.read_lines(spark, url, part_bytes=1500)


def test_skip_and_limit(spark, tmp_path, monkeypatch, url):
    (tmp_path / "in.jsonl").write_text(TEXT)
    Files.body = TEXT.encode()
    read = lambda path, **o: sorted((r.line_number, r.raw) for r in jsonl.read_reviews(spark, path, **o).collect())
    for options in ({"skip": 100, "limit": 7}, {"limit": 0}, {"skip": 395}):
        assert read(url, **options) == read(str(tmp_path / "in.jsonl"), **options)
    Files.asked.clear()
    few = remote.first_lines(spark, url, skip=10, limit=5, part_bytes=1000)
    assert few.filter("line_number > 10 and raw <> ''").count() >= 5 and len(Files.asked) < 6


def test_empty_missing_and_changed(spark, monkeypatch, url):
    assert remote.read_lines(spark, url).count() == 0
    with pytest.raises(Exception, match="refused"):
        remote.read_lines(spark, "http://127.0.0.1:9/none")
    Files.body, Files.tag = TEXT.encode(), '"one"'
    assert remote.describe(url) == (len(Files.body), '"one"')
    with pytest.raises(remote.Changed):
        next(remote._bytes(url, 0, len(Files.body), '"two"'))


def test_stream_of_a_growing_file(spark, tmp_path, url):
    """Finished lines once each, over restarts; the unfinished last line waits for its newline."""
    found = []
    go = lambda: worker.run_batches(remote.stream_lines(spark, url, part_bytes=200), lambda batch, _: found.extend(r.raw for r in batch.orderBy("start").collect()), str(tmp_path / "cp"))
    whole = TEXT.encode()
    expected = [line.strip() for line in TEXT.split("\n")[:-1]]
    for upto in (500, 510, 900, len(whole)):
        Files.body = whole[:upto]
        go()
        assert found == expected[: whole[:upto].count(b"\n")]
