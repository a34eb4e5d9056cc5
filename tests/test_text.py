"""Cleaning, filtering, dedup, batching and chunking on literal cases."""

from __future__ import annotations

import hashlib
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import chunking, cleaning


def one(spark, build, value):
    return spark.createDataFrame([(value,)], "x string").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("<p>Great &amp; sturdy</p>", "Great & sturdy"),
        ("a\n\n  b\t\tc   ", "a b c"),
        ("  <br/>Works  great!<br/>\n\nWould buy   again.  ", "Works great! Would buy again."),
        ("a b\u0085c\u001cd", "a b c d"),
        ("&lt;b&gt;hi&lt;/b&gt;", "<b>hi</b>"),
        ("", ""),
    ],
)
def test_clean_strip_first(spark, value, expected):
    assert one(spark, X.clean_strip_first, value) == expected


def test_clean_decode_first_removes_escaped_tags(spark):
    assert one(spark, X.clean_decode_first, "&lt;b&gt;hi [[VIDEOID:1]] there&lt;/b&gt;") == "hi there"


def test_entities_are_those_of_html_unescape(spark):
    """References closed or not, numeric, unknown, doubled and beside each other; none, empty and null."""
    bits = ["&amp", ";", "&", "&lt;", "&ampx", "&notit;", "&#65", "&#x41;", "&#0;", "&#xD800;", "&#1;", "&#99999999;", "&nosuch;", "&copy;", "&amp;lt;", "&CounterClockwiseContourIntegral;", "a", " ", "é😀", "\n", "#", "\f", "&\u00e9;"]
    rng = random.Random(3)
    texts = [*bits, "", None, *("".join(rng.choices(bits, k=rng.randrange(1, 9))) for _ in range(400))]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", X.decode_entities(F.col("x")).alias("y")).collect()
    assert {r.i: r.y for r in got} == {i: t if t is None else html.unescape(t) for i, t in enumerate(texts)}


def test_named_entities_need_their_semicolon(spark):
    """A page that is cut off within an entity keeps it, as the SQL of ``clean_html_pages`` has it."""
    names = ("copy", "amp")
    for given, expected in {"a &amp": "a &amp", "&ampx; &amp;amp; &copy;&copy": "&ampx; &amp; ©&copy", "&lt;b&gt; &amp": "&lt;b&gt; &amp"}.items():
        assert one(spark, lambda x: X.clean_strip_first(x, names), given) == expected
        assert one(spark, lambda x: X.clean_decode_first(x, names), given) == expected


def test_python_sees_references_alone(spark):
    """The UDF runs on every row, whatever stands about it, so its input is what was found, not the text."""
    plan = spark.createDataFrame([("x",)], "x string").select(X.clean_strip_first(F.col("x")))._jdf.queryExecution().analyzed().toString()
    calls = re.findall(r"_unescape\((.{0,40})", plan)
    assert calls and all(x.startswith("CASE WHEN (size(") for x in calls)


def test_filter_edges(spark):
    rows = [(1, None, "T", "a long enough text here"), (2, 5.0, "T", "too short"), (3, 4.0, "T", "<div class='x'><span>ok</span></div>"), (4, 0.0, "<b>Love</b> it", "exactly fifteen"), (5, 3.0, None, "fourteen chars")]
    kept = cleaning.clean_records(spark.createDataFrame(rows, "id int, rating double, title string, text string")).collect()
    assert [(r.id, r.title, r.text) for r in kept] == [(4, "Love it", "exactly fifteen")]


def test_dedup_keeps_first_and_takes_seen(spark):
    df = spark.createDataFrame([(1, "A", "x"), (2, "A", "y"), (3, "B", "z"), (4, "a ", "w")], "line_number long, text string, asin string")
    got = cleaning.dedup_first(df, order_col="line_number").orderBy("line_number").collect()
    assert [(r.line_number, r.asin) for r in got] == [(1, "x"), (3, "z"), (4, "w")]
    assert [r.line_number for r in cleaning.dedup_first(df, order_col="line_number", ignore_case=True).orderBy("line_number").collect()] == [1, 3]
    assert cleaning.dedup_first(df, order_col="line_number", seen=cleaning.text_hashes(df)).count() == 0


def test_batches_and_hash_ignore_order(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(1, 6)], "line_number long, raw string")
    got = cleaning.batched(df, order_col="line_number", size=2).orderBy("line_number").collect()
    assert [r.batch_id for r in got] == [0, 0, 1, 1, 2]
    both = [spark.createDataFrame(rows, "batch_id int, raw string") for rows in ([(0, "a"), (0, "b")], [(0, "b"), (0, "a")], [(0, "a"), (0, "c")])]
    a, b, c = (cleaning.batch_hashes(df).first().batch_hash for df in both)
    assert a == b != c
    assert a == hashlib.sha256("\n".join(sorted(hashlib.sha256(x).hexdigest() for x in (b"a", b"b"))).encode()).hexdigest()


@pytest.mark.parametrize(("length", "starts"), [(0, []), (400, [0]), (450, [0, 400]), (800, [0, 400]), (1000, [0, 400, 800])])
def test_fixed_chunks(spark, length, starts):
    text = "".join(chr(97 + i % 26) for i in range(length))
    df = spark.createDataFrame([("p", text)], "id string, text string")
    got = chunking.chunk(df, "fixed").orderBy("seq").collect()
    assert [(r.chunk_id, r.text) for r in got] == [(f"p-{i}", text[s : s + 500]) for i, s in enumerate(starts)]


def test_sentence_chunks(spark):
    a, b, c = "a" * 248 + ".", "b" * 249 + ".", "c" * 9 + "."
    df = spark.createDataFrame([("p", f"{a} {b} {c}"), ("q", ""), ("r", "x" * 800)], "id string, text string")
    got = {(r.chunk_id, r.text) for r in chunking.chunk(df, "sentence").collect()}
    assert got == {("p-0", f"{a} {b}"), ("p-1", c), ("r-0", "x" * 800)}


def test_small_functions(spark):
    assert one(spark, X.strip_fence, ' ```json{"a": 1}``` ') == '{"a": 1}'
    assert one(spark, lambda c: X.json_field(c, "decision"), '{"decision": "retry"}') == "retry"
    assert one(spark, lambda c: X.json_field(c, "decision"), '"retry"') is None
    assert one(spark, X.review_id, "  Great ") == hashlib.sha256(b"great").hexdigest()[:16]
    assert one(spark, lambda c: X.enrich(F.lit(""), F.lit("Cat"), c), "t") == "Product: Cat | Review: t"


def test_white_space_is_pythons(spark):
    """Every code point that Python's \\s matches, and no other, is white space, at the ends and in runs."""
    points = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000 and i]
    df = spark.createDataFrame([(i, f"{c}a{c}b{c}{c}c {c}d{c}") for i, c in enumerate(points)], "i int, t string")
    got = df.select("i", X.trim(F.col("t")).alias("trimmed"), X.normalize_whitespace(F.col("t")).alias("one")).collect()
    for r in got:
        t = f"{points[r.i]}a{points[r.i]}b{points[r.i]}{points[r.i]}c {points[r.i]}d{points[r.i]}"
        assert (r.trimmed, r.one) == (t.strip(), re.sub(r"\s+", " ", t).strip(" ")), hex(ord(points[r.i]))


def test_sentences_of_a_long_text(spark):
    """Chunks past several blocks are those that a plain loop makes."""
    said = [f"Sentence {i} has {'many ' * (i % 7)}words." for i in range(5000)]
    expected, held = [], ""
    for x in said:
        if held and len(held) + len(x) + 1 > 60:
            expected, held = [*expected, held], x
        else:
            held = f"{held} {x}".strip()
    expected.append(held)
    df = spark.createDataFrame([(1, " ".join(said)), (2, ""), (3, None)], "id long, text string")
    got = chunking.chunk(df, "sentence", max_chars=60).orderBy("seq").collect()
    assert [r.text for r in got] == expected and len(expected) > 4 * chunking.BLOCK
