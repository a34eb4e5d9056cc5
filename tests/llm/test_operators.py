"""Each training-data operator against brute force, on rows chosen to be awkward: nulls, empty and repeated rows, ties, clashing columns."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import chat, mixing, packing, pivots, quality, sharding, suffix_dedup, token_store, warc
from millrace.llm.ngram_join import drop_near_copies, ngram_components, ngram_links
from millrace.llm.suffixes import common_prefixes, suffix_array
from millrace.llm.tokens import Encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key long, g long, taken string"


def awkward() -> list[tuple]:
    """Texts with copies, near copies, repeats inside, nulls, and a long one; ids with a null and a repeat."""
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdeéß.,") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = [text(rng.randint(1, 200)) for _ in range(30)]
    near = []
    for _ in range(12):
        w = base[3].split() + base[4].split()
        w[rng.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    passage = text(60)
    texts = base + near + [base[5], base[5].upper(), passage + " " + text(20), text(15) + " " + passage, "a" * 900, "xy " * 400, text(4000), None, "", " \n\t ", "one", "one two", "One\ttwo", None]
    rows = [(i, t, ["en", "de", None][i % 3], [None, "s1", "s2", "s3"][i % 4], 0, 1, 2, 3, "x") for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "a text without an id of its own", "en", "s1", 0, 1, 2, 3, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, k, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    ids = {}
    for a in range(len(rows)):
        ids.setdefault(find(a), []).append(rows[a][0])
    expected = Counter((rows[a][0], len(sets[a]), min((i for i in ids[find(a)] if i is not None), default=None)) for a in range(len(rows)))
    got = ngram_components(docs, words=k, percent=percent).collect()
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == expected


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_links(docs, empty, k, percent):
    """All links and their numbers, within components too."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    linked = lambda x, y: bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)
    expected = Counter((i, len(x), sum(linked(x, y) for y in sets) - bool(x)) for (i, _), x in zip(rows, sets, strict=True))
    got, pairs = ngram_links(docs, words=k, percent=percent)
    got = got.collect()
    assert Counter((r.id, r.n_shingles, r.n_links) for r in got) == expected
    different = sorted(set(sets), key=sorted)
    between = sum(linked(x, y) for n, x in enumerate(different) for y in different[:n])
    pairs = {frozenset(p) for p in pairs.collect()}
    assert len(pairs) == between > 20 and set().union(*pairs) <= {r.class_id for r in got}
    assert [x.count() for x in ngram_links(empty, words=k, percent=percent)] == [0, 0]


def test_near_copies_leave_one_of_each(docs, empty):
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    comps = ngram_components(docs).filter("n_shingles > 0").select("component_id").distinct().count()
    wordless = sum(1 for r in awkward() if not WORD.search(r[1] or ""))
    assert kept.count() == comps + wordless
    assert drop_near_copies(empty).count() == 0


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(300):
        b = bytes(97 + rng.randrange(rng.choice([1, 2, 4, 26])) for _ in range(rng.randint(0, 50)))
        s = np.frombuffer(b, np.uint8)
        order = sorted(range(len(b)), key=lambda i: b[i:])
        assert suffix_array(s).tolist() == order
        prefix = common_prefixes(s, suffix_array(s), 60)
        for i, j in zip(order[1:], order, strict=False):
            assert prefix[i] == len(os.path.commonprefix([b[i:], b[j:]]))


@pytest.mark.parametrize("wide", [0, 4096])
def test_suffix_dedup(docs, empty, monkeypatch, wide):
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    expected = Counter()
    for i, b in rows:
        cover = np.zeros(len(b) + 1, np.int32)
        for j in range(len(b) - 199):
            if seen[b[j : j + 200]] > 1:
                cover[j] += 1
                cover[j + 200] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected[(i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())] += 1
    got = suffix_dedup.removal_digests(docs)
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert suffix_dedup.removal_digests(empty).count() == 0
    if wide:
        left = suffix_dedup.remove_repeats(docs)
        assert left.count() == len(rows) and left.filter("text is null").count() == 2


def test_quality_counts_and_thresholds(docs, empty):
    expected = Counter()
    for r in docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = Counter(three)
        cover = {i + j for i, x in enumerate(three) if n[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        expected[(r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed)] += 1
    found = quality.quality_verdicts(docs)
    names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r) for r in found.select(*names).collect()) == expected
    assert found.filter("base_failed and kept").count() == 0
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == found.filter("kept").count()
    assert quality.quality_verdicts(empty).count() == 0


def test_thresholds_follow_their_group(spark):
    """A measure that is usual in one group and odd in another is judged by the group."""
    rows = [(i, "en", "prose" if i % 2 else "code", 100, 500, 0 if i % 2 else 40, 0, 0, 10) for i in range(1000)]
    rows += [(-1, "en", "prose", 100, 500, 40, 0, 0, 10)]
    counted = spark.createDataFrame(rows, "id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    cut = {r.source: r.symbols_hi for r in quality.thresholds(counted).collect()}
    assert cut["prose"] < 400 <= cut["code"]
    halves = quality.sketches(counted.filter("id % 2 = 0")).union(quality.sketches(counted.filter("id % 2 <> 0")))
    assert sorted(quality.merged(halves, "lang", "source").collect()) == sorted(quality.sketches(counted).collect())


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(next(x.text for x in docs.collect() if x.doc_id == r.id) or "")) if r.id is not None else True
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
    order = sorted(x for x in sizes if x is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, open_ = {}, set(order)
    while True:  # the law as written: cut at the cap, reshare by weight
        rest = sum(sizes.values()) - sum(goal.values())
        over = {s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > 3 * sizes[s]}
        if not over:
            break
        goal |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    goal |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s in order:
        target = {r.target for r in rows if r.source == s}.pop()
        assert target == pytest.approx(goal[s])
        assert 0 <= target - sum(r.taken for r in rows if r.source == s) < 1.001
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns
    assert made.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0


def test_heavier_documents_come_first(spark):
    df = spark.createDataFrame([(i, "w w", "a") for i in range(2000)] + [(i, "w", "b") for i in range(5000, 12000)], "doc_id long, text string, source string")
    q = spark.createDataFrame([(i, 9.0 if i < 1000 else 1.0) for i in range(2000)], "doc_id long, quality double")
    # source a: target 3 times its size at most; its fraction prefers quality
    rows = mixing.mix(df, quality=q, seed="t").filter("source = 'b'").select(F.sum("taken"), F.max("target")).first()
    assert abs(rows[0] - rows[1]) < 1


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(docs, empty):
    rows = sharding.shard_rows(docs, 40).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    slots = {}
    for r in rows:
        key = (0 if r.id is None else r.id) % (1 << 64)
        assert (r.shard, r.grown_shard) == (jump(key, 40), jump(key, 41))
        assert r.grown_shard in (r.shard, 40)
        assert (r.size, r.text_crc32) == (len(texts[r.id].encode()) + 16, zlib.crc32(texts[r.id].encode()))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(empty, 40).count() == 0


def test_jump_of_wide_keys(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 123456789012345]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump(F.col("k"), 1000).alias("j")).collect()
    assert [r.j.shard for r in got] == [jump(r.k % (1 << 64), 1000) for r in got]


def test_chat_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y", "\\b\\e\\h\\c", "\\", "", None, "</turn", "a: b", "é😀</turn>\n", "\\\\e", "x" * 5000]
    roles = ["user", "assistant", "a: b", "### ", "</turn>\n", None, "assistant", ""]
    rows = [(c, t, roles[(c + t) % len(roles)], odd[(3 * c + t) % len(odd)], "extra") for c in range(-2, 9) for t in range(6)] + [(None, 0, "assistant", "null conversation", "e"), (1, None, "assistant", "first", "e"), (1, 3, "user", "tie", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df)
    assert made.filter("not round_trip").count() == 0
    back = {r.conv: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        assert [(x.role, x.text) for x in back[conv].turns] == [(r, x) for *_, r, x in turns]
        assert back[conv].loss_text == "".join(x for *_, r, x in turns if r == "assistant")
    assert chat.format_conversations(df.limit(0)).count() == 0


def ids_of(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [np.array(e.ids + [2], np.uint32) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoder_equals_the_tokenizer():
    rng = random.Random(5)
    letters = "aB.,'!<|> \n\té́ ​中1२-_/<|endoftext|>sSdDmMlLrRvVeE"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)] + ["don't 'S <|startoftext|>x İstanbul ß", None]
    encoder = Encoder(TOKENIZER)
    assert encoder.apart
    ids, offs = encoder.encode(pa.array(texts))
    for i, e in enumerate(ids_of(texts)):
        assert ids[offs[i] : offs[i + 1]].tolist() == e[:-1].tolist()


def test_packing(docs, empty):
    pieces = packing.pack(docs, TOKENIZER, size=512, with_ids=True).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter((i, ids.tobytes()) for (i, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True))
    by_sequence, open_, got = {}, {}, Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_sequence.setdefault(p.sequence_id, []).append(p)
        if p.start == 0:
            open_[p.id] = b""
        assert len(open_[p.id]) == 4 * p.start
        open_[p.id] += p.ids
        if p.start + p.length == p.doc_tokens:
            got[(p.id, open_.pop(p.id))] += 1
    assert got == want and not open_
    for ps in by_sequence.values():
        at = 0
        for p in ps:
            assert p.offset == at
            at += p.length
        assert at <= 512
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_cuts_are_optimal():
    rng = random.Random(2)
    for _ in range(50):
        cuts = np.concatenate([[0], np.cumsum([rng.randint(1, 200) for _ in range(30)])])
        penalty = np.array([0.0] + [rng.choice([0, 8, 64]) for _ in range(29)] + [0.0])
        best = [0.0] + [float("inf")] * 30

        def cost(i, j, cuts=cuts, penalty=penalty):
            n = int(cuts[j] - cuts[i])
            return min(1024 - n, packing.SHORT if n >= 256 and n & (n - 1) == 0 and n < 1024 else 1e9) + penalty[j] if n <= 1024 else float("inf")

        for j in range(1, 31):
            best[j] = min(best[i] + cost(i, j) for i in range(j))
        found = packing.choose_cuts(cuts, penalty, 1024)
        at = [cuts.tolist().index(x) for x in found]
        assert sum(cost(i, j) for i, j in zip(at, at[1:], strict=False)) == pytest.approx(best[30])


def test_token_store(spark, docs, empty, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs, path, TOKENIZER)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text) for r in docs.collect()), key=lambda x: x[:2])
    ids = ids_of([t for *_, t in rows])
    found = token_store.document_digests(spark, path).collect()
    assert Counter((r.id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i if has else None, len(e), zlib.crc32(e.tobytes())) for (has, i, _), e in zip(rows, ids, strict=True))
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    whole = Counter((r.id, tuple(r.ids)) for r in token_store.read_store(spark, path).collect())
    assert whole == Counter((i if has else None, tuple(e.tolist())) for (has, i, _), e in zip(rows, ids, strict=True))
    assert spark.read.parquet(f"{path}/chunks").groupBy("digest").count().filter("count > 1").count() == 0
    token_store.write_store(empty, f"file://{tmp_path}/none", TOKENIZER)
    assert token_store.document_digests(spark, f"file://{tmp_path}/none").count() == 0


def test_damaged_store_fails(spark, docs, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs.limit(5), path, TOKENIZER)
    chunks = spark.read.parquet(f"{path}/chunks")
    chunks.limit(chunks.count() - 1).write.parquet(f"{path}/fewer")
    os.rename(f"{tmp_path}/store/chunks", f"{tmp_path}/store/old")
    os.rename(f"{tmp_path}/store/fewer", f"{tmp_path}/store/chunks")
    with pytest.raises(Exception, match="a chunk is missing"):
        token_store.document_digests(spark, path).collect()


def test_warc(spark, tmp_path):
    pages = [(i, None if i == 4 else f"http://x/{i}\r\nBad: header", [None, "", "<p>é\r\n\r\n</p>", "same", "WARC/1.1"][i % 5], "x") for i in range(25)] + [(None, "u", "same", "y"), (3, "u", "same", "y"), (99, "u", "z" * 300_000, "y")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, sha1 string").repartition(3)
    index = warc.write_warc(df, f"file://{tmp_path}/warc")
    got = Counter((r.id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in warc.read_warc(index).collect())
    first, expected = {}, Counter()
    for i, _, html, _ in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    for i, _, html, _ in pages:
        b = (html or "").encode()
        head = i == first[html or ""]
        expected[(None if i is None else str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if head else "revisit", None if head else str(first[html or ""]))] += 1
    assert got == expected
    some = warc.read_warc(index.filter("id in (2, 99)"), payloads=True).collect()
    assert {(r.id, bytes(r.payload).decode()) for r in some} == {("2", "<p>é\r\n\r\n</p>"), ("99", "z" * 300_000)}
    assert warc.read_warc(warc.write_warc(df.limit(0), f"file://{tmp_path}/none")).count() == 0


def test_ranges_join_neighbours():
    assert warc.ranges([(0, 10), (10, 5), (200_000, 10)]) == [(0, 15, [0, 1]), (200_000, 10, [2])]


@pytest.mark.parametrize("block", [16, 1024])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 32))
    rows = []
    for i in range(400):
        v = base[i % 12] + rng.normal(size=32) * rng.choice([0.0, 0.15, 0.3, 0.5])
        rows.append((i, v.astype(np.float32).tolist(), i % 5 if i % 5 else None, "x"))
    rows += [(1000, None, 1, "x"), (1001, [0.0] * 32, 1, "x"), (1002, [float("nan")] * 32, 1, "x"), (1003, [None] + [1.0] * 31, 1, "x"), (1004, [], 1, "x"), (1005, [1.0, 0.0], 1, "x"), (1006, [2.0, 0.1], 1, "x"), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, links string")
    ok = [(i, np.array(v, np.float32).astype(np.float64), lab) for i, v, lab, _ in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, up = Counter(), list(range(len(ok)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(ok)):
        for b in range(a):
            if ok[a][2] == ok[b][2] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] / np.linalg.norm(ok[a][1]) / np.linalg.norm(ok[b][1]) >= 0.93:
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    got = pivots.near_vectors(df).collect()
    assert len(got) == len(rows)
    total = sum(r.n_links for r in got)
    assert 0.98 * sum(links.values()) <= total <= sum(links.values())
    least = {}
    for a in range(len(ok)):
        least[find(a)] = min(least.get(find(a), ok[a][0]), ok[a][0])
    comp = {ok[a][0]: least[find(a)] for a in range(len(ok))}
    assert sum(r.component_id != comp.get(r.id, r.id) for r in got) <= 4
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert pivots.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [700, 2048])
def test_near_vectors_of_a_large_group(spark, monkeypatch, block):
    """A third of the rows are near copies of one vector, with many links near the threshold: none is lost."""
    monkeypatch.setattr(pivots, "BLOCK", block)
    rng = np.random.default_rng(5)
    n, least = 21_000, 0.93
    x = rng.normal(size=(n, 64))
    x[::3] = rng.normal(size=64) + 0.22 * rng.normal(size=(n // 3, 64))
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": x.tolist(), "label": 1}))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = np.concatenate([(unit[k : k + 1000] @ unit.T >= least).sum(axis=1) - 1 for k in range(0, n, 1000)])
    got = pivots.near_vectors(df, least=least, nearest=0).toPandas().sort_values("id")
    assert links.sum() > 40_000_000 and (got["n_links"].to_numpy() == links).all()
    expected = np.where(np.arange(n) % 3 == 0, 0, np.arange(n))
    assert (links[::3] > 0).all() and (got["component_id"].to_numpy() == expected).all()


def vectors_of(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    if kind == "pairs":  # half of the rows are partners, at cosines on either side of the threshold
        half = n // 2
        t = rng.uniform(0.9, 0.99, size=(half, 1))
        unit = x[:half] / np.linalg.norm(x[:half], axis=1, keepdims=True)
        side = x[half : 2 * half] - (x[half : 2 * half] * unit).sum(axis=1, keepdims=True) * unit
        x[half : 2 * half] = t * unit + np.sqrt(1 - t * t) * side / np.linalg.norm(side, axis=1, keepdims=True)
    if kind == "group":  # one group whose pairs lie about the threshold, five of eight rows
        x[: 5 * n // 8] = rng.normal(size=64) + 0.265 * rng.normal(size=(5 * n // 8, 64))
    if kind == "clusters":  # loose clusters, few of whose pairs link
        x = rng.normal(size=(20, 64))[rng.integers(0, 20, n)] + 0.4 * rng.normal(size=(n, 64))
    return x.astype(np.float32).astype(np.float64)


@pytest.mark.parametrize(("kind", "n"), [("pairs", 1000), ("pairs", 5000), ("pairs", 20_000), ("group", 8000), ("clusters", 8000)])
def test_recall_of_the_index(spark, kind, n):
    """Of the links that brute force finds, the index finds 99 in a hundred, and none that isn't one."""
    x = vectors_of(kind, n)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = np.concatenate([(unit[k : k + 1000] @ unit.T >= 0.93).sum(axis=1) - 1 for k in range(0, n, 1000)])
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": x.tolist(), "label": 1}))
    got = pivots.near_vectors(df).toPandas().sort_values("id")["n_links"].to_numpy()
    assert links.sum() > 0 and (got <= links).all()
    assert got.sum() >= 0.99 * links.sum(), got.sum() / links.sum()


def test_pivots_are_spread():
    """A group of near copies holds one pivot, however many of the sample it has; nearest pivots are fitted to the sample's links."""
    x = vectors_of("group", 4000)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    chosen = pivots.spread(unit, 100)
    centre = unit[:2500].mean(axis=0)
    assert len(chosen) == 100 and (chosen @ centre / np.linalg.norm(centre) > 0.8).sum() <= 1
    assert len(pivots.spread(np.repeat(unit[:1], 50, axis=0), 10)) == 1
    assert pivots.fitted(unit, chosen, 0.93) >= pivots.NEAREST
    assert pivots.fitted(unit[2500:], chosen, 0.999999) == pivots.NEAREST


def test_parities_never_refuse_a_link():
    """The suffix filters' bound holds at any sizes: sets that link are never refused, far ones are."""
    from millrace.llm import ngram_join as J

    rng = np.random.default_rng(2)
    for percent, n in ((90, 5), (90, 700), (80, 3000), (80, 1100)):
        a = np.unique(rng.integers(0, 1 << 48, n)).astype(np.uint64)
        for change in (0, 1, n // 30, n // 12, n // 3, n):
            keep = a[change:]
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 48, change // 2).astype(np.uint64)]))
            if not len(b):
                continue
            both = len(np.intersect1d(a, b))
            rows = [pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([J._parity(a)], pa.binary()), pa.array([J._parity(b)], pa.binary())], ["a", "b", "x", "y"])]
            kept = sum(r.num_rows for r in J._near(percent)(iter(rows)))
            assert kept or both * (100 + percent) < percent * (len(a) + len(b))
            if n > 600 and change == n:
                assert not kept


def test_postings_meet_across_batches():
    """Buckets of any length, cut anywhere into batches, come with their first; lone ones go, unless they are parts of a large bucket."""
    from millrace.llm import ngram_join as J

    rng = np.random.default_rng(3)
    bucket = np.sort(np.concatenate([rng.integers(0, 40, 60), [50] * 30, [60], [(1 << 48) + 70], [(1 << 48) + 71] * 3]))
    place, node = np.arange(len(bucket)) << 32 | 9, np.arange(100, 100 + len(bucket))
    first = {int(b): int(n) for b, n in zip(bucket[::-1], node[::-1], strict=True)}
    often = Counter(bucket.tolist())
    expected = [(int(b) & (1 << 48) - 1, int(b) >> 48, int(n), first[int(b)]) for b, n in zip(bucket, node, strict=True) if often[int(b)] > 1 or b >> 48]
    for step in (1, 2, 3, 7, 1000):
        parts = [pa.RecordBatch.from_arrays([pa.array(c[i : i + step]) for c in (bucket, place, node)], ["bucket", "place", "node"]) for i in range(0, len(bucket), step)]
        got = [tuple(r[c] for c in ("g", "part", "node", "p_node")) for b in J._met(iter(parts)) for r in b.to_pylist()]
        assert got == expected


def test_large_buckets_are_dealt(spark, monkeypatch):
    """Near copies whose buckets are cut into parts are one component as well."""
    from millrace.llm import ngram_join as J

    monkeypatch.setattr(J, "PART", 2)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = [(i, " ".join([*base[: 5 + i], f"x{i}", *base[6 + i :]])) for i in range(60)] + [(100 + i, f"other {i} text of few words") for i in range(5)]
    got = {r.id: r.component_id for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=90).collect()}
    assert got == {i: 0 if i < 100 else i for i, _ in rows}


def test_coarse_sketch_and_small_parts(docs, monkeypatch):
    """With a sketch so coarse that all its buckets look large, and parts and meetings of two, results are those of brute force."""
    from millrace.llm import ngram_join as J

    for name, v in (("MOST_BUCKETS", 8), ("LEAST_BUCKETS", 8), ("PART", 2), ("MEET", 2), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(J, name, v)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append(frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else []))
    linked = lambda x, y: bool(x) and bool(y) and 100 * len(x & y) >= 90 * len(x | y)
    expected = Counter((i, len(x), sum(linked(x, y) for y in sets) - bool(x)) for (i, _), x in zip(rows, sets, strict=True))
    assert Counter((r.id, r.n_shingles, r.n_links) for r in ngram_links(docs, words=3, percent=90)[0].collect()) == expected
    plain = Counter(tuple(r) for r in ngram_components(docs, words=3, percent=90).select("id", "component_id").collect())
    monkeypatch.undo()
    assert plain == Counter(tuple(r) for r in ngram_components(docs, words=3, percent=90).select("id", "component_id").collect())


def test_frequent_ngrams_that_link_nothing(spark):
    """Texts that all share a passage and nothing else: the pairs that meet don't grow with their square."""
    from millrace.llm import ngram_join as J

    shared = " ".join(f"common{i}" for i in range(40))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(9)) + " " + shared) for i in range(3000)]
    seen, paired = [], J._paired

    def counted(*args):
        met = paired(*args)
        seen.append(met.count())
        return met

    J._paired = counted
    try:
        found = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=80).collect()
    finally:
        J._paired = paired
    assert all(r.component_id == r.id for r in found) and sum(seen) <= 3000


@pytest.mark.parametrize("rows", [200_000, 1_000_000])
def test_recall_at_large_sizes(rows):
    """Planted pairs just above the threshold still meet where a sample holds next to no links: index structures of so many vectors, on a part of them."""
    rng = np.random.default_rng(rows)
    unit = lambda x: x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    sample = unit(rng.normal(size=(pivots.SAMPLE, 64)))
    points = pivots.rounded(pivots.spread(sample, min(2000, int(pivots.PER_ROOT * rows**0.5))))
    k = pivots.fitted(sample, pivots._unit(points), 0.93)
    x = unit(rng.normal(size=(3000, 64)))
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    y = 0.932 * x + (1 - 0.932**2) ** 0.5 * away
    both = np.concatenate([x, y]).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in both], pa.binary())], ["x"])
    out = pa.Table.from_batches(list(pivots._cells({64: points}, {64: k}, 0.93, "<f4")(iter([batch]))))
    cells, near = out.column("cells").to_pylist(), [set(np.frombuffer(b, "<u2").tolist()) for b in out.column("near").to_pylist()]
    meet = [(c[0] in d or d[0] in c) and (not n or len(n & m) >= pivots.SHARED) for c, d, n, m in zip(cells[:3000], cells[3000:], near[:3000], near[3000:], strict=True)]
    assert len(points) > 1500 and np.mean(meet) >= 0.99


def test_texts_of_tens_of_megabytes(spark):
    """Long texts go whole through the text operators; every operator's counts are those of plain Python."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(50_000)}" for _ in range(2_000_000)]
    text = " ".join(words)
    df = spark.createDataFrame([(1, text, "en", "s"), (2, text[: len(text) // 2] + " end", "en", "s"), (3, "short", None, None)], "doc_id long, text string, lang string, source string")
    assert len(text) > 12_000_000
    got = {r.id: r for r in ngram_components(df, words=3, percent=90).collect()}
    assert got[1].n_shingles == len({tuple(words[i : i + 3]) for i in range(len(words) - 2)}) and got[2].component_id == 2
    found = {r.id: r for r in suffix_dedup.removal_digests(df).collect()}
    assert found[1].n_removed == len(text) // 2 and found[2].n_removed == len(text) // 2 and found[2].n_spans == 1
    counted = {r.id: r.n_words for r in quality.quality_verdicts(df).collect()}
    assert counted[1] == len(words) and counted[3] == 1
    pieces = packing.pack(df, TOKENIZER).groupBy("id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r.n == r.all for r in pieces) and len(pieces) == 3
    head = Tokenizer.from_file(TOKENIZER).encode(text[:10_000], add_special_tokens=False).ids[:2000]
    assert Encoder.of(TOKENIZER).encode(pa.array([text]))[0][: len(head)].tolist() == head


def test_piece_table_grows():
    from millrace.llm.tokens import _Table

    table = _Table(bits=2)
    h = np.random.default_rng(1).integers(1, 1 << 63, 5000).astype(np.uint64)
    h = np.unique(h)
    for k in range(0, len(h), 700):
        part = h[k : k + 700]
        table.add(part, np.arange(k, k + len(part)), np.ones(len(part), np.int32))
    assert (table.at[table.find(h)] == np.arange(len(h))).all() and (table.find(h ^ np.uint64(1 << 63)) == -1).all()


def test_ids_wider_than_the_store_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    with pytest.raises(Exception, match="needs more than 1 bytes"):
        token_store.write_store(df, str(tmp_path / "s"), TOKENIZER, width=1)


def test_small_group_beside_a_hot_one(spark):
    """A small source is judged by itself, not by the language's large one: no switch by its size."""
    prose = [(i, "en", "hot", 100, 500, 0, 0, 0, 10) for i in range(1000)]
    schema = "id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    tops = []
    for n in (100, 199, 200, 201):
        code = [(-i - 1, "en", "code", 100, 500, 40, 0, 0, 10) for i in range(n)]
        cut = {r.source: r.symbols_hi for r in quality.thresholds(spark.createDataFrame(prose + code, schema)).collect()}
        assert cut["hot"] < 400 <= cut["code"]
        tops.append(cut["code"])
    assert max(abs(np.diff(tops[1:]))) < 2


def test_thresholds_of_measures_that_are_mostly_zero(spark):
    """Texts that repeat are judged by those of their group that repeat, however few; without any, by their language's."""
    schema = "id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    plain = [(i, "en", s, 1000, 5000, 0, 0, 0, 100) for i in range(2000) for s in ("logs", "prose", "none")]
    logs = [(i, "en", "logs", 1000, 5000, 0, 20 + i % 20, 200 + i % 200, 100) for i in range(200)]
    prose = [(i, "en", "prose", 1000, 5000, 0, 1 + i % 2, 5 + i % 5, 100) for i in range(200)]
    cut = {r.source: r for r in quality.thresholds(spark.createDataFrame(plain + logs + prose, schema)).collect()}
    assert cut["prose"].repeats_hi < 250 and cut["logs"].repeats_hi > 450 and cut["prose"].dup_lines_hi < 300 < 450 < cut["logs"].dup_lines_hi
    assert cut["prose"].repeats_hi < cut["none"].repeats_hi and cut["none"].dup_lines_hi is not None
    # nothing above zero in the whole language: the least distance alone, and every row is kept
    flat = [(*r[:1], "de", *r[2:]) for r in plain]
    least = quality.thresholds(spark.createDataFrame(flat, schema)).first()
    assert (least.repeats_hi, least.dup_lines_hi) == (100.0, 250.0)


def test_sketch_error(spark):
    """Quantiles of the sketch are within ACCURACY of the true ones."""
    rng = np.random.default_rng(8)
    n_symbols = np.ceil(rng.lognormal(3, 1, 2000)).astype(int)
    rows = [(i, "en", "s", 1000, 5000, int(v), 0, 0, 10) for i, v in enumerate(n_symbols)]
    counted = spark.createDataFrame(rows, "id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    q = quality.quantiles(quality.sketches(counted), "lang", "source").filter("measure = 'symbols'").first()
    for found, share in ((q.q1, 0.25), (q.q2, 0.5), (q.q3, 0.75)):
        true = np.sort(n_symbols)[int(np.ceil(share * len(n_symbols))) - 1]
        assert abs(found - true) <= quality.ACCURACY * true + 1e-9


def test_columns_of_any_name(spark):
    """Columns named as the operators' own pass through."""
    names = ["row", "key", "text2", "has", "n_words", "symbols_lo", "symbols_hi", "kept", "base_failed", "parts", "taken", "size", "__mr_key", "__mr_parts", "__mr_text", "cut_lang"]
    rows = [(i, " ".join(f"word{j * (i + 1) % 97}" for j in range(80)), "en", "s", *[f"{c}{i}" for c in names]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in names))
    for made in (quality.keep_quality(df), drop_near_copies(df), suffix_dedup.remove_repeats(df), mixing.mixed_documents(df)):
        assert made.columns == df.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in made.collect() for c in names)


def test_damaged_conversations_are_refused(spark):
    df = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df)
    whole = made.select(chat.parse(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in whole] == [("user", "hello"), ("assistant", "yes")]
    for damage in (F.concat("formatted", F.lit("tail")), F.expr("substring(formatted, 1, length(formatted) - 2)"), F.concat("formatted", F.lit("### user: open"))):
        assert made.select(chat.parse(damage).alias("t")).first().t[-1] is None
    assert made.select(chat.parse(F.lit("")).alias("t")).first().t == []


def test_archive_is_read_by_ranges(spark, tmp_path, monkeypatch):
    """One file is read by several tasks, each record once."""
    monkeypatch.setattr(warc, "LEAST_READ", 2000)
    rng = random.Random(9)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abcdef") for _ in range(600))) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    index = warc.write_warc(pages, str(tmp_path / "w"))
    back = warc.read_warc(index)
    assert index.select("file").distinct().count() == 1 and back.rdd.getNumPartitions() > 4
    assert sorted(int(r.id) for r in back.collect()) == list(range(60))


def test_packing_does_not_depend_on_batches(spark):
    """Cuts follow a range's documents, not the batches in which they reach the worker; only a range's last sequence is padded or short."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"word{rng.randrange(300)}" + rng.choice(["", "", ".", "!"]) for _ in range(rng.randrange(1, 900)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        found.append(sorted(map(tuple, packing.pack(df, TOKENIZER).collect())))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1]
    lengths = Counter()
    for r in found[0]:
        lengths[r[5]] += r[2]
    assert sum(n < packing.LEAST_POWER for n in lengths.values()) <= 1
