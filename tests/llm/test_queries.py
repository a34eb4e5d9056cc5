"""The registered training-data queries on the smallest driver tables, and the pipeline against its stages chained by brute force."""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import queries
from millrace.llm.common import staged
from tests.llm.test_operators import WORD, ids_of, jump, lower, vectors_of
from tests.test_catalogue import SF, rows

driver = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{SF}/{t}'")
    return con


@driver
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert rows(queries.queries()[name](spark, SF).toPandas()) == rows(con.execute(queries.oracle_sql()[name]).df())


def texts_of(con):
    return con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()


def cut(texts: list[bytes], length: int = 200) -> list[tuple[bytes, int, int]]:
    """What is left of each text, bytes that went, and their runs."""
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        cover = np.zeros(len(b) + 1, np.int32)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                cover[j] += 1
                cover[j + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())))
    return out


@driver
def test_suffix_query(spark, con):
    docs = texts_of(con)
    left = cut([t.encode() for _, t in docs])
    expected = Counter((i, len(t.encode()), n, spans, hashlib.sha256(b).hexdigest()) for (i, t), (b, n, spans) in zip(docs, left, strict=True))
    assert Counter(map(tuple, queries.op6_suffix_dedup(spark, SF).collect())) == expected


def check_pieces(pieces, docs):
    """Every row's tokens are whole and as often as it occurs: piece by piece in order, checksums against the tokenizer's own ids."""
    want: dict = {}
    for (i, _), ids in zip(docs, ids_of([t for _, t in docs]), strict=True):
        want.setdefault(i, []).append(ids)
    fill: Counter = Counter()
    whole: list = []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id]
        fill[p.sequence_id] += p.length
        if p.start == 0:
            whole.append([])
        whole[-1].append(p)
    assert max(fill.values()) <= 4096
    for ps in whole:
        i, ends = ps[0].doc_id, np.cumsum([0] + [p.length for p in ps])
        assert {p.doc_id for p in ps} == {i} and [p.start for p in ps] == ends[:-1].tolist() and {p.doc_tokens for p in ps} == {int(ends[-1])}
        fits = [n for n, ids in enumerate(want[i]) if len(ids) == ends[-1] and all(zlib.crc32(ids[p.start : p.start + p.length].astype("<u4").tobytes()) == p.ids_crc32 for p in ps)]
        want[i].pop(fits[0])
    assert not any(want.values())


@driver
def test_packing_query(spark, con):
    check_pieces(queries.op8_packing(spark, SF).collect(), texts_of(con))


@driver
def test_sharding_query(spark, con):
    got = queries.op4_sharding(spark, SF).collect()
    expected = Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode()), "key", jump(i, 40), jump(i, 41)) for i, t in texts_of(con))
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expected
    slots: dict = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@driver
def test_warc_query(spark, con):
    pages = [(i, (h or "").encode()) for i, h in con.execute("SELECT page_id, html FROM pages").fetchall()]
    got = queries.op9_warc(spark, SF).collect()
    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    first: dict = {}
    for i, b in sorted(pages):
        first.setdefault(b, i)
    expected = Counter((i, len(b), digest(b), first[b] if first[b] != i else None) for i, b in pages)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest.removeprefix("sha1:"), r.refers_to) for r in got) == expected
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)


@driver
def test_token_store_query(spark, con):
    docs = texts_of(con)
    expected = Counter((i, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for (i, _), ids in zip(docs, ids_of([t for _, t in docs]), strict=True))
    got = queries.op10_token_store(spark, SF).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def over(table):
    """A database of the given documents and the driver's labels."""
    db = duckdb.connect()
    db.register("documents", table)
    db.execute(f"CREATE VIEW labels AS SELECT * FROM '{SF}/labels.parquet'")
    return db


@driver
def test_pipeline(spark, con):
    """Each stage's rows, with all columns, against brute force on the rows before; then run() itself."""
    now = con.execute("SELECT doc_id, text, lang, source, n_chars FROM documents").df()
    step, found = spark.read.parquet(f"{SF}/documents.parquet"), lambda df: Counter(map(tuple, df.select(*now.columns).collect()))
    plain = lambda df: Counter(df.itertuples(index=False, name=None))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_join", "suffix_dedup", "mixing", "packing"]

    step = staged(stages["quality_rules"](spark, step, SF), "t")
    kept = {i for i, k in over(now).execute(f"SELECT doc_id, kept FROM ({queries.oracle_sql()['op7_quality_rules']})").fetchall() if k}
    assert 0 < len(kept) < len(now)
    now = now[now.doc_id.isin(kept)]
    assert found(step) == plain(now)

    step = staged(stages["ngram_join"](spark, step, SF), "t")
    ids, sets = now.doc_id.tolist(), []
    for t in now.text:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    comp = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                comp = [comp[b] if c == comp[a] else c for c in comp]
    least: dict = {}
    for i, c in zip(ids, comp, strict=True):
        least[c] = min(i, least.get(c, i))
    assert len(least) < len(ids)
    now = now[now.doc_id.isin(least.values())]
    assert found(step) == plain(now)

    step = staged(stages["suffix_dedup"](spark, step, SF), "t")
    left = [b.decode("utf-8", "ignore") for b, *_ in cut([t.encode() for t in now.text])]
    assert left != now.text.tolist()
    now = now.assign(text=left, n_chars=[len(t) for t in left])
    assert found(step) == plain(now)

    step = staged(stages["mixing"](spark, step, SF), "t")
    taken = dict(over(now).execute(f"SELECT doc_id, taken FROM ({queries.oracle_sql()['op2_mixing']})").fetchall())
    made = []
    for i, text, lang, source, _ in now.itertuples(index=False, name=None):
        words = WORD.findall(text)
        if words:
            whole, part = divmod(taken[i], len(words))
            begun = text[: list(WORD.finditer(text))[part - 1].end()]
            made += [(i, t, lang, source, len(t)) for t in [text] * whole + [begun] * (part > 0)]
    assert found(step) == Counter(made)

    docs = [(i, t) for i, t, *_ in made]
    check_pieces(stages["packing"](spark, step, SF).collect(), docs)
    check_pieces(corpus_pipeline.run(spark, SF).collect(), docs)


def test_vectors_sql_on_linked_rows(spark, tmp_path):
    """The driver's vectors link with nothing, so the query and its SQL meet on a table of pairs and of one group."""
    x = np.concatenate([vectors_of("pairs", 500), vectors_of("group", 160)])
    made = [(i, v.tolist(), i % 3 if i % 50 else None) for i, v in enumerate(x)] + [(9000, None, 1), (9001, [0.0] * 64, 1), (9002, x[4].tolist(), 1)]
    spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT vec_id, CASE WHEN len(embedding) = 64 AND list_sum(list_transform(embedding, lambda e: e * e)) > 0 THEN embedding END AS embedding, label FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = rows(queries.queries()["op3_embedding_near_dedup"](spark, str(tmp_path)).toPandas())
    assert found == rows(con.execute(queries.oracle_sql()["op3_embedding_near_dedup"]).df()) and sum(r.n_links for r in queries.op3_embedding_near_dedup(spark, str(tmp_path)).collect()) > 100
