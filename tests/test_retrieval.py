from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row

from millrace.functions import vector
from millrace.operators import evaluation, healing, index, ingest, retrieval, telemetry
from millrace.operators.embedding import CHARS, TEXTS, HashingEmbedder, embed_column, run_embedding, slices
from millrace.operators.jobs import Jobs
from millrace.operators.store import ParquetStore, run_load, search


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [("a-0", "red wireless mouse works well", 5.0), ("b-0", "blue keyboard feels cheap", 2.0), ("c-0", "wireless keyboard and mouse set", None)]
    df = spark.createDataFrame(rows, "id string, text string, rating double").selectExpr("*", "text as document", "'x' as asin", "'p' as parent_asin")
    return embed_column(df, HashingEmbedder(64)).cache()


def test_search_order_and_filter(spark, chunks):
    vectors = spark.createDataFrame([("near", [0.1] * 8, 5.0), ("far", [-0.1] * 8, 5.0)], "id string, embedding array<float>, rating double")
    assert [r.id for r in search(vectors, [0.1] * 8).collect()] == ["near", "far"]
    q = HashingEmbedder(64).embed(["keyboard"])[0]
    assert [r.id for r in search(chunks, q, metric="inner", min_rating=1.0).collect()] == ["b-0", "a-0"]
    assert search(chunks, q, metric="inner", min_rating=0).count() == 3


def test_retrieve_and_rerank(chunks):
    plain = retrieval.retrieve(chunks, "wireless mouse", HashingEmbedder(64), top_k=2).collect()
    assert len(plain) == 2 and "rerank_score" not in plain[0]
    better = retrieval.retrieve(chunks, "keyboard set", HashingEmbedder(64), top_k=2, reranker=retrieval.LexicalReranker()).collect()
    assert better[0].id == "c-0" and better[0].rerank_score >= better[1].rerank_score
    assert retrieval.rerank(chunks.limit(0).selectExpr("*", "0 as query_id", "'' as query", "1 as rank"), retrieval.LexicalReranker(), 3).count() == 0


def test_ask(chunks):
    answer = retrieval.ask(chunks, "wireless mouse", HashingEmbedder(64), lambda system, user: user, k=2)
    assert answer.answer.startswith("Review excerpts:\n[1] (rating ")
    assert [s["rank"] for s in retrieval.source_rows(answer)] == [1, 2]
    assert retrieval.health(chunks) == {"status": "ok", "chunks": 3}


def test_evaluate_ignores_null_parents(spark):
    hits = spark.createDataFrame([(1, "a-0", 1, None), (1, "a-1", 2, "p"), (2, "b-0", 1, "p")], "query_id long, id string, rank int, parent_asin string")
    gold = spark.createDataFrame([(1, "a"), (2, "z")], "query_id long, gold_parent_id string")
    row = evaluation.evaluate(hits, gold, "t").first()
    assert (row.n, row.recall_at_k, row.mrr) == (2, 0.5, 0.25)


def test_spans_and_jobs(spark):
    t = telemetry.Telemetry()
    with pytest.raises(RuntimeError), t.stage_span("s"):
        pass
    t.setup()
    with t.stage_span("s") as span:
        span.rows_out = 3
    with pytest.raises(KeyError), t.stage_span("s"):
        raise KeyError("x")
    frame = t.frame(spark).cache()
    assert telemetry.failure_ratio(frame).first().failure_ratio == 0.5
    assert 'pipeline_failures_total{stage="s",error_type="KeyError"} 1' in telemetry.exposition(frame)
    jobs = Jobs()
    with jobs.job("a") as j:
        j["records_out"] = 2
    with pytest.raises(ValueError), jobs.job("b"):
        raise ValueError("x" * 3000)
    assert [(r.status, len(r.error or "")) for r in jobs.frame(spark).orderBy("id").collect()] == [("succeeded", 0), ("failed", 2000)]


def test_many_queries_meet_every_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, x[3].tolist())], "id long, embedding array<double>")
    queries = corpus.filter("id < 40").selectExpr("id as query_id", "embedding as vector")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q, c in ((1024, 1024), (16, 64)):
        monkeypatch.setattr(vector, "QUERY_BLOCK", q)
        monkeypatch.setattr(vector, "CORPUS_BLOCK", c)
        got = retrieval.batch_top_k(queries, corpus, k=4).collect()
        by = {(r.query_id, r.rank): r.id for r in got}
        assert len(by) == 160 and by[3, 1] == 3 and by[3, 2] == 901
        assert all(by[i, 1] == i for i in range(40))
        second = [int(np.argsort(-(unit @ unit[i]))[1]) for i in range(40) if i != 3]
        assert [by[i, 2] for i in range(40) if i != 3] == second
    assert retrieval.batch_top_k(queries.limit(0), corpus, k=4).count() == 0


@pytest.mark.parametrize("n", [200, 2000])
def test_index_recall(spark, tmp_path, n):
    """Clustered vectors, one cluster a third of all: the index finds nine tenths of the exact hits, and all with every cell probed."""
    rng = np.random.default_rng(n)
    centre = rng.normal(size=(20, 16))
    own = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, 20, n))
    x = centre[own] + 0.4 * rng.normal(size=(n, 16))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(n, None), (n + 1, [0.0] * 16)], "id long, embedding array<double>")
    queries = corpus.filter(f"id % 10 = 0 and id < {n}").selectExpr("id as query_id", "embedding as vector")
    index.build(corpus, str(tmp_path / "i"))
    exact = retrieval.batch_top_k(queries, corpus.filter(f"id < {n}"), k=5)
    assert index.recall(index.search(spark, str(tmp_path / "i"), queries), exact).first().recall >= 0.9
    assert index.recall(index.search(spark, str(tmp_path / "i"), queries, probes=n), exact).first().recall == 1.0
    index.build(corpus.limit(0), str(tmp_path / "none"))
    assert index.search(spark, str(tmp_path / "none"), queries).count() == 0


def test_index_grows_and_filters(spark, tmp_path, monkeypatch):
    """Vectors added to an index are found like the others, cells in many parts give what whole ones do, and a condition holds before the best are taken."""
    monkeypatch.setattr(index, "PART", 40)
    monkeypatch.setattr(index, "ASKED", 7)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6, 16))[rng.integers(0, 6, 900)] + 0.3 * rng.normal(size=(900, 16))
    corpus = spark.createDataFrame([(i, v.tolist(), float(i % 5)) for i, v in enumerate(x)], "id long, embedding array<double>, rating double")
    at = str(tmp_path / "i")
    index.build(corpus.filter("id < 600"), at, keep=("rating",))
    files = {f.name for f in (tmp_path / "i" / "cells").rglob("*.parquet")}
    index.add(corpus.filter("id >= 600"), at, keep=("rating",))
    assert files < {f.name for f in (tmp_path / "i" / "cells").rglob("*.parquet")}  # nothing was rewritten
    queries = corpus.filter("id % 9 = 0").selectExpr("id as query_id", "embedding as vector")
    hits = lambda df: sorted((r.query_id, r["rank"], r.id) for r in df.collect())
    assert hits(index.search(spark, at, queries, probes=index.MOST_CELLS)) == hits(retrieval.batch_top_k(queries, corpus, k=5))
    assert hits(index.search(spark, at, queries, probes=index.MOST_CELLS, where="rating >= 3")) == hits(retrieval.batch_top_k(queries, corpus.filter("rating >= 3"), k=5))
    assert index.recall(index.search(spark, at, queries), retrieval.batch_top_k(queries, corpus, k=5)).first().recall >= 0.95
    index.build(corpus.limit(0), str(tmp_path / "none"), keep=("rating",))
    index.add(corpus.filter("id < 50"), str(tmp_path / "none"), keep=("rating",))
    assert index.search(spark, str(tmp_path / "none"), queries.limit(3)).count() == 15


def test_tracked_runs(spark, tmp_path):
    """Embed, load and evaluate as jobs; the load's records out are all rows of the store."""
    jobs = Jobs()
    reviews = spark.createDataFrame([("r1", "Good mouse. Works well.", 5.0, "a", "p1", 0, "Mouse", "Things"), ("r2", "Bad cable", 1.0, "b", None, 1, None, "Things")], "id string, text string, rating double, asin string, parent_asin string, helpful_vote int, product_title string, category string")
    chunks = run_embedding(jobs, reviews, HashingEmbedder(32), str(tmp_path / "chunks"))
    assert {r.chunk_id: r.text for r in chunks.collect()} == {"r1-0": "Good mouse. Works well.", "r2-0": "Bad cable"}
    told = HashingEmbedder(32).embed(["Product: Mouse | Review: Good mouse. Works well.", "Product: Things | Review: Bad cable"])
    assert [[round(x, 5) for x in r.embedding] for r in chunks.orderBy("chunk_id").collect()] == [[round(x, 5) for x in v] for v in told]
    store = ParquetStore(spark, str(tmp_path / "store"), "id string, document string, embedding array<float>, rating double, asin string, parent_asin string, helpful_vote int", create=True)
    assert run_load(jobs, store, chunks.filter("chunk_id = 'r1-0'")) == 1 and run_load(jobs, store, chunks) == 2
    gold = spark.createDataFrame([(1, "r1"), (2, "none")], "query_id long, gold_parent_id string")
    hits = lambda g: g.selectExpr("query_id", "'r1-0' as id", "1 as rank", "'p1' as parent_asin")
    got = evaluation.run_evaluation(jobs, {"one": hits, "two": hits}, gold, str(tmp_path / "csv")).collect()
    assert [(r.table, r.recall_at_k, r.mrr) for r in got] == [("one", 0.5, 0.5), ("two", 0.5, 0.5)]
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    with pytest.raises(Exception):
        run_embedding(jobs, reviews.drop("category"), HashingEmbedder(32), str(tmp_path / "x"))
    assert [(j["job_name"], j["status"], j["records_in"], j["records_out"]) for j in jobs.rows] == [
        ("embed:sentence", "succeeded", 2, 2), ("vecload:chunks", "succeeded", 1, 1), ("vecload:chunks", "succeeded", 2, 2), ("eval:retrieval", "succeeded", 2, 2), ("embed:sentence", "failed", None, None),
    ]


def test_watch_jobs_looks_again():
    class Rows:
        def toLocalIterator(self):
            return iter([Row(id=1, job_name="embed:x", error="e")])

    seen, slept = [], []
    healing.watch_jobs(Rows, lambda *row: seen.append(row), passes=2, sleep_fn=slept.append)
    assert seen == [(1, "embed:x", "e")] * 2 and slept == [60.0, 60.0]
    made = healing.job_registry(lambda s: f"e {s}", lambda s: f"l {s}", ingest=lambda: "i")
    assert healing.runner_for("vecload:chunks_fixed", made)() == "l fixed" and healing.runner_for("embed:sentence", made)() == "e sentence"
    assert healing.runner_for("ingest", made)() == "i" and healing.runner_for("other", made) is None


def test_counters_see_one_beyond_the_limit(spark, tmp_path):
    rows = [(i, "a text that is long enough " + str(i % 3), 1.0 if i != 2 else None) for i in range(1, 9)]
    raw = spark.createDataFrame(rows, "line_number long, text string, rating double")
    counts = lambda **kw: tuple(ingest.run_counters(raw, **kw).first())
    assert counts() == (8, 7, 3) and counts(limit=4) == (5, 3, 2) and counts(limit=8) == (8, 7, 3) and counts(limit=0) == (1, 0, 0)
    jobs = Jobs()
    reviews = raw.selectExpr("*", "'a' as asin", "'p' as parent_asin", "0 as helpful_vote", "0L as timestamp")
    meta = spark.createDataFrame([(1, "p", "Mouse", "")], "line_number long, parent_asin string, title string, main_category string")
    assert {(r.product_title, r.category) for r in ingest.run_ingest(jobs, reviews, meta, str(tmp_path / "r"), category="Things", limit=4).collect()} == {("Mouse", "Things")}
    assert [(j["job_name"], j["records_in"], j["records_out"]) for j in jobs.rows] == [("ingest:Things", 5, 2)]


def test_scores_held_at_once(monkeypatch):
    """A task's memory beside its blocks is bounded, and the best are those of a whole product, ties by id."""
    rng = np.random.default_rng(4)
    x, q = rng.integers(-2, 3, (6000, 8)).astype(float), rng.integers(-2, 3, (700, 8)).astype(float)
    x[(x == 0).all(axis=1), 0] = q[(q == 0).all(axis=1), 0] = 1
    corpus, queries = pd.DataFrame({"id": range(6000), "v": list(x)}), pd.DataFrame({"query_id": range(700), "v": list(q)})
    tracemalloc.start()
    got = vector.best(queries, corpus, 3, "cosine")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    distance = np.round(1 - (q / np.linalg.norm(q, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T, vector.PLACES)
    assert got["id"].tolist() == np.argsort(distance, axis=1, kind="stable")[:, :3].ravel().tolist()
    monkeypatch.setattr(vector, "SCORES", 1)
    assert vector.best(queries.head(9), corpus, 3, "cosine")["id"].tolist() == got["id"].tolist()[:27]


def test_encoder_is_given_slices(spark):
    """A column's encoder never gets a whole Arrow batch; texts keep their vectors."""
    texts = [f"w{i} " * (1 + i % 5) for i in range(700)] + [None, "x" * (CHARS + 1), ""]

    class Strict(HashingEmbedder):
        def embed(self, texts):
            assert len(texts) <= TEXTS and (len(texts) == 1 or sum(map(len, texts)) <= CHARS)
            return super().embed(texts)

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = {r.id: r.embedding for r in embed_column(df, Strict(16)).collect()}
    assert [got[i] for i in range(len(texts))] == np.asarray(HashingEmbedder(16).embed([t or "" for t in texts]), np.float32).tolist()
    assert [len(x) for x in slices(["ab"] * 5 + ["abcd"], 2, 3)] == [1] * 6 and list(slices([])) == []
