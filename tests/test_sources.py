from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.schemas import CHUNKS
from millrace.operators import cleaning
from millrace.operators.store import ParquetStore
from millrace.sources import jsonl, sinks


def lines(tmp_path, *rows):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def numbers(df):
    return [r.line_number for r in df.orderBy("line_number").collect()]


def test_blank_lines_keep_numbers(spark, tmp_path):
    path = lines(tmp_path, '{"rating": 1}', "", "   ", '{"rating": 2}')
    assert numbers(jsonl.read_reviews(spark, path)) == [1, 4]


def test_skip_counts_lines_and_limit_records(spark, tmp_path):
    path = lines(tmp_path, *[f'{{"rating": {i}}}' for i in range(1, 6)])
    assert numbers(jsonl.read_reviews(spark, path, skip=2, limit=2)) == [3, 4]


def test_malformed_line_ends_a_strict_read(spark, tmp_path):
    path = lines(tmp_path, '{"rating": 1}', "not json", '{"rating": 3}')
    assert numbers(jsonl.read_reviews(spark, path, strict=True)) == [1]
    with pytest.raises(jsonl.MalformedRecord) as e:
        jsonl.read_reviews(spark, path, skip=1, strict=True)
    assert (e.value.line_number, e.value.raw) == (2, "not json")
    assert numbers(jsonl.read_reviews(spark, path, skip=2, strict=True)) == [3]
    loose = {r.line_number: r.error_type for r in jsonl.read_reviews(spark, path).collect()}
    assert loose == {1: None, 2: "MalformedRecord", 3: None}


def test_text_of_a_wrong_type_fails_and_unknown_keys_survive(spark, tmp_path):
    path = lines(tmp_path, '{"text": ["not", "a", "string"]}', '{"text": "x", "other": 7}')
    got = jsonl.read_reviews(spark, path).withColumn("other", F.try_variant_get("variant", "$.other", "int")).orderBy("line_number").collect()
    assert [(r.error_type, r.other) for r in got] == [("TypeError", None), (None, 7)]


def test_first_write_wins(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"), CHUNKS, create=True)
    row = lambda n, who: (n, "id1", "t", [0.01], who)
    df = spark.createDataFrame([row(1, "ORIGINAL"), row(2, "LATER")], "line_number long, id string, text string, embedding array<float>, metadata string").withColumn("created_at", F.current_timestamp())
    assert store.insert(df, order_col="line_number") == 1
    assert store.insert(df.filter("metadata = 'LATER'"), order_col="line_number") == 0
    assert [r.metadata for r in store.read().collect()] == ["ORIGINAL"]


def test_missing_store_raises(spark, tmp_path):
    with pytest.raises(sinks.MissingStore):
        ParquetStore(spark, str(tmp_path / "none"), CHUNKS).count()


def test_upsert_leaves_metadata(spark):
    schema = "id string, embedding array<double>, document string, rating double"
    old = spark.createDataFrame([("a", [1.0], "old", 1.0)], schema)
    new = spark.createDataFrame([("a", [2.0], "new", 5.0), ("b", [3.0], "b", 4.0)], schema)
    got = {r.id: (r.embedding, r.document, r.rating) for r in sinks.upsert(new, old).collect()}
    assert got == {"a": ([2.0], "new", 1.0), "b": ([3.0], "b", 4.0)}


def test_artifacts_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("q", "c", "p")], "question string, gold_chunk_id string, gold_parent_id string")
    sinks.write_jsonl(df, str(tmp_path / "gold"))
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert jsonl.read_gold_questions(spark, str(tmp_path / "gold")).collect() == df.collect()
    (tmp_path / "pairs.json").write_text('{"pairs": [\n{"query": "a", "chunk_id": "b", "chunk_text": "c"}]}')
    assert jsonl.read_gold_pairs(spark, str(tmp_path / "pairs.json")).first().chunk_id == "b"


def test_a_million_lines_over_several_splits(spark, tmp_path):
    path, n = tmp_path / "many", 1_000_000
    path.mkdir()
    with (path / "a.txt").open("w") as a, (path / "b.txt").open("w") as b:
        for i in range(1, n + 1):
            (a if i <= 990_000 else b).write(f"{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        found = jsonl.read_lines(spark, str(path))
        assert found.rdd.getNumPartitions() > 4
        assert found.filter("line_number <> cast(raw as bigint)").count() == 0 and found.count() == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ranks_beyond_the_sampling_size(spark):
    n = 50_000
    df = spark.range(0, n, 1, 3).select((F.xxhash64("id")).alias("x"))
    ranks = cleaning.ranked(df, "x").orderBy("x").select("rank").collect()
    assert [r.rank for r in ranks] == list(range(n))
    sizes = cleaning.batched(df, order_col="x").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes)[0] == n % 32 and len(sizes) == -(-n // 32)


def test_one_row_of_each_text(spark):
    """Null texts are one text; ties and nulls in the order leave one row as well."""
    rows = [(1, None, "a"), (2, None, "b"), (3, "x", "a"), (3, "x", "b"), (None, "x", "c"), (None, "y", "d"), (None, "y", "e")]
    df = spark.createDataFrame(rows, "n long, text string, who string")
    got = cleaning.dedup_first(df, order_col="n").collect()
    assert sorted((r.n or 0, r.text or "") for r in got) == [(0, "y"), (1, ""), (3, "x")]
    assert sorted(map(tuple, cleaning.dedup_first(df, order_col="n").collect()), key=str) == sorted(map(tuple, got), key=str)
    seen = cleaning.text_hashes(df.filter("text is null or text = 'x'"))
    assert [r.text for r in cleaning.dedup_first(df, order_col="n", seen=seen).collect()] == ["y"]
    assert cleaning.dedup_first(df.limit(0), order_col="n").count() == 0


def test_absent_ids(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "id string, n int")
    new = spark.createDataFrame([(None, 3), ("b", 4), ("b", 4), ("c", None), ("c", 5)], "id string, n int")
    assert sorted((r.id, r.n) for r in sinks.insert_absent(new, old, order_col="n").collect()) == [("b", 4), ("c", 5)]
    assert sinks.insert_absent(new, old.limit(0), order_col="n").count() == 3


def test_store_segments(spark, tmp_path):
    schema = "id string, embedding array<double>, document string, rating double, line_number long"
    store = ParquetStore(spark, str(tmp_path / "s"), schema, create=True)
    rows = lambda ids, doc: spark.createDataFrame([(i, [1.0], doc, 1.0, k) for k, i in enumerate(ids)], schema)
    assert store.count() == 0 and store.insert(rows("ab", "one"), order_col="line_number") == 2
    held = set(sinks.names(spark, f"{store.path}")) - {"versions"}
    assert store.insert(rows("bcd", "two"), order_col="line_number") == 2 and store.insert(rows("a", "x"), order_col="line_number") == 0
    assert held < set(sinks.names(spark, store.path))  # what was there is neither moved nor rewritten
    before = store._segments()[1]
    assert store.upsert(rows("de", "three")) == 5
    assert before[0] in store._segments()[1] and before[1] not in store._segments()[1]
    assert {r.id: r.document for r in store.read().collect()} == {"a": "one", "b": "one", "c": "two", "d": "three", "e": "three"}
    with pytest.raises(Exception):
        store.upsert(rows("a", "bad").withColumn("document", F.raise_error(F.lit("load fails"))))
    assert store.count() == 5
    store.compact()
    assert len(store._segments()[1]) == 1 and store.count() == 5
    assert ParquetStore(spark, store.path, schema, create=True).count() == 5
