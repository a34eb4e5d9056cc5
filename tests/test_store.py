"""The store's segments, writers and awkward ids; jobs that outlive their driver; durations as scrapers see them."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import healing, telemetry
from millrace.operators.jobs import Jobs
from millrace.operators.store import ParquetStore
from millrace.schemas import METRIC
from millrace.sources import sinks

ROWS = "id string, document string, embedding array<float>, rating double"


def rows(spark, *found):
    return spark.createDataFrame([(i, d, [float(len(d or ""))], r) for i, d, r in found], ROWS)


def held(store):
    return sorted(((r.id, r.document, r.rating) for r in store.read().collect()), key=str)


def test_upsert_searches_all_segments_in_one_job(spark, tmp_path, monkeypatch):
    """However many segments: one read for those whose ranges fit, the rest unread, and only those that hold the ids rewritten."""
    store = ParquetStore(spark, str(tmp_path / "s"), ROWS, create=True)
    for k in range(12):
        store.insert(rows(spark, *[(f"{k:02d}-{i}", "old", 1.0) for i in range(0, 8, 2)]), order_col="id")
    before = {s["name"] for s in store._segments()[1]}
    read, reads = ParquetStore._read, []
    monkeypatch.setattr(ParquetStore, "_read", lambda self, segments: (reads.append(len(segments)), read(self, segments))[1])
    # ids within the ranges of segments 3 to 5, there in 3 and 5 only
    assert store.upsert(rows(spark, ("03-2", "new", 9.0), ("05-4", "new", 9.0), ("04-1", "added", 2.0))) == 49
    assert reads == [3, 2, 1]
    assert len(before - {s["name"] for s in store._segments()[1]}) == 2
    now = {i: (d, r) for i, d, r in held(store)}
    assert now["03-2"] == ("new", 1.0) and now["04-1"] == ("added", 2.0) and now["03-0"] == ("old", 1.0) and store.count() == 49 == store.read().count()


def test_compact_in_ranges(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"), ROWS, create=True)
    for k in range(3):
        store.insert(rows(spark, *[(f"{i:03d}", "d", 1.0) for i in range(k, 60, 3)], *([(None, "n", 1.0)] if k == 1 else [])), order_col="id")
    everything = held(store)
    store.compact(4)
    parts = store._segments()[1]
    assert held(store) == everything and len(parts) > 1
    spans = sorted((s["low"], s["high"]) for s in parts if s["low"] is not None)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(store._near(parts, {"low": "000", "high": "000", "nulls": 0})) == 1
    store.compact()
    assert len(store._segments()[1]) == 1 and held(store) == everything


def test_repeated_and_null_ids(spark, tmp_path):
    """One row counts of an id that comes several times, and null is an id like others."""
    store = ParquetStore(spark, str(tmp_path / "s"), ROWS, create=True)
    assert store.upsert(rows(spark, ("a", "1", 1.0), (None, "n1", 1.0), ("a", "2", 2.0), (None, "n2", 2.0)), order_col="rating") == 2
    assert held(store) == [("a", "1", 1.0), (None, "n1", 1.0)]
    assert store.upsert(rows(spark, (None, "n3", 9.0), ("a", "5", 9.0), ("a", "4", 8.0)), order_col="rating") == 2
    assert held(store) == [("a", "4", 1.0), (None, "n3", 1.0)]
    assert store.insert(rows(spark, (None, "n4", 9.0), ("a", "6", 9.0)), order_col="id") == 0
    assert store.upsert(rows(spark)) == 2


def test_second_writer_is_refused(spark, tmp_path):
    """Of two loads that began at one version the later one fails and leaves the store as it was; again it succeeds."""
    store = ParquetStore(spark, str(tmp_path / "s"), ROWS, create=True)
    number, segments = store._segments()
    late = store._write(rows(spark, ("late", "x", 1.0)))
    store.insert(rows(spark, ("first", "x", 1.0)), order_col="id")
    with pytest.raises(FileExistsError):
        store._publish(number + 1, [*segments, late])
    assert [i for i, *_ in held(store)] == ["first"]
    store.insert(rows(spark, ("late", "x", 1.0)), order_col="id")
    assert store.count() == 2 and not [n for n in sinks.names(spark, f"{store.path}/versions") if "draft" in n]


def test_jobs_outlive_their_driver(spark, tmp_path):
    at = str(tmp_path / "jobs")
    assert Jobs(spark, at).frame(spark).count() == 0
    with Jobs(spark, at).job("embed:sentence") as job:
        job["records_in"], job["records_out"] = 3, 2
    with pytest.raises(ValueError), Jobs(spark, at).job("embed:fixed"):
        raise ValueError("bad")
    dead = Jobs(spark, at).job("vecload:chunks_fixed")
    dead.__enter__()  # a driver that dies here
    jobs = Jobs(spark, at)
    found = {r.id: (r.job_name, r.status, r.records_out, r.error) for r in jobs.frame(spark).collect()}
    assert found == {1: ("embed:sentence", "succeeded", 2, None), 2: ("embed:fixed", "failed", None, "bad"), 3: ("vecload:chunks_fixed", "running", None, None)}
    soon = datetime.now(UTC) + timedelta(minutes=1)
    failed = jobs.frame(spark).filter("status = 'failed'").unionByName(jobs.orphaned(spark, older_than=soon))
    log = spark.createDataFrame([(2,)], "failed_job_id long")
    assert [(r.id, r.job_name) for r in healing.unhealed_jobs(failed, log).collect()] == [(3, "vecload:chunks_fixed")]
    registry = healing.job_registry(lambda s: None, lambda s: f"loaded {s}")
    assert healing.runner_for("vecload:chunks_fixed", registry)() == "loaded fixed"


def test_scraped_durations_give_the_quantiles(spark):
    """p50, p95 and p99 worked out from the text that is scraped are those of ``histogram_quantile``."""
    began = datetime(2024, 1, 1)
    values = [0.001 * (i * i % 977) + 0.003 for i in range(300)] + [40.0, 70.0]
    frame = spark.createDataFrame([(began, "s", None, telemetry.DURATION, v) for v in values] + [(began, "s", None, telemetry.ATTEMPTS, 1.0)], METRIC)
    text = telemetry.exposition(frame)
    buckets = [(float(m[1]), float(m[2])) for m in re.finditer(r'_bucket\{stage="s",le="(.+?)"\} (\S+)', text)]
    assert len(buckets) == len(telemetry.BOUNDS) + 1 and f'{telemetry.DURATION}_count{{stage="s"}} {len(values)}' in text
    assert float(re.search(r"_sum\{.*?\} (\S+)", text)[1]) == pytest.approx(sum(values))
    hist = telemetry.histogram(frame.filter(F.col("name") == telemetry.DURATION), "value", "stage")
    for q in (0.5, 0.95, 0.99):
        rank, low, below = q * len(values), 0.0, 0.0
        for le, n in buckets:
            if n >= rank:
                mine = low if le == float("inf") else low + (le - low) * (rank - below) / (n - below)
                break
            low, below = le, n
        assert telemetry.histogram_quantile(hist, q, "stage").first().quantile == pytest.approx(mine)
