from __future__ import annotations

import random
from datetime import datetime, timedelta

from millrace.operators import faults, healing
from millrace.operators.embedding import HashingEmbedder
from millrace.operators.ledger import Ledger, replay
from millrace.operators.store import ParquetStore
from millrace.schemas import CHUNKS
from millrace.sources import jsonl
from millrace.streaming import worker


def test_worker_is_resumable_and_idempotent(spark, tmp_path):
    faults.disarm()
    source = tmp_path / "in"
    source.mkdir()
    line = lambda i: f'{{"rating": 5, "text": "a review that is long enough {i}"}}\n'
    (source / "1.jsonl").write_text(line(1) + line(2) + "not json\n")
    ledger, store = Ledger(spark, str(tmp_path / "ledger")), ParquetStore(spark, str(tmp_path / "store"), CHUNKS, create=True)
    go = lambda: worker.run_worker(spark, str(source), ledger, store, HashingEmbedder(8), checkpoint=str(tmp_path / "cp")).awaitTermination()
    go()
    assert store.count() == 2
    (source / "2.jsonl").write_text(line(2) + line(3))
    go()
    assert store.count() == 3
    assert {(r.stage, r.status): r["count"] for r in ledger.states().groupBy("stage", "status").count().collect()} == {("ingest", "succeeded"): 3, ("ingest", "failed"): 1, ("embed", "succeeded"): 2}


STEPS = "stage string, input_hash string, seq long, to_status string, ts timestamp, not_before timestamp"


def test_ledger_stream_is_the_replay(spark, tmp_path):
    """States after two runs with a restart between are those of the batch fold over all transitions."""
    rng = random.Random(5)
    began = datetime(2024, 1, 1)
    rows = [("s", f"k{rng.randrange(6)}", i, rng.choice(["pending", "running", "running", "failed", "retrying", "succeeded", "escalated"]), began + timedelta(seconds=i), None) for i in range(160)]
    for part in (rows[:70], rows[70:]):
        spark.createDataFrame(part, STEPS).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        found = worker.ledger_states(spark.readStream.schema(STEPS).parquet(str(tmp_path / "log")), str(tmp_path / "out"))
    log = spark.createDataFrame([(*r[:4], None, None, None, None, *r[4:]) for r in rows], "stage string, input_hash string, seq long, to_status string, error_type string, error_message string, rows_in int, rows_out int, ts timestamp, not_before timestamp")
    names = ["stage", "input_hash", "status", "attempt_count", "refused"]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, replay(log).select(names).collect()))


def test_ledger_stream_timers(spark, tmp_path):
    """A retry falls due after its time, a job that runs too long is orphaned, and neither where the job went on."""
    past, ahead = datetime(2024, 1, 1), datetime(2999, 1, 1)
    step = lambda k, to, i, not_before=None: ("s", k, i, to, past + timedelta(seconds=i), not_before)
    first = [step(k, to, i) for k in ("due", "later", "stuck", "fine") for i, to in enumerate(["pending", "running"])]
    first += [step("due", "failed", 2), step("due", "retrying", 3, past), step("later", "failed", 2), step("later", "retrying", 3, ahead), step("fine", "succeeded", 2)]
    go = lambda: {r.input_hash: (r.status, r.event) for r in worker.ledger_states(spark.readStream.schema(STEPS).parquet(str(tmp_path / "log")), str(tmp_path / "out"), orphan_after=60).collect()}
    spark.createDataFrame(first, STEPS).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    go()
    spark.createDataFrame([step("new", "pending", 9), step("stuck", "succeeded", 9)], STEPS).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    assert go() == {"due": ("retrying", "due"), "later": ("retrying", "changed"), "stuck": ("failed", "changed"), "fine": ("succeeded", "changed"), "new": ("pending", "changed")}


def test_ledger_stream_keys_share_buckets(spark, tmp_path):
    """Sixty keys lie in two groups of the state; each has its own state and wait, and a retry without a time waits for nothing."""
    past, ahead = datetime(2024, 1, 1), datetime(2999, 1, 1)
    step = lambda k, to, i, not_before=None: ("s", f"k{k}", i, to, past + timedelta(seconds=i), not_before)
    wait = {0: past, 1: ahead, 2: None}
    first = [step(k, to, i, wait[k % 3] if to == "retrying" else None) for k in range(60) for i, to in enumerate(["pending", "running", "failed", "retrying"])]
    go = lambda: {(r.input_hash, r.status, r.attempt_count, r.refused, r.event) for r in worker.ledger_states(spark.readStream.schema(STEPS).parquet(str(tmp_path / "log")), str(tmp_path / "out"), buckets=2).collect()}
    spark.createDataFrame(first, STEPS).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    assert go() == {(f"k{k}", "retrying", 1, 0, "changed" if k % 3 else "due") for k in range(60)}
    spark.createDataFrame([step(k, to, 9 + i) for k in range(0, 60, 7) for i, to in enumerate(["running", "pending"])], STEPS).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    assert go() == {(f"k{k}", "retrying", 1, 0, "changed" if k % 3 else "due") if k % 7 else (f"k{k}", "running", 2, 1, "changed") for k in range(60)}
    assert spark.read.format("statestore").option("stateVarName", "jobs").load(str(tmp_path / "out" / "checkpoint")).count() == 2


def test_dedup_stream(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in "abcabca"], "text string")
    df.coalesce(1).write.parquet(str(tmp_path / "texts"))
    worker.dedup_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "texts"))).writeStream.format("memory").queryName("dd").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("dd").count() == 3


def test_dedup_over_loads(spark, tmp_path):
    """First arrivals over ten loads are exact, the stream's own state stays empty, and a batch run again changes nothing."""
    rng = random.Random(2)
    kind, seen, expected = "line_number long, text string", set(), []
    stream = lambda: spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for load in range(10):
        rows = [(100 * load + i, rng.choice([None, *map(str, range(30))])) for i in range(8)]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for n, t in rows:
            if t not in seen:
                seen.add(t)
                expected.append((n, t))
        if load in (0, 4, 9):  # restarts between
            found = worker.dedup_loads(stream(), str(tmp_path / "out"), order_col="line_number")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert not (tmp_path / "out" / "checkpoint" / "state").exists()
    (tmp_path / "out" / "checkpoint" / "commits" / "9").unlink()  # the last batch's end wasn't noted
    (tmp_path / "out" / "checkpoint" / "commits" / ".9.crc").unlink(missing_ok=True)
    assert sorted(map(tuple, worker.dedup_loads(stream(), str(tmp_path / "out"), order_col="line_number").collect()), key=str) == sorted(expected, key=str)


def test_healer_stream(spark, tmp_path):
    """Each failure is decided on once, by what its transition says; a run without new failures adds nothing."""
    with Ledger(spark, str(tmp_path / "ledger")) as led:
        units = spark.createDataFrame([("s", "slow", 1), ("s", "bug", 1), ("s", "fine", 1)], "stage string, input_hash string, rows_in int")
        led.begin(units)
        end = lambda *rows: led.append(spark.createDataFrame(list(rows), "stage string, input_hash string, to_status string, error_type string"))
        end(("s", "slow", "failed", "TimeoutError"), ("s", "bug", "failed", "KeyError"), ("s", "fine", "succeeded", None))
        go = lambda: healing.heal_stream(led, checkpoint=str(tmp_path / "cp"), max_attempts=2).awaitTermination()
        status = lambda: {r.input_hash: r.status for r in led.states().collect()}
        go()
        assert status() == {"slow": "retrying", "bug": "escalated", "fine": "succeeded"}
        entries = led.log().count()
        go()
        assert led.log().count() == entries
        led.begin(units)
        end(("s", "slow", "failed", "TimeoutError"))
        go()
        assert status()["slow"] == "escalated"  # its second attempt was the last


def test_stream_lines_are_the_batch_readers(spark, tmp_path):
    """White space of any kind goes at both ends, blank lines are blank, and numbers follow (file, place)."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "b.txt").write_text("three\n\t \n four　\n")
    (source / "a.txt").write_text("\tone \n  two\x1f\n")
    found = []
    worker.run_batches(worker.stream_lines(spark, str(source), files_per_batch=10), lambda batch, _: found.extend((r.line_number, r.raw) for r in worker.numbered(batch).collect()), str(tmp_path / "cp"))
    assert sorted(found) == [(1, "one"), (2, "two"), (3, "three"), (4, ""), (5, "four")]
    batch = {r.line_number: r.raw for r in jsonl.read_lines(spark, str(source)).collect()}
    assert batch == dict(found)
    assert jsonl.read_reviews(spark, str(source / "b.txt")).filter("error_type = 'MalformedRecord'").count() == 2
