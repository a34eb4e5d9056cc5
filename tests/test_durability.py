"""A worker that is cut short anywhere goes on where it was: no row is lost or stored twice, no batch is encoded in vain."""

from __future__ import annotations

import os

import pytest

from millrace.operators import faults
from millrace.operators.embedding import HashingEmbedder, embed_batches
from millrace.operators.ingest import embed_stage, ingest_records
from millrace.operators.ledger import Ledger
from millrace.operators.store import ParquetStore
from millrace.schemas import CHUNKS
from millrace.staging import Shelf, scratch, shared_dir, staged
from millrace.streaming import worker

STEPS = ["ingest-units", "ingest-running", "ingest", "ingest-recorded", "embed-units", "embed-running", "embed", "embed-recorded", "stored"]


class Counting:
    """An encoder that leaves a file for every call."""

    def __init__(self, folder: str, fail: bool = False):
        self.dim, self.folder, self.fail = 8, folder, fail

    def embed(self, texts: list[str]) -> list[list[float]]:
        open(f"{self.folder}/{os.urandom(8).hex()}", "w").close()
        if self.fail:
            raise RuntimeError("model exploded")
        return HashingEmbedder(8).embed(texts)


class Crash(Exception):
    pass


def line(i: int) -> str:
    return f'{{"rating": 5, "text": "a review that is long enough {i}"}}\n'


@pytest.fixture
def place(spark, tmp_path):
    faults.disarm()
    for d in ("in", "calls"):
        (tmp_path / d).mkdir()
    (tmp_path / "in" / "1.jsonl").write_text(line(1) + line(2) + "not json\n" + '{"rating": null, "text": "no rating at all"}\n')
    return tmp_path


def run(spark, place, store, on_step=None, **options):
    ledger = Ledger(spark, str(place / "ledger"))
    worker.run_worker(spark, str(place / "in"), ledger, store, Counting(str(place / "calls")), checkpoint=str(place / "cp"), on_step=on_step, **options).awaitTermination()
    return ledger


def test_crash_after_each_step(spark, place):
    """One batch, cut short after every step in turn, each time in a run that goes on from the one before."""
    store, passed = ParquetStore(spark, str(place / "store"), CHUNKS, create=True), []
    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))

    def crash(step: str) -> None:
        if step not in passed:
            passed.append(step)
            raise Crash(step)

    for step in STEPS:
        with pytest.raises(Exception, match=step):
            run(spark, place, store, crash)
    ledger = run(spark, place, store, crash)
    assert passed == STEPS
    assert sorted(r.text[-1] for r in store.read().collect()) == ["1", "2"]
    states = {(r.stage, r.status): r["count"] for r in ledger.states().groupBy("stage", "status").count().collect()}
    assert states == {("ingest", "succeeded"): 3, ("ingest", "failed"): 1, ("embed", "succeeded"): 1}
    assert {r.attempt_count for r in ledger.states().collect()} == {1}
    assert len(os.listdir(place / "calls")) == 1
    assert os.listdir(place / "cp-stages") == [] and set(os.listdir(at)) == before


def test_store_fault_keeps_the_batch(spark, place):
    """A load that fails is made up for by the next run, by what the earlier stages have left."""
    store = ParquetStore(spark, str(place / "store"), CHUNKS, create=True)
    with pytest.raises(Exception, match="vectorstore"):
        run(spark, place, store, fail_every=1, fault=("vectorstore", "dropped_connection"))
    assert store.count() == 0
    run(spark, place, store, fail_every=1, fault=("vectorstore", "dropped_connection"))
    assert store.count() == 2 and len(os.listdir(place / "calls")) == 1


def test_batches_are_encoded_once(spark, tmp_path):
    """Each batch once, batches that are done never, a batch that a fault hits not at all; failed ones wait for the healer."""
    faults.disarm()
    (tmp_path / "calls").mkdir()
    calls = lambda: len(os.listdir(tmp_path / "calls"))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    records = spark.createDataFrame([(i, f"raw {i}", f"text {i}") for i in range(70)], "line_number long, raw string, text string")
    faults.arm("embed", "rate_limit")
    first = embed_stage(ledger, records, Counting(str(tmp_path / "calls")), size=32)
    assert first.output.count() == 38 and calls() == 2
    again = embed_stage(ledger, records, Counting(str(tmp_path / "calls")), size=32)
    assert again.output.count() == 0 and calls() == 2
    ledger.append(ledger.unhealed_failures().selectExpr("stage", "input_hash", "'retrying' as to_status"))
    healed = embed_stage(ledger, records, Counting(str(tmp_path / "calls")), size=32)
    assert healed.output.count() == 32 and calls() == 3
    rows, units = embed_batches(records, Counting(str(tmp_path / "calls"), fail=True), size=32)
    assert rows.count() == 0 and {r.error_message for r in units.collect()} == {"model exploded"} and calls() == 6


def test_stage_resumes_on_its_shelf(spark, tmp_path):
    """The same shelf gives the same output though the ledger says that its lines are done; a new one gives nothing."""
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    lines = spark.createDataFrame([(i, line(i).strip()) for i in range(5)], "line_number long, raw string")
    for _ in range(2):
        assert ingest_records(ledger, lines, shelf=Shelf(spark, str(tmp_path / "shelf"))).output.count() == 5
    assert ingest_records(ledger, lines).output.count() == 0
    assert {r.attempt_count for r in ledger.states().collect()} == {1}


def test_scratch_removes_what_is_staged_in_it(spark):
    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    kept = staged(spark.range(3).toDF("x"), "kept")
    with scratch():
        staged(kept, "gone")
        with scratch():
            staged(kept, "inner")
        with pytest.raises(ZeroDivisionError), scratch():
            staged(kept, "failed")
            raise ZeroDivisionError
    assert kept.count() == 3 and len(set(os.listdir(at)) - before) == 1
