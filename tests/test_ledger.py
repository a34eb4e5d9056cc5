"""The ledger, ingest and embed stages, faults, healing: small end-to-end scenarios."""

from __future__ import annotations

import pytest

from millrace.operators import faults, healing
from millrace.operators.embedding import HashingEmbedder
from millrace.operators.ingest import embed_stage, ingest_records
from millrace.operators.ledger import InvalidTransition, Ledger


@pytest.fixture
def ledger(spark, tmp_path):
    faults.disarm()
    with Ledger(spark, str(tmp_path / "ledger")) as made:
        yield made


def test_states(ledger):
    assert ledger.get_or_create("s", "h", 100)["status"] == "pending"
    assert ledger.get_or_create("s", "h", 999)["rows_in"] == 100
    assert ledger.transition("s", "h", "running")["attempt_count"] == 1
    failed = ledger.transition("s", "h", "failed", error_type="TimeoutError", error_message="m")
    assert (failed["error_type"], failed["finished_at"] is not None) == ("TimeoutError", True)
    with pytest.raises(InvalidTransition):
        ledger.transition("s", "h", "succeeded")
    ledger.transition("s", "h", "retrying")
    again = ledger.transition("s", "h", "running")
    assert (again["attempt_count"], again["error_type"]) == (2, None)
    assert ledger.transition("s", "h", "succeeded", rows_out=50)["rows_out"] == 50
    assert ledger.is_done("s", "h") and not ledger.is_done("s", "other")
    with pytest.raises(KeyError):
        ledger.transition("s", "nothing", "running")


def raw(spark, *rows):
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(rows)], "line_number long, raw string")


GOOD = '{"rating": 5, "text": "a text that is long enough"}'


def test_ingest_separates_kept_filtered_and_failed(spark, ledger):
    batch = raw(spark, GOOD, '{"text": "a text without a rating"}', '{"rating": 1, "text": ["odd"]}', "nonsense", GOOD)
    assert [r.line_number for r in ingest_records(ledger, batch).output.collect()] == [1]
    states = {(r.status, r.rows_out, r.error_type): r.attempt_count for r in ledger.states().collect()}
    assert states == {("succeeded", 1, None): 1, ("succeeded", 0, None): 1, ("failed", None, "TypeError"): 1, ("failed", None, "MalformedRecord"): 1}
    assert ingest_records(ledger, batch).output.count() == 0


def test_fault_heals_and_a_code_bug_escalates(spark, ledger):
    batch = raw(spark, GOOD)
    faults.arm("ingest", "rate_limit")
    assert ingest_records(ledger, batch).output.count() == 0
    assert not faults.is_armed("ingest")
    assert [(r.decision, r.delay) for r in healing.heal_all(ledger).collect()] == [("retry", 1.0)]
    assert ingest_records(ledger, batch).output.count() == 1
    assert ledger.states().first().attempt_count == 2

    other = raw(spark, GOOD.replace("5", "4"))
    faults.arm("ingest", "schema_mismatch")
    ingest_records(ledger, other)
    assert [r.decision for r in healing.heal_all(ledger).collect()] == ["escalate"]
    assert ingest_records(ledger, other).output.count() == 0


def test_embed_batches_fail_whole(spark, ledger):
    lines = raw(spark, *[GOOD.replace("5", str(i)) for i in range(1, 6)])
    records = ingest_records(ledger, lines).output.cache()

    class Broken(HashingEmbedder):
        def embed(self, texts):
            if len(texts) == 1:
                raise RuntimeError("model exploded")
            return super().embed(texts)

    assert embed_stage(ledger, records, Broken(8), size=2).output.count() == 4
    failed = ledger.states().filter("stage = 'embed' and status = 'failed'").collect()
    assert [(r.error_type, r.error_message, r.rows_in) for r in failed] == [("RuntimeError", "model exploded", 1)]


def test_faults_registry():
    faults.disarm()
    with pytest.raises(ValueError):
        faults.arm("s", "unknown")
    faults.arm("s", "dropped_connection", times=2)
    for _ in range(2):
        with pytest.raises(faults.ConnectionDroppedError, match="injected dropped_connection fault at stage 's'"):
            faults.trigger("s")
    faults.trigger("s")
    faults.trigger("t")


@pytest.mark.parametrize("answer", ["not json at all", '{"decision": "reboot"}', "{}", '"retry"'])
def test_ambiguous_answers_escalate(answer):
    assert healing.classify_ambiguous("T", "m", lambda *_: answer) == "escalate"


def test_decisions_ask_the_model_only_for_the_rest(spark):
    rows = [("a", "TimeoutError", "x", 1), ("b", "KeyError", "'asin'", 1), ("c", "ConnectionDroppedError", "gone", 2), ("d", "TimeoutError", "x", 5), ("e", None, None, 1)]
    failed = spark.createDataFrame(rows, "input_hash string, error_type string, error_message string, attempt_count int")
    asked = []
    got = healing.decisions(failed, llm_call=lambda t, m: asked.append(t) or '{"decision": "retry_with_failover"}')
    assert {r.input_hash: (r.decision, r.delay) for r in got.collect()} == {"a": ("retry", 1.0), "b": ("escalate", 0.0), "c": ("retry_with_failover", 2.0), "d": ("escalate", 0.0), "e": ("retry_with_failover", 1.0)}
    assert sorted(asked) == ["", "ConnectionDroppedError"]


def test_named_jobs():
    entries, slept = [], []
    heal = lambda name, answer, registry: healing.heal_named_job(1, name, "e", registry=registry, complete=lambda _: answer, record=lambda *a: entries.append(a), sleep_fn=slept.append)
    retry = '```json{"action": "retry", "reasoning": "r"}```'
    assert heal("ingest:x", retry, {"ingest": lambda: None}) == "recovered"
    assert heal("eval:x", retry, {"ingest": lambda: None}) == "no_registered_runner"
    assert heal("ingest:x", "junk", {"ingest": lambda: None}) == "needs_human"
    assert heal("ingest:x", retry, {"ingest": lambda: 1 / 0}) == "exhausted->needs_human"
    assert slept == [30, 30, 60] and len(entries) == 4


def test_lost_race_keeps_the_decision(ledger):
    ledger.get_or_create("s", "h")
    ledger.transition("s", "h", "running")
    ledger.transition("s", "h", "failed", error_type="TimeoutError")
    row = ledger.get("s", "h")
    ledger.transition("s", "h", "escalated")
    assert healing.heal_job(ledger, row, classify=lambda *_: "retry", sleep_fn=lambda _: None) == "retry"
    assert ledger.get("s", "h")["status"] == "escalated"


def test_poll_passes(ledger):
    slept, seen = [], []
    ledger.get_or_create("s", "h")
    ledger.transition("s", "h", "running")
    ledger.transition("s", "h", "failed")
    healing.poll(ledger, seen.append, max_iterations=3, sleep_fn=slept.append, stage="s")
    assert len(seen) == 3 and slept == [5.0, 5.0]


def test_snapshots_fold_to_the_same_states(spark, tmp_path):
    """States from a snapshot on are those of the whole log; later folds don't read what is in it."""
    steps = [("a", "pending"), ("b", "pending"), ("a", "running"), ("b", "running"), ("a", "failed"), ("c", "pending"), ("a", "retrying"), ("b", "succeeded"), ("c", "running")]
    made = {}
    for every in (2, 1000):
        with Ledger(spark, str(tmp_path / f"l{every}"), snapshot_every=every) as ledger:
            for key, to in steps:
                ledger.append(spark.createDataFrame([("s", key, to)], "stage string, input_hash string, to_status string"))
            refused = ledger.append(spark.createDataFrame([("s", "b", "running"), ("s", "x", "failed")], "stage string, input_hash string, to_status string"))
            assert {(r.input_hash, r.reason) for r in refused.collect()} == {("b", "illegal"), ("x", "unknown")}
            made[every] = {(r.input_hash, r.status, r.attempt_count) for r in ledger.states().collect()}
            assert ledger.get("s", "a")["attempt_count"] == 1 and ledger.log().count() == len(steps)
            if every == 2:
                assert ledger.log(ledger._snapshot()).count() <= 2
                again = Ledger(spark, str(tmp_path / "l2"), snapshot_every=2)
                assert again.transition("s", "a", "running")["attempt_count"] == 2
    assert made[2] == made[1000] == {("a", "retrying", 1), ("b", "succeeded", 1), ("c", "running", 1)}
