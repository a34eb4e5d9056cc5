"""Healing: rules first, a model for the rest, capped backoff, and decisions as ledger transitions."""

from __future__ import annotations

import contextlib
import functools
import itertools
import json
import re
import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import truncate
from millrace.operators.ledger import InvalidTransition, Ledger, latest
from millrace.schemas import TRANSITION
from millrace.staging import scratch, staged

#: The menu and the patterns of the rules.
MENU = ("retry", "retry_with_failover", "escalate")
TRANSIENT_TYPE = r"(?i)timeout|ratelimit"
TRANSIENT_MESSAGE = r"(?i)\btimeout\b|\btimed out\b|\b429\b|rate.?limit|too many requests"
CODE_BUG_TYPE = r"(?i)^keyerror$|schemaerror"
CODE_BUG_MESSAGE = r"(?i)schema mismatch|schema error"
MAX_ATTEMPTS, BASE_BACKOFF, MAX_BACKOFF, JOB_ATTEMPTS, JOB_BACKOFF = 5, 1.0, 60.0, 2, 30


def classify_rules(error_type: Column, error_message: Column) -> Column:
    """``retry`` if transient, ``escalate`` if a code bug, null if a model must say; transient wins, null is empty."""
    kind, said = F.coalesce(error_type, F.lit("")), F.coalesce(error_message, F.lit(""))
    return F.when(kind.rlike(TRANSIENT_TYPE) | said.rlike(TRANSIENT_MESSAGE), "retry").when(kind.rlike(CODE_BUG_TYPE) | said.rlike(CODE_BUG_MESSAGE), "escalate")


def from_menu(answer: str, field: str, *, fenced: bool = False) -> dict | None:
    """A model's JSON object whose ``field`` is on the menu; null for every other answer. ``fenced``: a code fence around it is let pass."""
    if fenced:
        answer = re.sub(r"^```json|```$", "", answer.strip())
    try:
        found = json.loads(answer)
    except ValueError:
        return None
    return found if isinstance(found, dict) and found.get(field) in MENU else None


def classify_ambiguous(error_type: str | None, error_message: str | None, llm_call: Callable[[str, str], str]) -> str:
    """The menu item that the model names under ``decision``; a model that fails, or names none, leaves it to a person."""
    with contextlib.suppress(Exception):
        if found := from_menu(llm_call(error_type or "", error_message or ""), "decision"):
            return found["decision"]
    return "escalate"


def backoff_seconds(attempts: Column, base: float = BASE_BACKOFF, cap: float = MAX_BACKOFF) -> Column:
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(attempts - 1, F.lit(0))), F.lit(float(cap)))


def linear_backoff(attempt: Column, base: int = JOB_BACKOFF) -> Column:
    return base * attempt


def decisions(failed: DataFrame, *, max_attempts: int = MAX_ATTEMPTS, base: float = BASE_BACKOFF, cap: float = MAX_BACKOFF, llm_call: Callable[[str, str], str] | None = None) -> DataFrame:
    """``decision, delay`` beside failed jobs: the attempt cap, then the rules, then the model (offline: escalate).

    The model is asked on the driver once per distinct (type, message) that the rules leave.
    """
    spent = F.col("attempt_count") >= max_attempts
    ruled = failed.withColumn("decision", F.when(spent, "escalate").otherwise(classify_rules(F.col("error_type"), F.col("error_message"))))
    if llm_call:
        asked = ruled.filter("decision is null").select("error_type", "error_message").distinct()
        answers = [(r.error_type, r.error_message, classify_ambiguous(r.error_type, r.error_message, llm_call)) for r in asked.toLocalIterator()]
        if answers:
            said = failed.sparkSession.createDataFrame(answers, "a_type string, a_message string, answer string")
            ruled = ruled.join(said, F.expr("decision is null and error_type <=> a_type and error_message <=> a_message"), "left").withColumn("decision", F.coalesce("decision", "answer")).drop("a_type", "a_message", "answer")
    ruled = ruled.withColumn("decision", F.coalesce("decision", F.lit("escalate")))
    return ruled.withColumn("delay", F.when(F.col("decision") != "escalate", backoff_seconds(F.col("attempt_count"), base, cap)).otherwise(0.0))


def heal_all(ledger: Ledger, *, stage: str | None = None, now: datetime | None = None, **options: object) -> DataFrame:
    """Decide on every failed job and append the transitions; instead of sleeping, a retry has ``not_before``."""
    return heal(ledger, ledger.unhealed_failures(stage), now=now, **options)


def heal(ledger: Ledger, failed: DataFrame, *, now: datetime | None = None, **options: object) -> DataFrame:
    """The same for given failures (stage, input_hash, error_type, error_message, attempt_count); those that are healed already are passed over."""
    decided = staged(decisions(failed, **options), "decided")
    at = F.lit(now or datetime.now(UTC))
    to = decided.select("stage", "input_hash", F.when(F.col("decision") == "escalate", "escalated").otherwise("retrying").alias("to_status"), "error_type", "error_message", F.when(F.col("decision") != "escalate", at + F.make_dt_interval(secs=F.col("delay"))).alias("not_before"))
    ledger.append(to)
    return decided


def heal_stream(ledger: Ledger, *, checkpoint: str, stage: str | None = None, trigger: dict | None = None, **options: object) -> StreamingQuery:
    """The healer as a stream over the ledger's own log: each failure is decided on once, when it comes, at the cost of its batch.

    A failed transition carries its error and the attempts so far, so nothing else is folded but
    the keys at hand, when the answers are appended. A batch that runs again asks for transitions
    that are there already and is refused. The checkpoint says how far the log has been read.
    """
    log = ledger.spark.readStream.schema(f"{TRANSITION}, after BIGINT").parquet(ledger.path)
    failures = log.filter(F.col("to_status") == "failed")
    failures = failures.filter(F.col("stage") == stage) if stage else failures

    def work(batch: DataFrame, number: int) -> None:
        with scratch():
            # of a key that failed, was taken up and failed again in one batch the last failure counts
            last = latest(batch.select("stage", "input_hash", "seq", "ts", "error_type", "error_message", F.col("attempt").alias("attempt_count")))
            heal(ledger, last, **options)
        ledger.close()

    return failures.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def heal_job(ledger: Ledger, row: dict, *, max_attempts: int = MAX_ATTEMPTS, classify: Callable[[str, str], str], sleep_fn: Callable[[float], None] = time.sleep, base_backoff: float = BASE_BACKOFF, max_backoff: float = MAX_BACKOFF) -> str:
    """One failed job, blocking: the cap before the classifier, off the menu escalates; a lost race keeps the decision."""
    decision = "escalate" if row["attempt_count"] >= max_attempts else classify(row["error_type"], row["error_message"])
    decision = decision if decision in MENU else "escalate"
    if decision != "escalate":
        sleep_fn(min(base_backoff * 2 ** max(row["attempt_count"] - 1, 0), max_backoff))
    try:
        ledger.transition(row["stage"], row["input_hash"], "escalated" if decision == "escalate" else "retrying", error_type=row["error_type"], error_message=row["error_message"])
    except InvalidTransition:
        pass
    return decision


def poll(ledger: Ledger, on_failure: Callable[[dict], object], *, interval_seconds: float = 5.0, stage: str | None = None, max_iterations: int | None = None, sleep_fn: Callable[[float], None] = time.sleep) -> None:
    """Hand every failed job to the callback, pass after pass; no sleep before the first or after the last."""
    done = 0
    while max_iterations is None or done < max_iterations:
        if done:
            sleep_fn(interval_seconds)
        for row in ledger.unhealed_failures(stage).toLocalIterator():
            on_failure(row.asDict())
        done += 1


# -- named jobs ---------------------------------------------------------------


def unhealed_jobs(jobs: DataFrame, healing_log: DataFrame) -> DataFrame:
    """Failed jobs without a healing entry, by id."""
    failed = jobs.filter(F.col("status") == "failed")
    return failed.join(healing_log.select(F.col("failed_job_id").alias("id")), "id", "left_anti").orderBy("id")


def registry_match(jobs: DataFrame, prefixes: list[str]) -> DataFrame:
    """``prefix`` beside each job: the first in registry order that its name begins with, or null."""
    first = F.coalesce(*[F.when(F.startswith("job_name", F.lit(p)), F.lit(p)) for p in prefixes]) if prefixes else F.lit(None).cast("string")
    return jobs.withColumn("prefix", first)


#: What the healing log says of a job, and of what was done to it.
RECOVERED, NEEDS_HUMAN, NO_RUNNER, EXHAUSTED = "recovered", "needs_human", "no_registered_runner", "exhausted->needs_human"
UNPARSEABLE, ESCALATED, RETRIED, RETRIED_ALL = "unparseable", "escalate", "retry(attempt={})", "retry(x{})"


def diagnose(job_name: str, error: str, complete: Callable[[str], str]) -> dict:
    """``category, action, reasoning`` as the model has them; an answer that isn't such an object, or acts off the menu, is an escalation that quotes it."""
    answer = complete(f"Failed job {job_name!r}:\n{error}")
    unread = {"category": UNPARSEABLE, "action": "escalate", "reasoning": f"no diagnosis in: {answer[:200]}"}
    return from_menu(answer, "action", fenced=True) or unread


def _first_success(runner: Callable[[], object], waits: list[float], sleep_fn: Callable[[float], None]) -> int | None:
    """Which run, from 1, was the first to end well; each comes after its wait."""
    for i, seconds in enumerate(waits, 1):
        sleep_fn(seconds)
        with contextlib.suppress(Exception):
            runner()
            return i
    return None


def runner_for(job_name: str, registry: dict[str, Callable[[], object]]) -> Callable[[], object] | None:
    """Of the runners whose prefix the name begins with, the first in order."""
    return next((run for prefix, run in registry.items() if job_name.startswith(prefix)), None)


def job_registry(embed: Callable[[str], object], load: Callable[[str], object], **others: Callable[[], object]) -> dict[str, Callable[[], object]]:
    """The jobs that healing may run again: ``embed`` and ``load`` (into the table ``chunks_<strategy>``) once for each chunking strategy, and any others by name."""
    found = dict(others)
    for strategy in ("sentence", "fixed"):
        found[f"embed:{strategy}"] = functools.partial(embed, strategy)
        found[f"vecload:chunks_{strategy}"] = functools.partial(load, strategy)
    return found


def heal_named_job(job_id: int, job_name: str, error: str, *, registry: dict[str, Callable[[], object]], complete: Callable[[str], str], record: Callable[[int, str, dict, str, str], None], sleep_fn: Callable[[float], None] = time.sleep) -> str:
    """Diagnose, then rerun by the registry up to JOB_ATTEMPTS times with linear backoff; returns the outcome recorded."""
    found, runner = diagnose(job_name, error, complete), runner_for(job_name, registry)
    if found["action"] == "escalate" or runner is None:
        action, outcome = ESCALATED, NEEDS_HUMAN if found["action"] == "escalate" else NO_RUNNER
    else:
        run = _first_success(runner, [JOB_BACKOFF * (i + 1) for i in range(JOB_ATTEMPTS)], sleep_fn)
        action, outcome = (RETRIED.format(run), RECOVERED) if run else (RETRIED_ALL.format(JOB_ATTEMPTS), EXHAUSTED)
    record(job_id, error, found, action, outcome)
    return outcome


def watch_jobs(unhealed: Callable[[], DataFrame], heal: Callable[[int, str, str], object], *, seconds: float = 60.0, passes: int | None = None, sleep_fn: Callable[[float], None] = time.sleep) -> None:
    """Heal every job that ``unhealed()`` gives (``id, job_name, error``), wait, and look again: for ever, or for so many passes."""
    for _ in itertools.count() if passes is None else range(passes):
        for row in unhealed().toLocalIterator():
            heal(row.id, row.job_name, row.error)
        sleep_fn(seconds)


def healing_rows(spark, entries: list[tuple[int, int, str, dict, str, str]]) -> DataFrame:
    """Entries of the healing log as a table: (id, failed job, error, diagnosis, action, outcome)."""
    rows = [(i, j, e, d["reasoning"], a, o) for i, j, e, d, a, o in entries]
    return spark.createDataFrame(rows, "id BIGINT, failed_job_id BIGINT, observed_error STRING, diagnosis STRING, action_taken STRING, outcome STRING").withColumn("observed_error", truncate(F.col("observed_error"), 2000))
