"""The continuous worker, streaming dedup and a streaming ledger."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from millrace.functions import text as X
from millrace.operators import faults
from millrace.operators.cleaning import dedup_first, ranked, text_hashes
from millrace.operators.embedding import Embedder
from millrace.operators.ingest import EMBED, INGEST, STORE, embed_stage, ingest_records, load_stage
from millrace.operators.ledger import TRANSITIONS, Ledger
from millrace.operators.store import ParquetStore
from millrace.operators.telemetry import Telemetry
from millrace.sources import remote, sinks
from millrace.staging import Shelf, scratch, staged

#: Groups that the keys of a ledger's stream share.
BUCKETS = 4096


def stream_lines(spark: SparkSession, path: str, *, files_per_batch: int = 1) -> DataFrame:
    """``raw, file`` of each line of the files that arrive under a folder, or are appended to a file on a web server."""
    if remote.is_remote(path):
        return remote.stream_lines(spark, path).drop("start")
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(X.trim(F.col("value")).alias("raw"), F.col("_metadata.file_path").alias("file"))


def numbered(batch: DataFrame) -> DataFrame:
    """Line numbers within a micro-batch, in order of (file, place)."""
    rows = ranked(batch.withColumn("place", F.monotonically_increasing_id()), ["file", "place"], "n")
    return rows.select((F.col("n") + 1).alias("line_number"), "raw")


def run_worker(spark: SparkSession, source: str, ledger: Ledger, store: ParquetStore, embedder: Embedder, *, checkpoint: str, telemetry: Telemetry | None = None, fail_every: int | None = None, fault: tuple[str, str] = (INGEST, "rate_limit"), trigger: dict | None = None, on_step: Callable[[str], None] | None = None) -> StreamingQuery:
    """Read, ingest, embed and load each micro-batch; the stream's checkpoint is the resume offset.

    Every ``fail_every``-th batch, the first included, has a fault armed when it first runs.

    A batch may be cut short anywhere and runs again from the checkpoint. What its stages take
    on and give lies beside the checkpoint, in ``<checkpoint>-stages/<batch>``, until the store
    has it: the batch run again takes on the same lines, whatever the ledger says of them by
    then, and the store passes over what it has. So no row is lost or stored twice, and lines
    count as done only once their rows are on disk. ``on_step`` is told of each step passed.
    """
    measure = (telemetry or Telemetry()).setup()

    def work(batch: DataFrame, number: int) -> None:
        shelf = Shelf(spark, f"{checkpoint}-stages/{number:012d}", on_step=on_step)
        if fail_every and number % fail_every == 0 and not shelf.has("ingest-units"):
            faults.arm(*fault)
        with scratch():
            with measure.stage_span(INGEST) as span:
                records = ingest_records(ledger, numbered(batch), shelf=shelf).output
                span.rows_out = records.count()
            with measure.stage_span(EMBED) as span:
                embedded = embed_stage(ledger, records, embedder, shelf=shelf).output
                span.rows_in, span.rows_out = records.count(), embedded.count()
            with measure.stage_span(STORE) as span:
                span.rows_out = load_stage(store, embedded)
        shelf.passed("stored")
        ledger.close()
        shelf.drop()

    stream = stream_lines(spark, source).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()


def dedup_stream(stream: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The first arrival of each text; state holds a hash per text seen. For streams without an end see :func:`dedup_loads`."""
    return stream.withColumn("__h", X.content_hash(F.col(text_col))).dropDuplicates(["__h"]).drop("__h")


def dedup_loads(stream: DataFrame, path: str, *, order_col: str, text_col: str = "text", ignore_case: bool = False) -> DataFrame:
    """Run a stream to its end, from where it was, and give the first arrivals of all loads so far: of each text the smallest ``order_col`` of the first micro-batch that has it.

    The stream keeps no state: what has been seen lies as hashes below ``path``, a folder per
    batch, and a batch is joined with those of the batches before it. A batch that runs again
    overwrites its own rows and hashes, so it gives what it gave.
    """
    spark, rows, hashes = stream.sparkSession, f"{path}/rows", f"{path}/hashes"

    def keep(batch: DataFrame, number: int) -> None:
        with scratch():
            batch = staged(batch, "load")
            past = spark.read.schema("hash string, batch long").parquet(hashes).filter(F.col("batch") < number) if number and sinks.exists(spark, hashes) else None
            first = staged(dedup_first(batch, order_col=order_col, text_col=text_col, ignore_case=ignore_case, seen=past), "first")
            text_hashes(first, text_col=text_col, ignore_case=ignore_case).write.mode("overwrite").parquet(f"{hashes}/batch={number}")
            first.write.mode("overwrite").parquet(f"{rows}/batch={number}")

    run_batches(stream, keep, f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(rows).select(*stream.columns)


class _Folded(StatefulProcessor):
    """The ledger's states of one bucket of keys, column by column, and a timer for the first time that one of them waits for."""

    STATE = "stage array<string>, input_hash array<string>, status array<string>, attempts array<long>, refused array<long>, timer array<long>"
    OUT = "stage string, input_hash string, status string, attempt_count long, refused long, event string"

    def __init__(self, orphan_after: float | None):
        self.orphan_after = None if orphan_after is None else int(orphan_after * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("jobs", self.STATE)

    def _held(self) -> dict[tuple, tuple]:
        """(stage, input_hash) -> (status, attempts, refused, timer)."""
        columns = self.state.get()
        return {} if columns is None else {(s, h): tuple(x) for s, h, *x in zip(*columns, strict=True)}

    @staticmethod
    def _first(jobs: dict[tuple, tuple]) -> int | None:
        return min((x[3] for x in jobs.values() if x[3] is not None), default=None)

    def _keep(self, jobs: dict[tuple, tuple], was: int | None) -> None:
        """One timer a bucket: what was set goes if another time is now the first."""
        first = self._first(jobs)
        if first != was:
            if was is not None:
                self.handle.deleteTimer(was)
            if first is not None:
                self.handle.registerTimer(first)
        self.state.update(tuple(map(list, zip(*((*key, *x) for key, x in jobs.items()), strict=True))))

    def _rows(self, jobs: dict[tuple, tuple], events: dict[tuple, str]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *jobs[key][:3], event) for key, event in events.items()], columns=["stage", "input_hash", "status", "attempt_count", "refused", "event"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        jobs = self._held()
        was, steps = self._first(jobs), []
        for part in rows:
            steps.extend(zip(*(part[c].tolist() for c in ("at", "seq", "stage", "input_hash", "to_status", "not_before")), strict=True))
        steps.sort(key=lambda x: x[:2])
        for at, _, stage, input_hash, to, not_before in steps:
            status, attempts, refused, timer = jobs.get((stage, input_hash), (None, 0, 0, None))
            if (status is None and to == "pending") or to in TRANSITIONS.get(status, ()):
                timer = not_before if to == "retrying" and not_before >= 0 else max(at // 1000 + self.orphan_after, 0) if to == "running" and self.orphan_after is not None else None
                jobs[stage, input_hash] = to, attempts + (to == "running"), refused, timer
            else:
                jobs[stage, input_hash] = status, attempts, refused + 1, timer
        self._keep(jobs, was)
        yield self._rows(jobs, {x[2:4]: "changed" for x in steps})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        jobs, expired = self._held(), expiredTimerInfo.getExpiryTimeInMs()
        now = max(expired, timerValues.getCurrentProcessingTimeInMs())
        events = {k: "due" if x[0] == "retrying" else "orphaned" for k, x in jobs.items() if x[3] is not None and x[3] <= now}
        if not events:
            return
        for k, event in events.items():
            status, attempts, refused, _ = jobs[k]
            jobs[k] = "failed" if event == "orphaned" else status, attempts, refused, None
        self._keep(jobs, None)  # Spark removes the timer that has expired
        yield self._rows(jobs, events)

    def close(self) -> None:
        pass


def ledger_stream(transitions: DataFrame, *, orphan_after: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``stage, input_hash, status, attempt_count, refused, event``: a row for each key that a micro-batch touches, with its state from then on.

    ``transitions`` are rows of the ledger's log (stage, input_hash, seq, to_status, ts, not_before),
    folded in order of (ts, seq) within a batch, with the rules of ``ledger.replay``; state lies in
    RocksDB, which the session is set to. ``event`` is ``changed``, or what a timer says: a retry is
    ``due`` once its ``not_before`` has passed, and a job that has been running for ``orphan_after``
    seconds is ``orphaned``: it fails here, so that a later end of it is refused.

    Each call of the state's server costs a round trip, and each group an Arrow batch, so keys share
    ``buckets`` groups by hash: a micro-batch pays for the buckets that it touches and reads and
    writes these whole. Their number is fixed for a checkpoint; one for some thousand keys is right.
    """
    transitions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    bucket = F.pmod(F.xxhash64("stage", "input_hash"), F.lit(buckets)).cast("int").alias("bucket")
    # numbers in place of times and nulls, which pandas holds as they are: a null time comes first, -1 is no time to wait for
    least = F.lit(-(1 << 63)).cast("long")
    at, seq = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), least).alias("at"), F.coalesce(F.col("seq").cast("long"), least).alias("seq")
    not_before = F.when(F.col("not_before").isNull(), -1).otherwise(F.greatest(F.unix_millis(F.col("not_before").cast("timestamp")), F.lit(0))).alias("not_before")
    rows = transitions.select(bucket, "stage", "input_hash", seq, "to_status", at, not_before)
    return rows.groupBy("bucket").transformWithStateInPandas(_Folded(orphan_after), _Folded.OUT, "Update", "ProcessingTime")


def ledger_states(transitions: DataFrame, path: str, *, orphan_after: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Run ``ledger_stream`` on what is there, from the checkpoint below ``path`` on, and give every key's newest state.

    Timers that have expired speak up in batches that have transitions; without any the stream ends.
    """
    conf, idle = transitions.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    names = ["stage", "input_hash", "status", "attempt_count", "refused", "event"]

    def keep(batch: DataFrame, number: int) -> None:
        batch.select(*names).write.mode("overwrite").parquet(f"{path}/states/batch={number}")

    before = conf.get(idle)
    conf.set(idle, "false")  # else a stream with timers looks for expired ones for ever
    try:
        run_batches(ledger_stream(transitions, orphan_after=orphan_after, buckets=buckets), keep, f"{path}/checkpoint", mode="update")
    finally:
        conf.set(idle, before)
    kinds = "stage string, input_hash string, status string, attempt_count long, refused long, event string, batch long"
    # of a batch a key has a row for its changes and one for its timer, which comes after them
    order = F.struct("batch", F.col("event") != "changed")
    held = transitions.sparkSession.read.schema(kinds).parquet(f"{path}/states")
    return held.groupBy("stage", "input_hash").agg(F.max_by(F.struct(*names[2:]), order).alias("s")).select("stage", "input_hash", "s.*").filter("status is not null")


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, *, mode: str = "append") -> None:
    """Everything that is there now, batch by batch, to the end."""
    stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
