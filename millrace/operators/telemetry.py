"""Telemetry: stage spans on the driver, metrics as rows, and the dashboard's aggregates as queries."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.schemas import METRIC

#: Upper bounds of the latency buckets in seconds, and the series' names.
BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60)
ROWS_IN, ROWS_OUT, ATTEMPTS, FAILURES, DURATION = "pipeline_rows_in_total", "pipeline_rows_out_total", "pipeline_attempts_total", "pipeline_failures_total", "pipeline_stage_duration_seconds"


class Span:
    def __init__(self) -> None:
        self.rows_in, self.rows_out, self.error_type = 1, 0, None

    def mark_failed(self, error_type: str) -> None:
        self.error_type = error_type


class Telemetry:
    """Collects what driver-side spans measure; ``setup`` may be called again, spans before it fail."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.ready = False

    def setup(self) -> Telemetry:
        self.ready = True
        return self

    def _add(self, stage: str, name: str, value: float, error_type: str | None = None) -> None:
        self.rows.append((datetime.now(UTC), stage, error_type, name, float(value)))

    @contextmanager
    def stage_span(self, stage: str, *, input_hash: str | None = None) -> Iterator[Span]:
        """Counts an attempt on entry; rows in and latency always, rows out on success, a failure by type. The hash labels nothing."""
        if not self.ready:
            raise RuntimeError("telemetry isn't set up")
        span, began = Span(), time.perf_counter()
        self._add(stage, ATTEMPTS, 1)
        try:
            yield span
        except BaseException as e:
            span.mark_failed(type(e).__name__)
            raise
        finally:
            self._add(stage, ROWS_IN, span.rows_in)
            self._add(stage, DURATION, time.perf_counter() - began)
            self._add(stage, FAILURES, 1, span.error_type) if span.error_type else self._add(stage, ROWS_OUT, span.rows_out)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRIC)


def bucket(value: Column, bounds: tuple[float, ...] = BOUNDS) -> Column:
    """How many bounds lie below the value; bounds are inclusive."""
    return sum((F.when(value > b, 1).otherwise(0) for b in bounds), F.lit(0)).cast("long")


def counters(metrics: DataFrame, name: str, *labels: str) -> DataFrame:
    return metrics.filter(F.col("name") == name).groupBy(*labels).agg(F.sum("value").alias("total"))


def histogram(df: DataFrame, value_col: str, *labels: str, bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """``labels, bucket, n, cumulative``: every bucket that occurs, cumulative over those up to it."""
    counts = df.groupBy(*labels, bucket(F.col(value_col), bounds).alias("bucket")).agg(F.count("*").alias("n"))
    return counts.withColumn("cumulative", F.sum("n").over(Window.partitionBy(*labels).orderBy("bucket")))


def histogram_quantile(hist: DataFrame, q: float, *labels: str, bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """``labels, quantile``: linear within the bucket that holds the rank; in the last, open bucket its lower bound."""
    w = Window.partitionBy(*labels)
    total = F.max("cumulative").over(w)
    upper = F.element_at(F.array(*[F.lit(float(b)) for b in bounds]), (F.least(F.col("bucket"), F.lit(len(bounds) - 1)) + 1).cast("int"))
    lower = F.when(F.col("bucket") == 0, 0.0).otherwise(F.element_at(F.array(*[F.lit(float(b)) for b in bounds]), F.greatest(F.col("bucket"), F.lit(1)).cast("int")))
    rank = q * total
    at = hist.withColumn("rank", rank).filter("cumulative >= rank").withColumn("first", F.min("bucket").over(w)).filter("bucket = first")
    value = F.when(F.col("bucket") >= len(bounds), lower).otherwise(lower + (upper - lower) * (F.col("rank") - (F.col("cumulative") - F.col("n"))) / F.col("n"))
    return at.select(*labels, value.alias("quantile"))


def rates(df: DataFrame, ts_col: str, every: str, seconds: int, *labels: str, value: Column | None = None) -> DataFrame:
    """``labels, window_start, per_second`` over tumbling windows."""
    amount = F.sum(value) if value is not None else F.count("*")
    return df.groupBy(F.window(ts_col, every).alias("w"), *labels).agg((amount / seconds).alias("per_second")).select(*labels, F.col("w.start").alias("window_start"), "per_second")


def sliding_rates(df: DataFrame, ts_col: str, seconds: int, every: int, *labels: str, value: Column | None = None) -> DataFrame:
    """``labels, window_end, per_second`` over the ``seconds`` before each multiple of ``every``; windows without a row are absent.

    Amounts are summed per step first, so a row is shuffled once however many windows hold it.
    """
    amount = F.sum(value) if value is not None else F.count("*")
    step = (F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / (every * 1_000_000)) + 1).cast("long")
    sums = df.groupBy(*labels, step.alias("step")).agg(amount.alias("amount"))
    spread = sums.withColumn("step", F.explode(F.sequence(F.col("step"), F.col("step") + seconds // every - 1)))
    rates_ = spread.groupBy(*labels, "step").agg((F.sum("amount") / seconds).alias("per_second"))
    return rates_.select(*labels, F.timestamp_seconds(F.col("step") * every).alias("window_end"), "per_second")


def failure_ratio(metrics: DataFrame, *, seconds: int | None = None, every: int | None = None, ts_col: str = "ts") -> DataFrame:
    """``stage, failure_ratio`` of the whole run, or with ``seconds`` and ``every`` also ``window_end``: of the time before each step."""
    total = lambda n: F.sum(F.when(F.col("name") == n, F.col("value")))
    if seconds is None:
        return metrics.groupBy("stage").agg(F.try_divide(F.coalesce(total(FAILURES), F.lit(0.0)), total(ATTEMPTS)).alias("failure_ratio"))
    rows = sliding_rates(metrics.filter(F.col("name").isin(FAILURES, ATTEMPTS)), ts_col, seconds, every or seconds, "stage", "name", value=F.col("value"))
    part = lambda n: F.sum(F.when(F.col("name") == n, F.col("per_second")))
    return rows.groupBy("stage", "window_end").agg(F.try_divide(F.coalesce(part(FAILURES), F.lit(0.0)), part(ATTEMPTS)).alias("failure_ratio"))


def duration_series(metrics: DataFrame, bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """``stage, le, value``: a stage's durations as a scraper's histogram has them: how many are at most each bound, the last of which is null for infinity; at ``le`` -1 their sum."""
    rows = metrics.filter(F.col("name") == DURATION)
    counts = rows.groupBy("stage").agg(*[F.count_if(F.col("value") <= b).alias(f"b{i}") for i, b in enumerate(bounds)], F.count("*").alias("all"), F.sum("value").alias("sum"))
    series = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").cast("double").alias("value")) for i, b in enumerate(bounds)]
    series += [F.struct(F.lit(None).cast("double").alias("le"), F.col("all").cast("double").alias("value")), F.struct(F.lit(-1.0).alias("le"), F.col("sum").alias("value"))]
    return counts.select("stage", F.inline(F.array(*series)))


def exposition(metrics: DataFrame) -> str:
    """Counters and the histogram of durations in the text form that scrapers read; a row per series, so the driver holds few."""
    lines = []
    for r in duration_series(metrics).orderBy("stage", F.col("le").asc_nulls_last()).collect():
        if r.le is not None and r.le < 0:
            lines.append(f'{DURATION}_sum{{stage="{r.stage}"}} {r.value!r}')
            continue
        lines.append(f'{DURATION}_bucket{{stage="{r.stage}",le="{"+Inf" if r.le is None else format(r.le, "g")}"}} {r.value:g}')
        if r.le is None:
            lines.append(f'{DURATION}_count{{stage="{r.stage}"}} {r.value:g}')
    return _counter_lines(metrics) + "".join(f"{x}\n" for x in lines)


def _counter_lines(metrics: DataFrame) -> str:
    rows = metrics.filter(F.col("name") != DURATION).groupBy("name", "stage", "error_type").agg(F.sum("value").alias("v")).orderBy("name", "stage", "error_type").collect()
    return "".join(f'{r.name}{{stage="{r.stage}"' + (f',error_type="{r.error_type}"' if r.error_type else "") + f"}} {r.v:g}\n" for r in rows)
