"""Set-based stages: each gives its output and the transitions to append, output first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import faults
from millrace.operators.cleaning import BATCH, MIN_TEXT_DECODE_FIRST, MIN_TEXT_STRIP_FIRST, batch_hashes, batched, clean_records_decoded, dedup_first
from millrace.operators.embedding import Embedder, encode
from millrace.operators.jobs import Jobs
from millrace.operators.ledger import KEY, RUNNABLE, Ledger
from millrace.operators.store import ParquetStore
from millrace.sources.jsonl import load_product_meta, parse_lines
from millrace.sources.sinks import write_parquet
from millrace.staging import Shelf, staged

INGEST, EMBED, STORE = "ingest", "embed", "vectorstore"


@dataclass
class Stage:
    """``output`` and ``outcomes`` (stage, input_hash, to_status, error_*, rows_out) of the units that ran; both are read from the shelf."""

    output: DataFrame
    outcomes: DataFrame
    shelf: Shelf


def _to_run(units: DataFrame, ledger: Ledger) -> DataFrame:
    """Units without a ledger row, or pending or retrying; what is done, failed or stuck running is passed over."""
    states = ledger.states().select(*KEY, "status")
    return units.join(states, KEY, "left").filter(F.col("status").isNull() | F.col("status").isin(*RUNNABLE)).drop("status")


# Each stage works in four steps, whose tables lie on its shelf: the units it takes on are written
# before the ledger says that they run, and their results before it says how they ended. A stage
# that is begun again with the same shelf so takes on the same units, makes nothing anew that is
# whole, and asks the ledger for transitions that it passes over where they are recorded already.


def ingest_records(ledger: Ledger, lines: DataFrame, *, min_text_length: int = MIN_TEXT_STRIP_FIRST, shelf: Shelf | None = None) -> Stage:
    """Raw lines (line_number, raw) -> cleaned records; each line is a unit keyed by its raw text's hash.

    A filtered record succeeds with 0 rows out; a malformed line, a text of a wrong type or
    an injected fault fails with its error as data, and the others go on. The first of
    equal lines is the unit. No success is recorded before its record is on the shelf.
    """
    shelf = shelf or Shelf(ledger.spark)

    def claimed() -> DataFrame:
        parsed = parse_lines(lines).withColumns({"stage": F.lit(INGEST), "input_hash": X.content_hash(F.col("raw"))})
        return faults.with_faults(dedup_first(_to_run(parsed, ledger), order_col="line_number", text_col="raw"), INGEST, order_col="line_number")

    units = shelf.table("ingest-units", claimed)
    ledger.begin(units.select(*KEY, F.lit(1).alias("rows_in")))
    shelf.passed("ingest-running")

    def judged() -> DataFrame:
        kind, said = F.coalesce("fault_type", "error_type"), F.coalesce("fault_message", "error_message")
        title, text = (X.clean_strip_first(F.coalesce(F.col(f"data.{c}"), F.lit(""))) for c in ("title", "text"))
        rows = units.withColumns({"error_type": kind, "error_message": said, "title": F.when(F.col("data.title").isNotNull(), title), "text": text})
        return rows.withColumn("kept", F.col("error_type").isNull() & F.col("data.rating").isNotNull() & (F.length("text") >= min_text_length))

    done = shelf.table("ingest", judged)
    fields = [F.col(f"data.{c}").alias(c) for c in ("rating", "asin", "parent_asin", "helpful_vote", "timestamp")]
    output = done.filter("kept").select("line_number", "raw", "title", "text", *fields, "variant")
    failed = F.col("error_type").isNotNull()
    outcomes = done.select(*KEY, F.when(failed, "failed").otherwise("succeeded").alias("to_status"), "error_type", "error_message", F.when(~failed, F.col("kept").cast("int")).alias("rows_out"))
    ledger.append(outcomes)
    shelf.passed("ingest-recorded")
    return Stage(output, outcomes, shelf)


def embed_stage(ledger: Ledger, records: DataFrame, embedder: Embedder, *, size: int = BATCH, shelf: Shelf | None = None) -> Stage:
    """Cleaned records -> embedded chunks in batches, each a unit keyed by its batch hash; a batch fails as a whole.

    Batches that the ledger has done never reach the encoder, the others once; what it gave is on
    the shelf before any success is recorded.
    """
    shelf = shelf or Shelf(ledger.spark)

    def claimed() -> DataFrame:
        numbered = staged(batched(records, order_col="line_number", size=size), "batches")
        units = batch_hashes(numbered).withColumnRenamed("batch_hash", "input_hash").withColumn("stage", F.lit(EMBED))
        fault = faults.take(EMBED)
        hit = F.col("batch_id") < (fault[1] if fault else 0)
        kind, said = (faults.FAULTS[fault[0]].__name__, faults.message(EMBED, fault[0])) if fault else ("", "")
        return numbered.join(_to_run(units, ledger), "batch_id").withColumns({"fault_type": F.when(hit, F.lit(kind)), "fault_message": F.when(hit, F.lit(said))})

    units = shelf.table("embed-units", claimed)
    ledger.begin(units.select(*KEY, "rows_in").dropDuplicates(KEY))
    shelf.passed("embed-running")

    def encoded() -> DataFrame:
        rows = encode(units.filter("fault_type is null"), embedder)
        return rows.unionByName(units.filter("fault_type is not null").withColumnsRenamed({"fault_type": "error_type", "fault_message": "error_message"}), allowMissingColumns=True)

    done = shelf.table("embed", encoded)
    metadata = F.to_json(F.struct(*[c for c in ("title", "rating", "asin", "parent_asin", "helpful_vote", "timestamp") if c in done.columns]))
    output = done.filter("error_type is null").select("line_number", X.content_hash(F.col("text")).alias("id"), "text", "embedding", metadata.alias("metadata"))
    ended = done.groupBy(*KEY).agg(F.max("error_type").alias("error_type"), F.max("error_message").alias("error_message"), F.max("rows_in").alias("rows_in"))
    outcomes = ended.select(*KEY, F.when(F.col("error_type").isNull(), "succeeded").otherwise("failed").alias("to_status"), "error_type", "error_message", F.when(F.col("error_type").isNull(), F.col("rows_in").cast("int")).alias("rows_out"))
    ledger.append(outcomes)
    shelf.passed("embed-recorded")
    return Stage(output, outcomes, shelf)


def load_stage(store: ParquetStore, chunks: DataFrame) -> int:
    """Insert what the store hasn't; an armed fault raises and leaves the store as it was."""
    faults.trigger(STORE)
    rows = chunks.withColumn("created_at", F.current_timestamp())
    return store.insert(rows, order_col="line_number")


def ingest_reviews(reviews: DataFrame, meta: DataFrame, *, category: str, order_col: str = "line_number", limit: int | None = 50_000, min_text_length: int = MIN_TEXT_DECODE_FIRST) -> DataFrame:
    """The batch form: limit by order, clean, filter, dedup without case, join product metadata.

    ``id`` is the text hash's first 16 digits; ``category`` stands where the metadata has none or an empty one.
    """
    rows = reviews if limit is None else reviews.orderBy(order_col).limit(limit)
    kept = dedup_first(clean_records_decoded(rows, min_text_length=min_text_length), order_col=order_col, ignore_case=True, hash_col="__text_hash")
    # every product's first record: cheaper than cleaning all reviews once more to learn which products they name
    products = load_product_meta(meta.filter("parent_asin is not null")).select("parent_asin", F.col("title").alias("product_title"), F.col("category").alias("meta_category"))
    joined = kept.join(products, "parent_asin", "left")
    return joined.select(
        F.substring("__text_hash", 1, 16).alias("id"), "text", F.col("rating").cast("double").alias("rating"), "asin", "parent_asin", "helpful_vote", "timestamp", "product_title",
        F.coalesce(F.nullif("meta_category", F.lit("")), F.lit(category)).alias("category"),
    )


def run_ingest(jobs: Jobs, reviews: DataFrame, meta: DataFrame, path: str, *, category: str, limit: int | None = 50_000) -> DataFrame:
    """The batch form, written as Parquet, as the job ``ingest:<category>``; returns what was written."""
    with jobs.job(f"ingest:{category}") as job:
        write_parquet(ingest_reviews(reviews, meta, category=category, limit=limit), path)
        done = reviews.sparkSession.read.parquet(path)
        seen = reviews.count()
        job["records_in"], job["records_out"] = seen if limit is None else min(seen, limit + 1), done.count()
    return done


def run_counters(raw: DataFrame, *, min_text_length: int = MIN_TEXT_STRIP_FIRST, ignore_case: bool = False, limit: int | None = None, order_col: str = "line_number") -> DataFrame:
    """``raw_seen, after_filter, kept`` of a run over raw reviews, a row, from one pass: each text is cleaned once.

    A run with a ``limit`` sees the record after its last one before it stops, and counts it.
    """
    if limit is not None:
        seen = raw.limit(limit + 1).count()
        return run_counters(raw.orderBy(order_col).limit(limit), min_text_length=min_text_length, ignore_case=ignore_case).withColumn("raw_seen", F.lit(seen).cast("long"))
    text = X.clean_strip_first(F.coalesce(F.col("text"), F.lit("")))
    rows = raw.select("rating", text.alias("text")).withColumn("sound", F.col("rating").isNotNull() & (F.length("text") >= min_text_length))
    digest = X.text_hash(F.col("text")) if ignore_case else X.content_hash(F.col("text"))
    rows = rows.select("sound", F.when(F.col("sound"), digest).alias("hash"))
    by_text = rows.groupBy("hash").agg(F.count("*").alias("n"), F.count_if("sound").alias("sound"))
    return by_text.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw_seen"), F.coalesce(F.sum("sound"), F.lit(0)).alias("after_filter"), F.count("hash").alias("kept"))
