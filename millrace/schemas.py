"""Explicit schemas of the engine's tables; nothing is inferred."""

from __future__ import annotations

EMBEDDING_DIM = 384

REVIEW = "rating DOUBLE, title STRING, text STRING, asin STRING, parent_asin STRING, helpful_vote INT, timestamp BIGINT"
RAW_LINE = "line_number BIGINT, raw STRING"
PRODUCT_META = "parent_asin STRING, title STRING, main_category STRING"
REVIEWS_CLEAN = "id STRING, text STRING, rating DOUBLE, asin STRING, parent_asin STRING, helpful_vote INT, timestamp BIGINT, product_title STRING, category STRING"
CHUNK_FILE = "chunk_id STRING, parent_id STRING, seq BIGINT, text STRING, embedding ARRAY<FLOAT>, rating DOUBLE, asin STRING, parent_asin STRING, helpful_vote INT"
CHUNKS = "id STRING, text STRING, embedding ARRAY<FLOAT>, metadata STRING, created_at TIMESTAMP"
TRANSITION = (
    "stage STRING, input_hash STRING, seq BIGINT, from_status STRING, to_status STRING, attempt INT, error_type STRING, "
    "error_message STRING, rows_in INT, rows_out INT, ts TIMESTAMP, not_before TIMESTAMP"
)
JOB = "id BIGINT, job_name STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, records_in BIGINT, records_out BIGINT, error STRING"
HEALING = "id BIGINT, failed_job_id BIGINT, observed_error STRING, diagnosis STRING, action_taken STRING, outcome STRING"
METRIC = "ts TIMESTAMP, stage STRING, error_type STRING, name STRING, value DOUBLE"
GOLD_PAIR = "query STRING, chunk_id STRING, chunk_text STRING"
GOLD_QUESTION = "question STRING, gold_chunk_id STRING, gold_parent_id STRING"
EVAL_RESULT = "table STRING, k INT, n BIGINT, recall_at_k DOUBLE, mrr DOUBLE"
