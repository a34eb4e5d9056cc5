"""Content-addressed token store: chunks by rolling hash, document recipes, Merkle manifests.

Under the store's folder, all as Parquet written by Spark:

- ``chunks`` (digest, n, payload): each different run of ids once, its ids little-endian in
  ``width`` bytes; digest = BLAKE2b-128 of the payload.
- ``recipes`` (part, pos, id, n_tokens, digests, sizes): documents in ascending id, ``part``
  by range of ids and ``pos`` within it; digests end to end, sizes in ids.
- ``manifest`` (part, n_docs, n_tokens, first, root, width): the ids before the part, and the
  Merkle root over its recipes (SHA-256, FAN to a node).

A chunk ends where the hash of the last WINDOW ids has its low CUT bits clear, or after MOST
ids, so equal passages give equal chunks wherever they stand.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import kernel as K
from millrace.llm.common import fresh_dir, ranges_for, staging
from millrace.llm.tokens import Encoder, with_end

WINDOW, CUT, MOST, FAN = 16, 8, 2048, 1024
_DIGEST = 16


def _digest(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=_DIGEST).digest()


def chunk_ends(ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the chunks of a row of documents end; every document's end is one."""
    h, w, p = K.mix(ids.astype(np.uint64) + np.uint64(1)), 1, 0x9E3779B97F4A7C15
    while w < WINDOW and len(h) > w:
        h = h[:-w] * np.uint64(pow(p, w, 1 << 64)) + h[w:]
        w *= 2
    at = np.flatnonzero((K.mix(h) & np.uint64((1 << CUT) - 1)) == 0) + WINDOW if w == WINDOW else np.zeros(0, np.int64)
    doc = np.searchsorted(offs, at, "left") - 1
    at = at[at - offs[doc] >= WINDOW]
    ends = np.unique(np.concatenate([at, offs[1:]]))
    size = np.diff(ends, prepend=0)
    forced = [np.arange(e - s + MOST, e, MOST) for e, s in zip(ends[size > MOST].tolist(), size[size > MOST].tolist(), strict=True)]
    return np.unique(np.concatenate([ends, *forced]))


def _encode(path: str, end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in K.slices(batches, "text"):
            ids, offs = with_end(*encoder.encode(batch.column("text")), end)
            ends = chunk_ends(ids, offs)
            if len(ids) and int(ids.max()) >> (8 * width):
                raise ValueError(f"token id {int(ids.max())} needs more than {width} bytes")
            raw = ids.astype(f"<u{width}").tobytes()
            bounds = np.concatenate([[0], ends])
            digests, seen = [], {}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                digests.append(d := _digest(x := raw[a * width : b * width]))
                seen.setdefault(d, (b - a, x))
            cut = np.searchsorted(ends, offs[1:]) + 1
            first = np.concatenate([[0], cut[:-1]])
            sizes = np.diff(bounds)
            n, m = batch.num_rows, len(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(n, np.int32), np.ones(m, np.int32)])),
                    pa.concat_arrays([batch.column("id"), pa.nulls(m, batch.column("id").type)]),
                    pa.array(np.concatenate([np.diff(offs), [v[0] for v in seen.values()]]).astype(np.int64)),
                    pa.array([b"".join(digests[a:b]) for a, b in zip(first.tolist(), cut.tolist(), strict=True)] + list(seen), pa.binary()),
                    pa.array([sizes[a:b].tolist() for a, b in zip(first.tolist(), cut.tolist(), strict=True)] + [None] * m, pa.list_(pa.int64())),
                    pa.array([None] * n + [v[1] for v in seen.values()], pa.binary()),
                ],
                ["kind", "id", "n", "digest", "sizes", "payload"],
            )

    return run


def _roots(recipes: DataFrame) -> DataFrame:
    """``part, n_docs, n_tokens, root``: each level hashes FAN nodes into one."""
    leaf = F.sha2(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("n_tokens").cast("string"), F.hex("digests")), 256)
    nodes = recipes.select("part", "pos", leaf.alias("h"), "n_tokens", F.lit(1).cast("long").alias("n_docs"))
    for _ in range(4):  # FAN**4 documents in a part
        nodes = nodes.groupBy("part", F.expr(f"pos div {FAN}").alias("up")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "h"))), lambda x: x["h"]), ""), 256).alias("h"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs"))
        nodes = nodes.withColumnRenamed("up", "pos")
    return nodes.select("part", "n_docs", "n_tokens", F.col("h").alias("root"))


def write_store(docs: DataFrame, path: str, tokenizer: str, *, end: int = 2, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text (null: empty), add ``end``, and write the store; ``width`` bytes hold every id.

    An id that ``width`` bytes can't hold fails the write. Repeated rows and ids are documents each, next to each other; null ids come first.
    Other columns are ignored. An empty table gives an empty store.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    encoded = base.mapInArrow(K.released(_encode(tokenizer, end, width)), f"kind int, id {kind}, n long, digest binary, sizes array<long>, payload binary")
    stage = fresh_dir(spark, "encoded") + "/table"
    with staging(spark):
        encoded.write.partitionBy("kind").option("compression", "zstd").parquet(stage)
        staged = spark.read.schema(encoded.schema).parquet(stage)
        recipes = staged.filter("kind = 0").select("id", F.col("n").alias("n_tokens"), F.col("digest").alias("digests"), "sizes")
        parts = ranges_for(recipes.agg(F.sum(F.octet_length("digests") + 32)).first()[0], 2 << 20)
        # documents of one id, and even of one text, may fall into several parts
        ordered = recipes.repartitionByRange(parts, "id", "digests", F.monotonically_increasing_id()).sortWithinPartitions("id", "digests")
        place = F.monotonically_increasing_id()
        ordered.withColumn("part", F.shiftright(place, 33)).withColumn("pos", place.bitwiseAND((1 << 33) - 1)).write.option("compression", "zstd").parquet(f"{path}/recipes")
        chunks = staged.filter("kind = 1").groupBy("digest").agg(F.first("n").alias("n"), F.first("payload").alias("payload"))
        chunks.write.option("compression", "zstd").parquet(f"{path}/chunks")
        roots = _roots(spark.read.parquet(f"{path}/recipes"))
        first = (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("first")
        roots.select("part", "n_docs", "n_tokens", first, "root", F.lit(width).alias("width")).write.parquet(f"{path}/manifest")


def _checked(width: int):
    """Chunks -> digest, n and the CRC-32 of their ids in 32 bits; a payload that isn't its digest's fails the read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = []
            for digest, payload in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if _digest(payload) != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                crc.append(zlib.crc32(np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("n"), pa.array(crc, pa.int64())], ["digest", "n", "crc"])

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recipes -> a row per chunk: its digest, place and the ids after it in its document."""
    for batch in batches:
        part, pos = batch.column("part").to_numpy(), batch.column("pos").to_numpy()
        sizes = batch.column("sizes").to_pylist()
        n = np.array([len(s) for s in sizes])
        digests = [d[i : i + _DIGEST] for d in batch.column("digests").to_pylist() for i in range(0, len(d), _DIGEST)]
        after = [np.cumsum(s[::-1])[::-1] - s for s in map(np.array, sizes)]
        cols = [pa.array(np.repeat(part, n)), pa.array(np.repeat(pos, n)), pa.array(np.concatenate([np.arange(k) for k in n] or [[]]).astype(np.int64)), pa.array(np.concatenate(after or [[]]).astype(np.int64)), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["part", "pos", "seq", "after", "digest"])


def _zeros() -> np.ndarray:
    """For each power of two of zero bytes, what each bit of a CRC-32 becomes after them."""
    one = np.array([zlib.crc32(b"\0", 0xFFFFFFFF ^ (1 << b)) ^ zlib.crc32(b"\0", 0xFFFFFFFF) for b in range(32)], np.uint64)
    rows = [one]
    for _ in range(47):
        rows.append(_apply(rows[-1], rows[-1]))
    return np.array(rows)


def _apply(matrix: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    for b in range(32):
        out ^= np.where(x >> np.uint64(b) & np.uint64(1), matrix[b], np.uint64(0))
    return out


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's CRC-32 carried over the bytes after it; a document's own is all of these by exclusive or."""
    tables = _zeros()
    for batch in batches:
        crc = batch.column("crc").to_numpy().astype(np.uint64)
        far = batch.column("after").to_numpy() * 4
        for b, matrix in enumerate(tables):
            at = np.flatnonzero(far >> b & 1)
            if len(at):
                crc[at] = _apply(matrix, crc[at])
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("pos"), batch.column("n"), pa.array(crc.astype(np.int64))], ["part", "pos", "n", "crc"])


def _verified(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """Recipes and manifest, once the recipes' Merkle roots are the manifest's; and the width."""
    recipes, manifest = spark.read.parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/manifest")
    told = manifest.select("part", *[F.col(c).alias(f"told_{c}") for c in ("n_docs", "n_tokens", "root")])
    differs = F.expr("not (n_docs <=> told_n_docs and n_tokens <=> told_n_tokens and root <=> told_root)")
    if _roots(recipes).join(told, "part", "full_outer").filter(differs).count():
        raise ValueError(f"{path}: recipes differ from the manifest")
    widths = [r.width for r in manifest.select("width").distinct().collect()]
    return recipes, manifest, widths[0] if widths else 2


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each document, from the store's files.

    Every chunk is read and checked once, whatever documents hold it; a document's CRC-32
    is put together from its chunks'. A missing chunk fails the query.
    """
    recipes, manifest, width = _verified(spark, path)
    chunks = spark.read.parquet(f"{path}/chunks").mapInArrow(K.released(_checked(width)), "digest binary, n long, crc long")
    listed = recipes.select("part", "pos", "digests", "sizes").mapInArrow(K.released(_listed), "part long, pos long, seq long, after long, digest binary")
    joined = listed.join(chunks, "digest", "left").select("part", "pos", "after", F.coalesce("n", F.raise_error(F.lit("a chunk is missing")).cast("long")).alias("n"), "crc")
    sums = joined.mapInArrow(K.released(_moved), "part long, pos long, n long, crc long").groupBy("part", "pos").agg(F.sum("n").alias("n"), F.bit_xor("crc").alias("ids_crc32"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("pos")) - F.col("n_tokens")
    placed = recipes.select("part", "pos", "id", "n_tokens", within.alias("within")).join(manifest.select("part", "first"), "part")
    return placed.join(sums, ["part", "pos"]).select("id", (F.col("first") + F.col("within")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32")


def _joined(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([np.frombuffer(p, f"<u{width}") for p in x]).astype(np.int32) for x in batch.column("payloads").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([i.tolist() for i in ids], pa.list_(pa.int32()))], ["id", "ids"])

    return run


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``id, ids``: every document as written, its chunks joined in order."""
    recipes, _, width = _verified(spark, path)
    listed = recipes.select("part", "pos", "digests", "sizes").mapInArrow(K.released(_listed), "part long, pos long, seq long, after long, digest binary")
    whole = listed.join(spark.read.parquet(f"{path}/chunks"), "digest").groupBy("part", "pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "payload"))), lambda x: x["payload"]).alias("payloads"))
    kind = recipes.schema["id"].dataType.simpleString()
    return recipes.select("part", "pos", "id").join(whole, ["part", "pos"]).select("id", "payloads").mapInArrow(K.released(_joined(width)), f"id {kind}, ids array<int>")
