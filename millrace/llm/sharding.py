"""Jump consistent hashing in SQL functions: a shard by key and shard count alone, no ring table.

The generator is the published one, x -> 2862933555777941757 x + 1 modulo 2**64, worked in
limbs of 22 bits so that no product overflows a long. One run gives the shard among n and
among n + 1: the last jumps below either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_A = 2862933555777941757
_M22 = (1 << 22) - 1
#: Parts of each shard that are numbered apart.
PARTS = 256


def _step(x: Column) -> Column:
    """The generator's next state."""
    x0, x1, x2 = (F.shiftrightunsigned(x, s).bitwiseAND(_M22) for s in (0, 22, 44))
    a0, a1, a2 = (_A >> s & _M22 for s in (0, 22, 44))
    r0 = x0 * a0 + 1
    r1 = x0 * a1 + x1 * a0 + F.shiftright(r0, 22)
    r2 = x0 * a2 + x1 * a1 + x2 * a0 + F.shiftright(r1, 22)
    low = r0.bitwiseAND(_M22).bitwiseOR(F.shiftleft(r1.bitwiseAND(_M22), 22))
    return low.bitwiseOR(F.shiftleft(r2.bitwiseAND((1 << 20) - 1), 44))


def jump(key: Column, shards: int) -> Column:
    """``struct(shard, grown, draw)``: the shard of ``shards``, that of one more, and the first draw of 31 bits."""
    start = F.struct(key.cast("long").alias("x"), F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("draw"))

    def go(acc: Column, i: Column) -> Column:
        x = _step(acc["x"])
        r = F.shiftrightunsigned(x, 33)
        j = F.floor((acc["j"] + 1).cast("double") * (F.lit(2147483648.0) / (r + 1).cast("double"))).cast("long")
        moved = F.struct(x.alias("x"), j.alias("j"), F.when(j < shards, j).otherwise(acc["b"]).alias("b"), F.when(j <= shards, j).otherwise(acc["g"]).alias("g"), F.when(i == 1, r).otherwise(acc["draw"]).alias("draw"))
        return F.when((acc["j"] > shards), acc).otherwise(moved)

    # the first jump goes from -1, that is j + 1 = 0 -> bucket 0; so the run begins at bucket 0 with the state after one step
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, go, lambda a: F.struct(a["b"].cast("int").alias("shard"), a["g"].cast("int").alias("grown"), a["draw"].alias("draw")))


def shard_rows(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, size, text_crc32, law, shard, slot, grown_shard``.

    The key is the id where it is a number (else its 64-bit hash; null: 0). ``size`` is the
    text's UTF-8 bytes and 16 (null: 16), ``text_crc32`` that of its bytes (null: empty).
    ``slot`` numbers a shard's rows from 0 without gaps. Each shard is numbered in PARTS
    parts by bits of the key's first draw, by (id, size, crc) within a part, and a part's
    first slot is the rows of the parts before it, so no task sorts a whole shard. Rows
    equal in all three are alike and take slots in any order. Extra columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.col(id_col).cast("long") if kind in ("bigint", "int", "smallint", "tinyint") else F.xxhash64(id_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), jump(F.coalesce(key, F.lit(0)), shards).alias("j"))
    rows = rows.select("id", "size", "text_crc32", F.col("j.shard"), F.col("j.grown").alias("grown_shard"), F.col("j.draw").bitwiseAND(PARTS - 1).alias("part"))
    parts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    first = parts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "size", "text_crc32")) - 1
    rows = rows.withColumn("place", place).join(first, ["shard", "part"])
    return rows.select("id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("place")).alias("slot"), "grown_shard")
