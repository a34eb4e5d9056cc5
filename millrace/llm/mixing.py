"""Mixing sources to target weights by Efraimidis-Spirakis keys and prefix sums, in SQL functions.

A source's target is its share of the budget by weight, at most ``most`` times its size; what
is cut off goes to the others by weight. The fixed point is one water level: target =
min(cap, level x weight), found from prefix sums over the sources in order of cap / weight.

Each document draws a key -ln(u) / quality from its id; in order of keys a source's documents
fill what its complete epochs leave of the target, the last of them in part. A source is put
in order in parts by key, as many as the table's rows ask for, so a source with a third of all
rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import row_key, staged

WEIGHTS = (5, 2, 1)
#: Sources that are ranked and summed in one task, about.
RANGE_ROWS = 100_000
#: Rows of a part by which a source is put in order, and the fewest and most parts.
BIN_ROWS, LEAST_BINS, MOST_BINS = 4096, 16, 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(id_col: str, seed: str) -> Column:
    """In (0, 1), from the id and the seed by MD5, alike on every rerun and in SQL elsewhere; a null id counts as empty."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _before(df: DataFrame, order: list[Column], **values: Column) -> DataFrame:
    """The rows with, for each value, its sum over all rows before (``<name>_before``) and over all (``<name>_all``), in an order.

    Ranges of the order are summed apart, about RANGE_ROWS in each, and follow the sums of those before.
    """
    parts = df.count() // RANGE_ROWS + 1
    place = F.monotonically_increasing_id()
    rows = df.withColumns(values).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", place)
    rows = staged(rows.withColumn("part", F.shiftright("place", 33)), "ordered")
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row per range
    sums = rows.groupBy("part").agg(*[F.sum(v).alias(f"{v}_sum") for v in values])
    sums = sums.select("part", *[F.coalesce(F.sum(f"{v}_sum").over(earlier), F.lit(0)).alias(f"{v}_first") for v in values], *[F.sum(f"{v}_sum").over(Window.partitionBy()).alias(f"{v}_all") for v in values])
    rows = rows.withColumns({f"{v}_in": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values}).join(F.broadcast(sums), "part")
    rows = rows.withColumns({f"{v}_before": F.col(f"{v}_first") + F.col(f"{v}_in") for v in values})
    return rows.drop("part", "place", *[f"{v}_{x}" for v in values for x in ("first", "in")])


def targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """``source, source_size, target`` of rows (source, size); sources by code point, null last, take ``weights`` in turn."""
    sums = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_name = F.col("source").asc_nulls_last()
    sums = _before(sums, [by_name], one=F.lit(1))
    sums = sums.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int")).cast("double"))
    sums = sums.select("source", "source_size", "weight", (most * F.col("source_size")).cast("double").alias("cap"))
    sums = staged(_before(sums, [F.col("cap") / F.col("weight"), by_name], c=F.col("cap"), w=F.col("weight"), s=F.col("source_size").cast("double")), "levels")
    # the level if exactly the sources before this one are full: never above the true one, and it for the first that isn't
    level = sums.agg(F.max((F.col("s_all") - F.col("c_before")) / (F.col("w_all") - F.col("w_before")))).first()[0]
    return sums.select("source", "source_size", F.least("cap", F.lit(level).cast("double") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, *, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """One row per input row: ``id, source, size, source_size, target, taken, key``, key as by ``row_key``.

    ``quality``: (id, quality) with quality above 0; 1.0 where it has no row or null, the
    greatest of an id's. ``taken`` counts words of the mix from this document: whole epochs
    while they fit the target, then documents in order of (key, id, size) until the rest is
    full. So a source's taken words are its target without the fraction. Texts without words
    (null, empty) have size 0 and are never taken. A null source is a source, the last.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), row_key(id_col, text_col).alias("key"))
    if quality is not None:
        best = quality.groupBy(F.col(quality.columns[0]).alias("q_id")).agg(F.max(quality.columns[1]).cast("double").alias("quality"))
        rows = rows.join(best, F.col("id") == F.col("q_id"), "left").drop("q_id")
    else:
        rows = rows.withColumn("quality", F.lit(1.0))
    # texts are read and counted once; what follows reads these few numbers a document
    rows = staged(rows.withColumn("turn", -F.log(uniform("id", seed)) / F.coalesce("quality", F.lit(1.0))), "sized")
    # parts that would be equal if every document had the mean quality
    about = rows.agg(F.count("*").alias("n"), F.avg(F.coalesce("quality", F.lit(1.0))).alias("q")).first()
    bins = min(MOST_BINS, max(LEAST_BINS, about.n // BIN_ROWS))
    rows = rows.withColumn("bin", F.floor(bins * (1 - F.exp(-F.col("turn") * float(about.q or 1.0)))))
    goal = targets(rows.select("source", "size")).withColumnRenamed("source", "g_source")
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("s"))
    bins = bins.select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), (F.sum("s").over(Window.partitionBy("source").orderBy("bin")) - F.col("s")).alias("before_bin"))
    order = Window.partitionBy("source", "bin").orderBy("turn", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(order))
    rows = rows.join(bins, F.expr("source <=> b_source and bin = b_bin")).join(goal, F.expr("source <=> g_source"))
    begin = F.col("before_bin") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - begin))
    return rows.select("id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"), "key")


def mixed_documents(docs: DataFrame, *, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The mix itself, in the input's columns: a row per time a document is taken whole, and the first words of what is taken in part.

    Of rows equal in id and text one stands for all, as often as they are taken together.
    """
    found = mix(docs, quality=quality, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
    wanted = staged(found.groupBy("key").agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).filter("taken > 0"), "mix")
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key")).join(wanted, "key").dropDuplicates(["key"])
    whole, part = F.expr("cast(taken div size as int)"), F.expr("cast(taken % size as int)")
    # each word with the white space before it, so that lines stay lines
    words = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), part), "")
    texts = F.concat(F.array_repeat(F.col("text"), whole), F.when(part > 0, F.array(words)).otherwise(F.array().cast("array<string>")))
    rows = rows.select("row", F.explode(texts).alias("text"))
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
