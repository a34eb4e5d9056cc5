"""Quality rules: fixed base rules, then thresholds read from mergeable quantile sketches per language and source.

The sketch of a measure counts its values in bins that grow by the factor GAMMA, zero apart:
a quantile read from it is within ACCURACY of a true one, relatively, at any number of rows.
Sketches of any split of the rows add up to the same sketch, whatever the order, and their size
grows with the logarithm of the values' range alone. As rows (group, measure, bin, n) they are
built by grouped counts that combine before the shuffle, and agree on every rerun.

A group is judged by its own quantiles at every size, drawn towards its language's as if that
had PRIOR rows in it: fully its own when it is large, and never by a switch.

Most texts repeat nothing, so that the quartiles of repeated lines and words over all rows are
zeros and say nothing of what is usual among texts that do repeat. The quantiles of these
measures are those of the rows above zero, and so many rows count as the group's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm import kernel as K
from millrace.llm.common import staged

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Measure -> (SQL over the base counts, as a double; least distance of a threshold from the median; whether low values fail too; whether zeros are left out of its quantiles)
MEASURES = {
    "symbols": ("1e3 * n_symbols / n_words", 100, False, False),
    "dup_lines": ("1e3 * n_dup_lines / greatest(n_lines, 1)", 250, False, True),
    "repeats": ("1e3 * n_repeat_words / n_words", 100, False, True),
    "word_length": ("1e2 * word_chars / n_words", 100, True, False),
}
#: Growth of a sketch's bins, the relative error of its quantiles, and the bin of zero.
GAMMA = 1.02
ACCURACY = (GAMMA - 1) / (GAMMA + 1)
ZERO = -100_000
#: Rows by which a group's language counts beside its own.
PRIOR = 20
#: A threshold lies this many times the spread between the median and the outer quartile away from the median.
SPREADS = 8


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    data, offs = K.flat(column)
    n = len(offs) - 1
    starts, ends, first = K.words(data, offs)
    of_text = lambda x: np.add.reduceat(x.astype(np.int64), offs[:-1]) if n else np.zeros(0, np.int64)
    out = {"n_words": np.diff(first), "word_chars": of_text(~K.SPACE[data] & ((data & 0xC0) != 0x80)), "n_symbols": of_text(_SYMBOL[data])}

    doc = np.repeat(np.arange(n), np.diff(first))
    grams = K.shingles(K.word_hashes(data, starts, ends), 3)
    whole = np.flatnonzero(doc[: len(grams)] == doc[2:]) if len(grams) else np.zeros(0, np.int64)
    twice = whole[_repeated(grams[whole], doc[whole])[0]]
    covered = np.zeros(len(doc), bool)
    for j in range(3):
        covered[twice + j] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)

    breaks = np.flatnonzero(data == 10)
    a, b = np.sort(np.concatenate([offs[:-1], breaks + 1])), np.sort(np.concatenate([offs[1:] - 1, breaks]))
    wordy = np.searchsorted(starts, a) < np.searchsorted(starts, b)
    a, b = a[wordy], b[wordy]
    doc = np.searchsorted(offs, a, "right") - 1
    out["n_dup_lines"] = np.bincount(doc[_repeated(K.word_hashes(data, a, b), doc)[1]], minlength=n)
    out["n_lines"] = np.bincount(doc, minlength=n)
    return out


def _repeated(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of items whose hash occurs twice or more in their text; and of all items but one of each hash and text."""
    keys = K.mix(hashes ^ K.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    more = np.concatenate([[False], same])
    return order[more | np.concatenate([same, [False]])] if len(order) else order, order[more] if len(order) else order


def _counted(text_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, text_col):
            found = counts(batch.column(text_col))
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(found[c].astype(np.int64)) for c in BASE], names)

    return run


def with_counts(df: DataFrame, text_col: str) -> DataFrame:
    """The input's columns and the base counts of every whole text, as longs; ``text_col`` is a string and no column has a count's name."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in BASE)])
    return df.mapInArrow(K.released(_counted(text_col, df.columns + BASE)), schema)


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def sketches(counted: DataFrame) -> DataFrame:
    """``lang, source, measure, bin, n``: the quantile sketch of each measure over the rows that pass the base rules."""
    sound = counted.filter(~base_failed())
    bin_of = lambda sql: F.expr(f"case when {sql} > 0 then cast(ceil(ln({sql}) / ln({GAMMA}D)) as int) else {ZERO} end")
    bins = F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(sql).alias("bin")) for m, (sql, *_) in MEASURES.items()])
    return sound.select("lang", "source", F.inline(bins)).groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches added up over all but the given keys."""
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Per group and measure: ``rows``, and quartiles ``q1, q2, q3``, each the middle of the least bin that holds so many quarters.

    Where a measure's zeros are left out, ``rows`` are those above zero; with none of them the quartiles are zero.
    """
    w = Window.partitionBy(*keys, "measure")
    zeros_out = [m for m, (*_, out) in MEASURES.items() if out]
    sketch = sketch.withColumn("n", F.when((F.col("bin") == ZERO) & F.col("measure").isin(zeros_out), 0).otherwise(F.col("n")))
    cum = sketch.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("rows", F.sum("n").over(w))
    at = lambda quarters: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * quarters, F.col("bin")))
    value = lambda b: F.when(b == ZERO, 0.0).otherwise(2.0 * F.pow(F.lit(GAMMA), b) / (1.0 + GAMMA))
    found = cum.groupBy(*keys, "measure").agg(F.max("rows").alias("rows"), *[at(i).alias(f"b{i}") for i in (1, 2, 3)])
    return found.select(*keys, "measure", "rows", *[value(F.col(f"b{i}")).alias(f"q{i}") for i in (1, 2, 3)])


def thresholds(counted: DataFrame) -> DataFrame:
    """One row per language and source: ``<measure>_lo`` and ``<measure>_hi``; values outside fail."""
    fine = staged(sketches(counted), "sketch")
    own, wide = quantiles(fine, "lang", "source"), quantiles(merged(fine, "lang"), "lang")
    drawn = [((F.col("o.rows") * F.col(f"o.q{i}") + PRIOR * F.col(f"w.q{i}")) / (F.col("o.rows") + PRIOR)).alias(f"q{i}") for i in (1, 2, 3)]
    joined = own.alias("o").join(wide.alias("w"), F.expr("o.lang <=> w.lang and o.measure = w.measure")).select("o.lang", "o.source", "o.measure", *drawn)
    cuts = []
    for m, (_, least, low, _) in MEASURES.items():
        hi = F.expr(f"q2 + greatest({least}D, {SPREADS} * (q3 - q2))")
        lo = F.expr(f"q2 - greatest({least}D, {SPREADS} * (q2 - q1))") if low else F.lit(0.0)
        mine = F.col("measure") == m
        cuts += [F.max(F.when(mine, lo)).alias(f"{m}_lo"), F.max(F.when(mine, hi)).alias(f"{m}_hi")]
    return joined.groupBy("lang", "source").agg(*cuts)


def _judged(counted: DataFrame, cut: DataFrame) -> DataFrame:
    """Counted rows with their group's thresholds, ``base_failed`` and ``kept``."""
    cut = cut.withColumnRenamed("lang", "cut_lang").withColumnRenamed("source", "cut_source")
    rows = counted.join(cut, F.expr("lang <=> cut_lang and source <=> cut_source"), "left").drop("cut_lang", "cut_source")
    within = F.lit(True)
    for m, (sql, *_) in MEASURES.items():
        within = within & F.expr(f"{sql} between {m}_lo and {m}_hi")
    failed = base_failed()
    return rows.withColumns({"base_failed": failed, "kept": F.when(failed, False).otherwise(F.coalesce(within, F.lit(True)))})


def quality_verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id, lang, source``, the base counts, the group's thresholds, ``base_failed, kept``.

    A text of no words (null, empty) fails the base rules. Null languages and sources
    are groups like any other. Repeated rows get equal verdicts. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).cast("string").alias("text"))
    counted = staged(with_counts(base, "text").drop("text"), "quality")
    cut = staged(thresholds(counted), "thresholds")  # its size is then known, so it is broadcast only if small
    return _judged(counted, cut)


def keep_quality(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The input's rows that pass, columns as they were, whatever they are called.

    Texts are counted once for the sketches and once as rows stream by: writing them out in
    between, or sending them to their verdicts, would cost more. A batch on its way to Python
    holds a text once where the column is a string, else beside it its string as well.
    """
    text = F.col(text_col).cast("string")
    groups = [F.col(lang_col).alias("lang"), F.col(source_col).alias("source")]
    cut = staged(thresholds(with_counts(docs.select(*groups, text.alias("text")), "text").drop("text")), "thresholds")
    names = [f"c{i}" for i in range(len(docs.columns))]  # any names, clashing ones as well, stand aside meanwhile
    if text_col in docs.columns and isinstance(docs.schema[text_col].dataType, T.StringType):
        rows = with_counts(docs.select("*", *groups).toDF(*names, "lang", "source"), names[docs.columns.index(text_col)])
    else:
        rows = with_counts(docs.select("*", *groups, text).toDF(*names, "lang", "source", "text"), "text").drop("text")
    return _judged(rows, cut).filter("kept").select(*names).toDF(*docs.columns)
