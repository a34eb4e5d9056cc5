"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one verification per pair.

Sets. Every text is read once; its distinct n-grams, as sorted 48-bit hashes, are written to the
shared folder and all later steps read those. Documents of one set are one class from the start:
their sets agree in 128 bits of hash and in size. A class goes by the number of its first row.

Order of n-grams. Prefix filtering is lossless under any one order of all n-grams. Rare comes
first by a frequency sketch: every class's n-grams are counted in buckets of the hash space,
whose number follows the number of n-grams (at most 2**24), and n-grams are ordered by their
bucket's count on a logarithmic scale, then by hash. Frequent n-grams so come last at any size.

Buckets. Prefix n-grams meet in buckets. The member whose n-gram stands first in its prefix (of
a group of near copies, the one with the fewest n-grams of its own) is the bucket's pivot. Where
the sketch says that a bucket may be large its postings are counted, and if it is so it is dealt
into parts, whose pivots then meet.

Pairs. Members are paired with their pivots, verified, and joined into components; then members
of a bucket whose components still differ are paired, without the pairs that were verified. So
a group of n near copies costs about n pairs, no pair is verified twice and no link between
different components is lost. Components come without the links inside them; ``ngram_links``
verifies every pair that passes the filters and gives all links, at a cost that grows with them.

Members of a bucket meet by a join on bucket, band and part, not all with all. The n-gram must
stand early in the smaller set of a pair, earlier than in the larger: only such postings are one
side of the join, so a frequent n-gram late in everyone's prefix makes no pairs at all. Bands are
of sizes, as wide as linked sets differ; the other side is dealt into parts by its bucket's count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernel as K
from millrace.llm.common import drop_staged, row_key, staged
from millrace.llm.components import components

#: Rows of one long up to which a table is broadcast: 8 MB, counted first.
BROADCAST_ROWS = 1_000_000
#: Bits of a hash that are kept, and bytes of it in a packed set.
BITS, WIDTH = 48, 6
#: N-grams to a sketch bucket, and the fewest and most buckets (as powers of two).
PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 64, 16, 24
#: Steps of the sketch's scale in which a count doubles.
STEPS = 8
#: Sets of more n-grams than this pass a wider suffix filter before they are sent.
WIDE = 256
#: Pairs that a task verifies, about.
PAIRS = 2048
#: Postings of a part of a large bucket, and members of a part of one in a join with itself.
PART, MEET = 50_000, 2_000
#: Buckets in a row of the sketch while it is added up.
_CHUNK = 1 << 16
#: N-grams that a task orders or counts at once.
_AT_ONCE = 1 << 20
_SIG = [f"p{j}" for j in range(8)]
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _sets(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data = K.LOWER[data]
    starts, ends, first = K.words(data, offs)
    hashes = K.word_hashes(data, starts, ends)
    grams = K.shingles(hashes, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            g = np.sort(grams[a : b - k + 1] >> np.uint64(64 - BITS))
            yield g[np.concatenate([[True], g[1:] != g[:-1]])]
        else:
            yield K.short_shingle(hashes[a:b]) >> np.uint64(64 - BITS) if b > a else grams[:0]


def _packed(grams: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Sets laid end to end -> a binary value of WIDTH bytes a hash for each."""
    raw = np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH])
    at = np.concatenate([[0], ends]).astype(np.int64) * WIDTH
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(raw)]).cast(pa.binary())


def _unpacked(raw: pa.Buffer | np.ndarray) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8).reshape(-1, WIDTH)
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :WIDTH] = x
    return out.view("<u8").ravel()


def _column(column: pa.Array) -> np.ndarray:
    """All hashes of a column of packed sets, end to end."""
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32, len(column) + 1, column.offset * 4)
    return _unpacked(np.frombuffer(data, np.uint8, offs[-1] - offs[0], offs[0])) if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint64)


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            sets = list(_sets(*K.flat(batch.column("text")), k))
            n = np.array([len(g) for g in sets], np.int64)
            grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            del sets
            doc = np.repeat(np.arange(len(n)), n)
            mixed = K.mix(grams)
            whole = np.zeros((2, len(n)), np.uint64)
            full = np.flatnonzero(n)
            if len(full):
                first = (np.cumsum(n) - n)[full]
                whole[0, full] = np.bitwise_xor.reduceat(mixed, first) ^ K.mix(np.add.reduceat(grams, first) + n[full].astype(np.uint64))
                whole[1, full] = np.add.reduceat(K.mix(mixed ^ _OTHER), first)
            parity = np.bincount(doc * 512 + (mixed & np.uint64(511)).astype(np.int64), minlength=512 * len(n)).astype(np.uint8) & 1
            sig = np.packbits(parity.reshape(-1, 512), axis=1, bitorder="little").view(np.int64)
            cols = [batch.column("id"), batch.column("key"), pa.array(n), *(pa.array(w.view(np.int64)) for w in whole), _packed(grams, np.cumsum(n))]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(np.ascontiguousarray(sig[:, j])) for j in range(8))], ["id", "key", "n", "h1", "h2", "packed", *_SIG])

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows (with ``n`` and ``packed``), about _AT_ONCE n-grams at once."""
    for batch in batches:
        total, at = np.cumsum(batch.column("n").to_numpy()), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _AT_ONCE, "right")))
            yield batch.slice(at, end - at)
            at = end


def _counted(buckets: int):
    """Sets -> how many n-grams of this task fall into each bucket, a row for each _CHUNK of buckets.

    ``counts`` has a byte a bucket, compressed; what is above 255 stands in ``more`` as (bucket, excess).
    """
    chunk = min(_CHUNK, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, waiting = np.zeros(buckets, np.uint32), [], 0
        for batch in _gathered(batches):
            held.append((_column(batch.column("packed")) & np.uint64(buckets - 1)).astype(np.uint32))
            waiting += len(held[-1])
            if waiting >= max(buckets, _AT_ONCE):
                total += np.bincount(np.concatenate(held), minlength=buckets).astype(np.uint32)
                held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets).astype(np.uint32)
        used = np.flatnonzero(total.reshape(-1, chunk).any(axis=1))
        for k in range(0, len(used), 16):
            some, counts, more = used[k : k + 16], [], []
            for c in some.tolist():
                x = total[c * chunk : (c + 1) * chunk]
                at = np.flatnonzero(x > 255).astype(np.uint32)
                counts.append(pa.compress(np.minimum(x, 255).astype(np.uint8).tobytes(), "zstd", asbytes=True))
                more.append(np.concatenate([at, x[at] - np.uint32(255)]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts, pa.binary()), pa.array(more, pa.binary())], ["chunk", "counts", "more"])

    return run


def _levels(size: int):
    """Counts of all tasks in order of chunk -> each chunk's sums on the logarithmic scale, a byte a bucket."""

    def level(chunk: int, total: np.ndarray) -> pa.RecordBatch:
        steps = np.minimum(255, np.floor(STEPS * np.log2(total + 1))).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([steps.tobytes()], pa.binary())], ["chunk", "levels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for chunk, counts, more in zip(batch.column("chunk").to_pylist(), batch.column("counts"), batch.column("more"), strict=True):
                if chunk != now:
                    if now is not None:
                        yield level(now, total)
                    now, total = chunk, np.zeros(size, np.uint64)
                total += np.frombuffer(pa.decompress(counts.as_buffer(), size, "zstd"), np.uint8)
                at, excess = np.frombuffer(more.as_buffer(), np.uint32).reshape(2, -1)
                total[at] += excess
        if now is not None:
            yield level(now, total)

    return run


def frequency_sketch(sets: DataFrame) -> np.ndarray:
    """A byte for each bucket of the n-gram hash space: STEPS * log2 of how many n-grams of rows (n, packed) fall into it, and 1.

    One pass with a fixed table per task; at most 2**MOST_BUCKETS bytes come to the driver.
    """
    n = sets.agg(F.sum("n")).first()[0] or 0
    buckets = 1 << min(MOST_BUCKETS, max(LEAST_BUCKETS, (n // PER_BUCKET).bit_length()))
    chunk = min(_CHUNK, buckets)
    parts = sets.mapInArrow(K.released(_counted(buckets)), "chunk long, counts binary, more binary")
    found = staged(parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(K.released(_levels(chunk)), "chunk long, levels binary"), "sketch", rows=buckets // chunk, per_file=1)
    out = np.zeros(buckets, np.uint8)
    for at, levels in found.collect():
        out[at * chunk : (at + 1) * chunk] = np.frombuffer(levels, np.uint8)
    return out


def _prefixes(percent: int, sketch: np.ndarray):
    """Each class's set -> the n-grams of its prefix, rare first, with their positions and whether the sketch has them in large buckets."""
    much = _large()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            n, node = batch.column("n").to_numpy(), batch.column("node").to_numpy()
            g = _column(batch.column("packed"))
            doc = np.repeat(np.arange(len(n)), n)
            level = sketch[g & np.uint64(len(sketch) - 1)]
            # a set is sorted by hash, so a stable sort by (set, level) orders it by (level, hash)
            order = np.argsort((doc << 8) | level, kind="stable")
            pos = np.arange(len(g)) - (np.cumsum(n) - n)[doc]
            at = np.flatnonzero(pos < (n - (percent * n + 99) // 100 + 1)[doc])
            doc, pos, g = doc[at], pos[at], g[order[at]]
            cols = [g.view(np.int64), pos << 32 | n[doc], node[doc], sketch[g & np.uint64(len(sketch) - 1)] >= much]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["bucket", "place", "node", "much"])

    return run


def _large() -> int:
    """The sketch's level from which a bucket may hold more than PART n-grams."""
    return int(STEPS * np.log2(PART + 1))


def _dealt(postings: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``bucket, place, node``, the part (0: the bucket is whole) above the n-gram's bits.

    The sketch's buckets hold other n-grams too, so those that it says are large are counted;
    at most one in PART postings' n-grams is.
    """
    if not (sketch >= _large()).any():
        return postings.drop("much")
    postings = staged(postings, "prefixes")
    large = postings.filter("much").groupBy("bucket").agg(F.count("*").alias("c")).filter(F.col("c") > PART)
    large = staged(large.select("bucket", F.least(F.ceil(F.col("c") / PART), F.lit((1 << 64 - BITS - 1) - 2)).alias("parts")), "large")
    held = large.count()
    if not held:
        return postings.drop("much")
    dealt = postings.join(F.broadcast(large) if held <= BROADCAST_ROWS else large, "bucket", "left")
    part = F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("node"), "parts") + 1)
    return dealt.select(F.col("bucket").bitwiseOR(F.shiftleft(part, BITS)).alias("bucket"), "place", "node")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in order of (bucket, place) -> those of buckets with more than one, each with its bucket's first.

    Only the first of the bucket at hand is kept, so a bucket may be of any length.
    """
    names = ["bucket", "place", "node"]
    first, waits = None, False  # the bucket's first posting; whether nothing has followed it yet
    for batch in batches:
        cols = {c: batch.column(c).to_numpy() for c in names}
        if not batch.num_rows:
            continue
        if first is not None:
            cols = {c: np.concatenate([[first[c]], x]) for c, x in cols.items()}
        bucket = cols["bucket"]
        new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(bucket)))
        which = np.cumsum(new) - 1
        split = bucket.view(np.uint64) >> np.uint64(BITS) > 0
        keep = (size > 1)[which] | split
        if first is not None and not waits:
            keep[0] = False  # it was given before
            keep[1 : size[0]] = True
        last = int(starts[-1])
        first = {c: x[last] for c, x in cols.items()}
        waits = not keep[last] and not (last == 0 and len(bucket) > batch.num_rows and not waits)
        at = np.flatnonzero(keep)
        if len(at):
            head = starts[which[at]]
            cols = {c: x.view(np.uint64) for c, x in cols.items()}
            low = np.uint64((1 << 32) - 1)
            out = [cols["bucket"][at] & np.uint64((1 << BITS) - 1), cols["bucket"][at] >> np.uint64(BITS)]
            for i in (at, head):
                out += [cols["place"][i] >> np.uint64(32), cols["place"][i] & low, cols["node"][i]]
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in out], ["g", "part", "pos", "n", "node", "p_pos", "p_n", "p_node"])


_MET = "g long, part long, pos long, n long, node long, p_pos long, p_n long, p_node long"


def _filter(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of the nodes in rows (node): ten bits each, at least 2**16 and at most 2**28 (32 MB), put together by grouped ORs."""
    bits = 1 << min(28, max(16, (10 * wanted.count()).bit_length()))
    set_ = wanted.select(F.explode(F.array(*[F.xxhash64("node", F.lit(i)).bitwiseAND(bits - 1) for i in range(3)])).alias("b"))
    words = set_.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v"))
    out = np.zeros(bits // 64, np.uint64)
    found = words.toArrow()
    out[found.column("w").to_numpy()] = found.column("v").to_numpy().view(np.uint64)
    return out


def _parity(grams: np.ndarray) -> bytes:
    """The set's size, then the parities of its n-grams in as many parts of the hash space as it has n-grams, to a power of two."""
    bits = 1 << max(9, (len(grams) - 1).bit_length())
    odd = np.bincount((K.mix(grams) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.array([len(grams)], "<u8").tobytes() + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _near(percent: int):
    """Pairs whose parities, folded to the smaller number of parts, differ in no more than linked sets can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, sides in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in sides)
                n, x, y = int(x[0] + y[0]), x[1:], y[1:]
                while len(x) != len(y):
                    x, y = (x[: len(x) // 2] ^ x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2 :])
                keep[i] = int(np.bitwise_count(x ^ y).sum()) <= n - 2 * -(-percent * n // (100 + percent))
            if keep.any():
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _may_be_wanted(held: np.ndarray, parity: bool):
    """Rows (h0, h1, h2, node, packed) that pass a filter, as sets or as parities; the join that follows drops those that pass by chance."""
    mask = len(held) * 64 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = np.ones(batch.num_rows, bool)
            for c in ("h0", "h1", "h2"):
                b = batch.column(c).to_numpy() & mask
                may &= (held[b >> 6] >> (b & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            some = batch.select(["node", "packed"]).filter(pa.array(may))
            if parity:
                some = pa.RecordBatch.from_arrays([some.column("node"), pa.array([_parity(_unpacked(x.as_buffer())) for x in some.column("packed")], pa.binary())], ["node", "packed"])
            if some.num_rows:
                yield some

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                both = np.sort(np.concatenate([_unpacked(x.as_buffer()), _unpacked(y.as_buffer())]))
                keep[i] = int(np.count_nonzero(both[1:] == both[:-1])) * (100 + percent) >= percent * len(both)
            if keep.any():
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _need(nx: Column, ny: Column, percent: int) -> Column:
    """The least intersection of linked sets of these sizes."""
    return F.floor((percent * (nx + ny) + 99 + percent) / (100 + percent))


def _in_place(nx: Column, i: Column, ny: Column, j: Column, percent: int) -> Column:
    """Length and positional filter: nx <= ny, the n-gram they share stands at i and j."""
    return (
        (nx * 100 >= ny * percent)
        & (i <= nx - F.floor((2 * percent * nx + 99 + percent) / (100 + percent)))
        & (F.least(nx - i, ny - j) >= _need(nx, ny, percent))
    )


def _early(percent: int) -> Column:
    """That the n-gram stands early enough in its set (pos, n) for a partner that is no smaller."""
    return F.col("pos") <= F.col("n") - F.floor((2 * percent * F.col("n") + 99 + percent) / (100 + percent))


def _paired(held: DataFrame, percent: int, apart: Column) -> DataFrame:
    """Pairs ``x, y`` of a bucket's members ``m`` (rows g, c, pos, n, m) of which x, the smaller by (n, node), has the n-gram early.

    ``c`` is the number of the bucket's members. ``apart``: what must hold of ``s.m`` and ``l.m``
    besides. A band is four times as wide as linked sets differ in size, so few postings have
    partners in the next one as well.
    """
    wide = float(4 * np.log(max(100 / percent, 1.001)))
    band = lambda n: F.floor(F.log(n.cast("double")) / wide + 1e-9)
    # what follows the n-gram bounds the larger set's size, and so does the smaller set
    most = F.least(F.floor(F.col("n") * 100 / percent + 1e-6), F.floor((F.col("n") - F.col("pos")) * (100 + percent) / percent + 1e-6) - F.col("n"))
    rows = held.withColumn("parts", F.ceil(F.col("c") / MEET))
    small = rows.filter(_early(percent)).withColumn("band", F.explode(F.array_distinct(F.array(band(F.col("n")), band(F.greatest("n", most))))))
    small = small.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("g", "band", "part", "m")
    large = rows.select("g", band(F.col("n")).alias("band"), F.pmod(F.xxhash64("m.node"), "parts").alias("part"), "m")
    met = small.alias("s").join(large.alias("l"), ["g", "band", "part"]).filter(F.struct("s.m.n", "s.m.node") < F.struct("l.m.n", "l.m.node")).filter(apart)
    return met.select(F.col("s.m").alias("x"), F.col("l.m").alias("y"))


def _apart(x: str, y: str) -> Column:
    """Suffix filter: of 512 parts of the hash space, those whose sets differ in parity are no more than the sets' Hamming distance."""
    return sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _SIG), F.lit(0))


def ngram_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``id, key, n_shingles, component_id, keeper``.

    Texts are lower-cased (A-Z) and cut into runs of other than ASCII white space; a set
    is the distinct runs of ``words`` words, or the whole sequence where there are fewer.
    Rows link when ``100 * intersection >= percent * union``. ``component_id`` is the
    smallest id reachable; ``keeper`` says that the row is the component's one row by
    smallest (id, key). Null or wordless texts have an empty set, link with nothing and
    keep. Repeated rows are one class. A null id takes part, but never names a component
    that has another id. Other columns are ignored; an empty table gives no rows. Links
    within a component are not all verified here: see :func:`ngram_links`.
    """
    return _join(docs, id_col, text_col, words, percent, False)


def ngram_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links: rows ``id, key, n_shingles, class_id, n_links`` and pairs ``a, b`` of linked classes.

    A class is the rows of one n-gram set, null in ``class_id`` where that is empty; rows of
    a class link with each other. Each pair of classes comes once, and stands for as many
    links as its classes' rows multiplied. ``n_links`` counts the other rows that a row links
    with directly. Sets and links are those of :func:`ngram_components`.
    """
    return _join(docs, id_col, text_col, words, percent, True)


def _join(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, links_only: bool) -> DataFrame | tuple[DataFrame, DataFrame]:
    base = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    described = base.mapInArrow(K.released(_describe(words)), f"id {kind}, key long, n long, h1 long, h2 long, packed binary, " + ", ".join(f"{s} long" for s in _SIG))
    described = staged(described.withColumn("row", F.monotonically_increasing_id()), "shingles")
    full = described.filter("n > 0")
    alike = ["h1", "h2", "n"]
    firsts = full.groupBy(alike).agg(F.min("row").alias("first_row"), F.count("*").alias("c")).filter("c > 1").drop("c")
    copies = staged(full.select(*alike, "row").join(firsts, alike).filter("row <> first_row").select("row", "first_row"), "copies", rows=full.count())
    known = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS // 2 else copies
    classes = full.join(known, "row", "left_anti").withColumnRenamed("row", "node").drop("h1", "h2")
    filled = full.select("id", "key", "n", "row").join(known, "row", "left").select("id", "key", "n", F.coalesce("first_row", "row").alias("node"))

    sketch = frequency_sketch(classes.select("n", "packed"))
    postings = classes.select("n", "node", "packed").mapInArrow(K.released(_prefixes(percent, sketch)), "bucket long, place long, node long, much boolean")
    postings = staged(_dealt(postings, sketch).repartition("bucket").sortWithinPartitions("bucket", "place", "node").mapInArrow(K.released(_met), _MET), "postings")
    crowd = postings.count()

    def verified(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b, n), staged, those that link."""
        n = pairs.count()
        wide = staged(joined(pairs.filter(F.col("n") > WIDE), n, _near(percent), True), "wide", rows=n, per_file=PAIRS)
        pairs = staged(pairs.filter(F.col("n") <= WIDE).select("a", "b").unionByName(wide), "pairs", rows=n)
        n = pairs.count()
        return staged(joined(pairs, n, _verify(percent), False), "links", rows=n, per_file=PAIRS)

    def joined(pairs: DataFrame, n: int, judge: Callable, parity: bool) -> DataFrame:
        """The pairs that ``judge`` keeps, of ``n`` at most, given both sides' sets or parities."""
        wanted = staged(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "wanted", rows=2 * n)
        hashed = classes.select("node", "packed", *[F.xxhash64("node", F.lit(i)).alias(f"h{i}") for i in range(3)])
        sets = hashed.mapInArrow(K.released(_may_be_wanted(_filter(wanted), parity)), "node long, packed binary").join(wanted, "node", "left_semi")
        met = pairs.join(sets.select(F.col("node").alias("a"), F.col("packed").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("packed").alias("y")), "b")
        return met.select("a", "b", "x", "y").mapInArrow(K.released(judge), "a long, b long")

    member = F.struct("pos", "node", "n")
    pivot = F.struct(F.col("p_pos").alias("pos"), F.col("p_node").alias("node"), F.col("p_n").alias("n"))

    near = lambda: _apart("u", "v") <= F.col("u.n") + F.col("v.n") - 2 * _need(F.col("u.n"), F.col("v.n"), percent)

    def candidates(met: DataFrame, signed: bool) -> DataFrame:
        """Rows (x, y) of two postings of a bucket -> distinct pairs (a, b, n), a < b, n the smaller size, that pass the filters; the suffix filter where they have signatures."""
        small = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
        met = met.select(F.when(small, F.col("x")).otherwise(F.col("y")).alias("u"), F.when(small, F.col("y")).otherwise(F.col("x")).alias("v"))
        fit = _in_place(F.col("u.n"), F.col("u.pos"), F.col("v.n"), F.col("v.pos"), percent)
        if signed:
            fit = fit & near()
        return met.filter(fit).select(F.least("u.node", "v.node").alias("a"), F.greatest("u.node", "v.node").alias("b"), F.col("u.n").alias("n")).distinct()

    def close(pairs: DataFrame) -> DataFrame:
        """Distinct pairs that pass the suffix filter, by a join with the signatures."""
        about = lambda node, name: classes.select(F.col("node").alias(node), F.struct(F.col("n"), *_SIG).alias(name))
        return pairs.join(about("a", "u"), "a").join(about("b", "v"), "b").filter(near()).select("a", "b", "n")

    def signed(rows: DataFrame) -> DataFrame:
        """Postings of buckets still of use, with their class's signature in the member struct ``m``."""
        return rows.join(classes.select("node", *_SIG), "node").withColumn("m", F.struct("pos", "node", "n", *_SIG))

    if links_only:
        counts = staged(postings.groupBy("g").agg(F.count("*").alias("c"), F.max(_early(percent)).alias("early")).filter("early and c > 1").select("g", "c"), "buckets")
        held = staged(signed(postings.join(counts, "g")).select("g", "c", "pos", "n", "m"), "postings")
        pairs = verified(staged(candidates(_paired(held, percent, F.lit(True)), True), "pairs"))
        sizes = filled.groupBy("node").agg(F.count("*").alias("c"))
        ends = pairs.union(pairs.select("b", "a")).toDF("node", "other")
        degrees = ends.join(sizes.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.sum("c").alias("links"))
        counted = sizes.join(degrees, "node", "left").select("node", (F.col("c") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        rows = filled.join(counted, "node").select("id", "key", F.col("n").alias("n_shingles"), F.col("node").alias("class_id"), "n_links")
        return rows.unionByName(described.filter("n = 0").select("id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))), pairs

    # members with their pivots, and the pivots of a large bucket's parts with the first of them
    heads = postings.filter("part > 0 and node = p_node").select("g", member.alias("x"))
    heads = heads.join(heads.groupBy("g").agg(F.min("x").alias("y")), "g").filter("x.node <> y.node").select("x", "y")
    met = postings.filter("node <> p_node").select(member.alias("x"), pivot.alias("y")).unionByName(heads)
    tried = staged(close(candidates(met, False)), "pairs", rows=crowd)
    links = verified(tried)

    # what is left: pairs of different components within a bucket, but for those with its pivot
    found = components(links, links.count()).withColumnRenamed("component", "comp")
    rows = staged(postings.filter("part > 0 or node <> p_node").select("g", "pos", "node", "n").join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "labelled", rows=crowd)
    drop_staged(postings)
    mixed = rows.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"), F.max(_early(percent)).alias("early")).filter("lo <> hi and early").select("g", "c")
    held = staged(signed(rows.join(mixed, "g")).withColumn("m", F.struct("m.*", "comp")).select("g", "c", "pos", "n", "m"), "postings", rows=crowd)
    met = _paired(held, percent, F.col("s.m.comp") != F.col("l.m.comp"))
    new = verified(staged(candidates(met, True).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "pairs"))

    found = components(links.union(new), links.count() + new.count())
    names = filled.groupBy("node").agg(F.min("id").alias("min_id"))
    named = names.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component", "component_id")
    rows = filled.select("id", "key", "n", "node").join(named, "node")
    chosen = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).getField("key").alias("kept_key"))
    rows = rows.join(chosen, "component").select("id", "key", F.col("n").alias("n_shingles"), "component_id", (F.col("key") == F.col("kept_key")).alias("keeper"))
    return rows.unionByName(described.filter("n = 0").select("id", "key", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("keeper")))


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The input's rows, one of each component of :func:`ngram_components`, columns as they were.

    Rows without words are kept as they are; of repeated rows in a component one stays. Columns may have any names.
    """
    kept = ngram_components(docs, id_col=id_col, text_col=text_col, words=words, percent=percent).filter("keeper and n_shingles > 0").select("key").distinct()
    has = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"), has.alias("has"))
    one = rows.filter("has").join(kept, "key", "left_semi").dropDuplicates(["key"])
    return one.select("row.*").union(rows.filter("not has").select("row.*"))
