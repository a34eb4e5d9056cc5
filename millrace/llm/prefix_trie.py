"""Patricia trie over conversations: sorted keys, points at branches and ends only, unary nodes expanded from edges.

Keys. A turn is a token of 20 bytes, 16 of its role's and text's SHA-256 and 4 of its text's
length; a conversation's key is its tokens in a row. Conversations of equal keys are one row
from then on, with their number, smallest id and the digest of their ids.

Shards. Distinct keys are sorted by ranges, and each range's trie is built by one task: common
prefixes of neighbours give the branches, a stack gives number, smallest id, leaves and saved
tokens of each point, and an edge's unary nodes follow from its point by suffix sums.

Spine. Nodes on the path that the last key of a range shares with the next range's first have
members in several ranges: those tasks give partial results, which are merged by node. They are
at most a key's length per range, and the root. What the spine's own nodes save is summed
without walking the tree: every spine node counts at the first border it lies on, and a node's
subtree is the suffix sums below it on the borders that pass through it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import kernel as K
from millrace.llm.common import drop_staged, ranges_for, staged

#: Bytes of a token, and those of them before the text's length.
TOKEN, DIGEST = 20, 16
#: Ids of equal keys in a packed row; spine nodes up to which they are broadcast (some 50 bytes each), counted first.
PACKED, BROADCAST_NODES = 65_536, 100_000
NOTHING = hashlib.sha256().hexdigest()


def conversation_keys(conversations: DataFrame, *, head: int = 0, every: int = 100, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id, key`` of each conversation that has an id, staged.

    Turns are in order of their number, null first, equal numbers by the hash of role and text;
    a null role or text is empty. With ``head``, a conversation c is rebuilt: the first
    crc32(c) modulo ``head`` turns come from conversation c - c % every (as many as it has),
    the others are its own after as many.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    token = F.concat(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * DIGEST), F.lpad(F.hex(F.length("text")), 2 * (TOKEN - DIGEST), "0"))
    held = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", token.alias("token")))).alias("t")).select("id", F.col("t.token").alias("t"))
    if head:
        held = staged(held, "turns")
        first = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(head)).cast("int")
        donors = held.filter(F.col("id") % every == 0).select(F.col("id").alias("donor"), F.slice("t", 1, head - 1).alias("head"))
        own = held.withColumns({"donor": F.col("id") - F.col("id") % every, "h": first}).join(donors, "donor", "left")
        taken = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
        rebuilt = F.concat(taken, F.slice("t", F.col("h") + 1, F.size("t")))
        held = own.select("id", rebuilt.alias("t"))
    return staged(held.select("id", F.unhex(F.array_join("t", "")).alias("key")), "keys")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (of, id) -> rows ``of, first, ids`` of a run's ids, as compressed differences."""
    of, ids = None, []

    def row() -> tuple:
        return of, ids[0], zlib.compress(np.diff(np.array(ids, np.int64), prepend=0).astype("<i8").tobytes(), 1)

    types = (pa.binary(), pa.int64(), pa.binary())
    for batch in batches:
        out = []
        for o, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (o != of or len(ids) >= PACKED):
                out.append(row())
                ids = []
            of = o
            ids.append(i)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["of", "first", "ids"])
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), types, strict=True)], ["of", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows sorted by (of, first) -> ``of, ends`` with the SHA-256 of all ids, joined by commas; a row in memory at a time."""
    of, sha = None, None
    for batch in batches:
        done = []
        for o, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            ids = ",".join(map(str, np.cumsum(np.frombuffer(zlib.decompress(packed), "<i8")).tolist())).encode()
            if sha is not None and o == of:
                sha.update(b"," + ids)
                continue
            if sha is not None:
                done.append((of, sha.hexdigest()))
            of, sha = o, hashlib.sha256(ids)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)], ["of", "ends"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([of], pa.binary()), pa.array([sha.hexdigest()])], ["of", "ends"])


def _common(tokens: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many tokens each key but the first shares with the one before it; a step a depth, over the pairs still alike."""
    shared = np.zeros(max(len(at) - 1, 0), np.int64)
    most, alive, depth = np.minimum(lengths[1:], lengths[:-1]), np.arange(len(shared)), 0
    while len(alive := alive[most[alive] > depth]):
        alive = alive[(tokens[at[alive] + depth] == tokens[at[alive + 1] + depth]).all(axis=1)]
        depth += 1
        shared[alive] = depth
    return shared


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, last, next, follows`` -> ``part, follows, shared`` tokens of a range's last key and the next one's first."""
    for batch in batches:
        shared = []
        for last, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            n = min(len(last), len(first)) // TOKEN
            a, b = (np.frombuffer(k[: n * TOKEN], np.uint8).reshape(n, TOKEN) for k in (last, first))
            differ = np.flatnonzero((a != b).any(axis=1))
            shared.append(int(differ[0]) if len(differ) else n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(shared, pa.int64())], ["part", "follows", "shared"])


_NODE = pa.schema([
    ("part", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("spine", pa.bool_()), ("border", pa.bool_()), ("chars", pa.int64()),
])
_NODE_SQL = "part int, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, spine boolean, border boolean, chars long"


def _points(shared: list[int], depths: list[int], n: list[int], ids: list[int], sums: np.ndarray, at: list[int], left: int, right: int) -> list[list]:
    """The points of sorted keys, children before parents: ``depth, row, last, n, id, leaves, below, kids, end, parent, spine``.

    ``row`` and ``last`` are the first and last key below a point; ``below`` what its subtree
    saves without its own edge; ``kids`` and saved sums pass over spine nodes, those down to
    depth ``spine`` on the point's path. ``fan`` counts all children.
    """
    DEPTH, ROW, LAST, N, ID, LEAVES, BELOW, KIDS, END, PARENT, SPINE = range(11)
    done: list[list] = []
    last = len(depths) - 1
    stack: list[list] = [[0, 0, 0, 0, None, 0, 0, 0, -1, -1, 0]]
    fans = [0]

    def close(upto: int) -> None:
        p, fan = stack.pop(), fans.pop()
        if fan == 0 and not (upto == last and p[DEPTH] <= right):
            p[LEAVES] = 1
        p[LAST] = upto
        p[SPINE] = max(left if p[ROW] == 0 else -1, right if upto == last else -1, 0 if p[DEPTH] == 0 else -1)
        if stack:
            q = stack[-1]
            a, p[PARENT] = at[p[ROW]], q  # the parent's place follows when it is known
            from_depth = min(p[DEPTH], max(q[DEPTH], p[SPINE]))
            q[N] += p[N]
            q[ID] = p[ID] if q[ID] is None else min(q[ID], p[ID])
            q[LEAVES] += p[LEAVES]
            q[BELOW] += p[BELOW] + (p[N] - 1) * int(sums[a + p[DEPTH]] - sums[a + from_depth])
            q[KIDS] += q[DEPTH] + 1 > p[SPINE]
            fans[-1] += 1
        done.append(p)

    for i, depth in enumerate(depths):
        if i:
            level = shared[i - 1]
            while stack[-1][DEPTH] > level:
                if stack[-2][DEPTH] < level:
                    stack.insert(-1, [level, stack[-1][ROW], 0, 0, None, 0, 0, 0, -1, -1, 0])
                    fans.insert(-1, 0)
                close(i - 1)
        if depth > stack[-1][DEPTH]:
            stack.append([depth, i, 0, 0, None, 0, 0, 0, -1, -1, 0])
            fans.append(0)
        p = stack[-1]
        p[N] += n[i]
        p[ID] = ids[i] if p[ID] is None else min(p[ID], ids[i])
        p[END] = i
    while stack:
        close(last)
    place = {id(p): k for k, p in enumerate(done)}
    for p in done:
        p[PARENT] = place[id(p[PARENT])] if p[PARENT] != -1 else -1
    return done


def _trie(table: pa.Table) -> pa.Table:
    """The nodes of one range of keys."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("key", "n", "id", "ends")), strict=True))
    part, left, right = (table.column(c)[0].as_py() for c in ("part", "left", "right"))
    keys, n, ids, ends = zip(*rows, strict=True)
    tokens = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, TOKEN)
    lengths = np.array([len(k) // TOKEN for k in keys], np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    chars = tokens[:, DIGEST:].copy().view(">u4").ravel().astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(chars)])
    points = _points(_common(tokens, at, lengths).tolist(), lengths.tolist(), list(n), list(ids), sums, at.tolist(), left, right)
    depth, row, last, count, least, leaves, below, kids, end, parent, spine = (np.array(c, np.int64) for c in zip(*points, strict=True))
    root = parent < 0
    above = np.where(root, -1, depth[parent])
    q = np.repeat(np.arange(len(points)), depth - above)  # a node for each depth of each edge
    d = above[q] + 1 + np.arange(len(q)) - np.repeat(np.cumsum(depth - above) - (depth - above), depth - above)
    a, whole = at[row[q]], depth[q]
    on_spine, is_point = d <= spine[q], d == whole
    saved = below[q] + (count[q] - 1) * (sums[a + whole] - sums[a + np.minimum(whole, np.maximum(d - 1, spine[q]).clip(0))])
    top = (d == above[q] + 1) & ~root[q]
    of_spine = np.where(top, depth[parent[q]] <= spine[parent[q]], d - 1 <= spine[q]) & (d > 0)
    up = np.where(top, least[parent[q]], least[q])
    close = (last[q] == len(keys) - 1) & (d <= right)
    name = lambda i, k: hashlib.blake2b(keys[row[q[i]]][: k * TOKEN], digest_size=DIGEST).digest()
    nodes, parents = [None] * len(q), [None] * len(q)
    for i in np.flatnonzero(on_spine).tolist():
        nodes[i] = name(i, d[i])
    for i in np.flatnonzero(of_spine).tolist():
        parents[i] = name(i, d[i] - 1)
    own = np.where(d > 0, chars[np.minimum(a + np.maximum(d, 1) - 1, len(chars) - 1)], 0) if len(chars) else np.zeros(len(q), np.int64)
    columns = [
        pa.array(np.full(len(q), part, np.int32)), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), pa.array(d), pa.array(least[q]),
        pa.array(up, mask=of_spine | (d == 0)), pa.array(count[q]), pa.array(np.where(is_point, kids[q], (d + 1 > spine[q]).astype(np.int64))), pa.array(leaves[q]), pa.array(saved),
        pa.array([ends[e] if p and e >= 0 else None for p, e in zip(is_point.tolist(), end[q].tolist(), strict=True)], pa.string()), pa.array(on_spine), pa.array(close), pa.array(own),
    ]
    return pa.Table.from_arrays(columns, schema=_NODE)


def _merged(nodes: DataFrame) -> DataFrame:
    """The spine's nodes, whole: ``node, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends``."""
    spine = nodes.filter("spine")
    first = F.min(F.when(F.col("border"), F.col("part")))
    sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    one = spine.groupBy("node").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums.values(), F.max("ends").alias("ends"), F.max("chars").alias("chars"), first.alias("first"))
    one = staged(one, "spine", rows=None)
    own = one.select("node", "first", ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    paths = spine.filter("border").select("part", "node", "depth").join(own, "node").withColumn("own", F.when(F.col("part") == F.col("first"), F.col("own")).otherwise(0))
    below = Window.partitionBy("part").orderBy(F.desc("depth"))  # a border's path: a key's length at most
    under = paths.withColumn("s", F.sum("own").over(below)).groupBy("node").agg(F.sum("s").alias("s"))
    kids = one.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("k"))
    ups = one.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = one.join(under, "node", "left").join(kids, "node", "left").join(ups, "parent", "left")
    return found.select("node", "depth", "conv_id", "parent_conv_id", "n_convs", (F.col("n_children") + F.coalesce("k", F.lit(0))).alias("n_children"), "n_leaves", (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), "ends")


def trie_nodes(keys: DataFrame) -> DataFrame:
    """Every node of the trie of ``conversation_keys``: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns, from the textless root. ``conv_id`` is its
    smallest member; the root's parent is null. ``saved_tokens`` sums over its subtree, itself
    included, the characters of each node's last text times its members but one. A conversation
    without turns is a member of the root; without conversations there is no node. One
    conversation's key is one row: 20 bytes a turn, 2 GB at most.
    """
    rows = keys.select("id", "key", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * DIGEST)).alias("of"))
    size = keys.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    pairs = rows.select("of", "id").repartitionByRange(ranges_for(size), "of", "id").sortWithinPartitions("of", "id")
    packed = pairs.mapInArrow(K.released(_packed), "of binary, first long, ids binary").repartition(ranges_for(size), "of").sortWithinPartitions("of", "first")
    ends = packed.mapInArrow(K.released(_digests), "of binary, ends string")
    alike = staged(rows.groupBy("key", "of").agg(F.count("*").alias("n"), F.min("id").alias("id")).join(ends, "of").drop("of"), "alike")
    size = alike.agg(F.sum(F.length("key") + 100)).first()[0] or 0
    parted = staged(alike.repartitionByRange(ranges_for(size), "key").withColumn("part", F.spark_partition_id()), "parted")
    # a row per range
    bounds = staged(parted.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")), "bounds", rows=1)
    after = Window.orderBy("part")
    borders = bounds.withColumns({"next": F.lead("first").over(after), "follows": F.lead("part").over(after)}).filter("next is not null").select("part", "last", "next", "follows")
    borders = staged(borders.mapInArrow(_borders, "part int, follows int, shared long"), "borders", rows=1)
    places = parted.select("part").distinct().join(borders.select("part", F.col("shared").alias("right")), "part", "left").join(borders.select(F.col("follows").alias("part"), F.col("shared").alias("left")), "part", "left").na.fill(-1, ["left", "right"])
    nodes = staged(parted.join(F.broadcast(places), "part").groupBy("part").applyInArrow(_trie, _NODE_SQL), "nodes")
    spine = staged(_merged(nodes), "merged")
    drop_staged(alike, parted, bounds, borders)
    local = nodes.filter("not spine")
    ups = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("up"))
    ups = F.broadcast(ups) if ups.count() <= BROADCAST_NODES else ups
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    deep, high = local.filter("parent is null").select(columns), local.filter("parent is not null").drop("parent_conv_id").join(ups.withColumnRenamed("up", "parent_conv_id"), "parent").select(columns)
    return deep.unionByName(high).unionByName(spine.select(columns)).withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING))).drop("ends")


def prefix_trie(conversations: DataFrame, *, head: int = 0, every: int = 100, **columns: str) -> DataFrame:
    """``trie_nodes`` of the conversations, rebuilt first where ``head`` says so."""
    return trie_nodes(conversation_keys(conversations, head=head, every=every, **columns))
