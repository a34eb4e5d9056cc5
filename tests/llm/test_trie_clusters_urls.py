"""Centroid clustering, prefix trie and URL filters against brute force on awkward rows, and with many ranges, wide numbers and many rules."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import annulus, prefix_trie, url_filter

TURNS = "conv_id long, turn long, role string, text string, key string, id string, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talks(kind: str) -> list[tuple]:
    rng = random.Random(kind)
    text = lambda: rng.choice(["", "a", "bb", "é" * 3, "long " * 30])
    rows = []
    if kind == "awkward":
        for c in [*range(0, 230), 300, 301, 399, 405, -7, -100]:
            rows += [(c, t, rng.choice(["user", "assistant", None]), text()) for t in range(rng.randint(1, 7))]
        rows += [(500, None, "system", "first"), (500, 3, "user", None), (500, 1, "user", "x"), (None, 1, "user", "lost")]
        rows += [(500, 1, "user", "x")]
    elif kind == "copies":  # one conversation many times, and the same with tails
        for c in range(1000, 1180):
            rows += [(c, t, "user", f"turn {t}") for t in range(4)] + [(c, 9, "user", text())] * (c % 3 == 0)
    elif kind == "chains":  # each is the beginning of the next
        for c in range(40):
            rows += [(c, t, "user", "abc") for t in range(c % 20)]
    elif kind == "one":
        rows = [(5, 0, "user", "alone")]
    elif kind == "turnless":
        rows = [(101, 0, "user", "x"), (102, 0, "user", "y")]
    return rows


def brute(rows: list[tuple], head: int) -> Counter:
    convs: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    convs = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % head if head else 0
        made[c] = tuple(convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    nodes: dict[tuple, list[int]] = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(members) - 1) * (len(k[-1][1]) if k else 0)
    return Counter(
        (min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(k)).encode()).hexdigest())
        for k, m in nodes.items()
    )


@pytest.mark.parametrize(("kind", "ranges", "heads"), [("awkward", 1, (6,)), ("awkward", 7, (6,)), ("awkward", 40, (0,)), ("copies", 7, (6,)), ("chains", 7, (0, 6)), ("one", 1, (0,)), ("turnless", 3, (6,))])
def test_trie_in_ranges(spark, monkeypatch, kind, ranges, heads):
    monkeypatch.setattr(prefix_trie, "ranges_for", lambda *a: ranges)
    monkeypatch.setattr(prefix_trie, "PACKED", 5)
    rows = talks(kind)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS).repartition(3)
    for head in heads:
        found = Counter(map(tuple, prefix_trie.prefix_trie(df, head=head).select(COLUMNS).collect()))
        assert found == brute(rows, head)


def test_trie_joins_a_large_spine(spark, monkeypatch):
    """Nodes below the spine find their parents without a broadcast as well."""
    monkeypatch.setattr(prefix_trie, "ranges_for", lambda *a: 9)
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", 0)
    rows = talks("awkward")
    found = Counter(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS), head=6).select(COLUMNS).collect()))
    assert found == brute(rows, 6)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS), head=6).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", "", "")], TURNS)).collect() == []


def lloyd(rows: list[tuple], k: int, rounds: int, dims: int, scale: int = 1024) -> Counter:
    from fractions import Fraction

    kept = [(i, [int(Fraction(x) * scale // 1) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and abs(x) < 2.0**128 for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            if own := [v for (_, v), o in zip(kept, of, strict=True) if o == j]:
                cents[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    fit = lambda v: v if v is not None and v < 2**63 else None
    total = lambda ds: fit(sum(ds)) if all(d < 2**63 for d in ds) else None
    return Counter((i, j, fit(d), total([e for _, e, o in found if o == j]), total([e for _, e, _ in found]), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, d, j in found)


def vectors(kind: str, dims: int) -> list[tuple]:
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, dims))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    elif kind == "norms":  # vectors and centroids of very different norms
        x *= rng.choice([0.001, 0.1, 1, 50], size=(240, 1))
    elif kind == "grid":  # many ties
        x = np.round(x) / 1024
    elif kind == "wide":
        x *= rng.choice([1.0, 1e6, 1e20, 1e38], size=(240, 1)) / 4
    elif kind == "equal":
        x[:] = x[0]
    x = x.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(300, None), (301, []), (302, [1.0] * (dims - 1)), (303, [1.0] * (dims + 1)), (304, [None] + [1.0] * (dims - 1)), (305, [float("nan")] * dims), (306, [float("inf")] + [0.0] * (dims - 1)), (None, [0.5] * dims), (7, [0.25] * dims), rows[3], rows[3]]
    return rows + [(i, v and [x if x is None else float(x) for x in v]) for i, v in odd]


@pytest.mark.parametrize("kind", ["unit", "norms", "grid", "wide", "equal"])
def test_clusters(spark, kind):
    rows = vectors(kind, 6)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, v string").repartition(3)
    found = Counter(map(tuple, annulus.cluster_vectors(df, 8, rounds=4, dims=6).collect()))
    assert found == lloyd(rows, 8, 4, 6)


def test_clusters_of_few_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    assert annulus.cluster_vectors(spark.createDataFrame([], kind), 8, dims=6).collect() == []
    rows = vectors("unit", 6)[:3]
    assert Counter(map(tuple, annulus.cluster_vectors(spark.createDataFrame(rows, kind), 8, dims=6).collect())) == lloyd(rows, 8, 10, 6)


def test_annulus_passes_over_far_norms():
    """What lies outside the annulus is never compared, what lies on its boundary is."""
    cents = [[3, 0], [-3, 0], [0, 3], [100, 0], [0, 0]]
    x = np.array([[3, 0], [0, -3], [1, 1], [99, 1], [-3, -3], [50, 0]], np.float64)
    number, d = annulus.nearest(x, cents)
    plain = [min((int(((v - np.array(c)) ** 2).sum()), j) for j, c in enumerate(cents)) for v in x]
    assert list(zip(d.astype(int).tolist(), number.tolist(), strict=True)) == plain


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
ODD_RULES = [("a.b.c", "/x", "block"), ("b.c", "/x/y", "allow"), ("c", "", "block"), ("C", "/x/y/z/", "allow"), ("same", "/", "allow"), ("same", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("odd", "/", "maybe"), ("null", None, "block"), ("t.c", "/aaa", "allow"), ("c", "/aaab", "block")]
URLS = [
    "http://a.example.net/en/1?x", "https://example.net/fr/", "http://EXAMPLE.net/EN/", "http://example.net", "http://net/", "http://net?/", "http://xexample.net/en/", "https://m.example.com/de/5#top", "https://m.example.com/de",
    "ftp://a.org/fr/x://b.net/", "no scheme net/", "://net/a", "", None, "http://", "http:///en/", "http://a.b.c/x", "http://a.b.c/xx/y", "http://q.a.b.c/x/y/z/w", "http://b.c/x/y", "http://b.c/x/yy?z", "http://c", "http://c.", "http://.c/x/y/z/",
    "http://same/", "http://null/q", "http://odd/", "http://t.c/aaab", "http://t.c/aaa", "http://a..net/", "http://user@host.net:80/", "http://ÉX.c/ü", "http://" + "l." * 3000 + "c/" + "s/" * 3000, "http://x\ny.net/a\nb",
]


def judged(url: str | None, rules: list[tuple], default: str = "allow") -> tuple:
    rest = (url or "").partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut : min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = []
    for h, p, v in rules:
        h, p = (h or "").lower(), p or ""
        if h and v in ("block", "allow") and (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h + p), len(h), v == "block", h + p, v))
    return (host, path, *(max(fit)[3:] if fit else (None, default)))


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("rules", [RULES, ODD_RULES, RULES + ODD_RULES, []])
def test_url_verdicts(spark, monkeypatch, rules, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", -1)
    urls = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[0], "", ""), (3, URLS[3], "", ""), (3, URLS[3], "", "")]
    df = spark.createDataFrame(urls, "page_id long, url string, host string, rule string").repartition(3)
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    for default in ("allow", "block"):
        found = Counter(map(tuple, url_filter.url_verdicts(df, known, default=default).collect()))
        assert found == Counter((i, *judged(u, rules, default)) for i, u, *_ in urls)
        left = Counter(r.page_id for r in url_filter.drop_blocked(df, known, default=default).collect())
        assert left == Counter(i for i, u, *_ in urls if judged(u, rules, default)[3] == "allow")
    assert url_filter.url_verdicts(df.limit(0), known).collect() == []


def test_url_digests_decide(spark, monkeypatch):
    """With a single hex digit to join on, most rules meet most expressions; whole digests alone count."""
    monkeypatch.setattr(url_filter, "SHORT", 1)
    rules = RULES + ODD_RULES
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    found = Counter(map(tuple, url_filter.url_verdicts(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()))
    assert found == Counter((i, *judged(u, rules)) for i, u in enumerate(URLS))


def test_url_filters_stay_in_the_jvm(spark):
    df = spark.range(3).select(F.col("id").alias("page_id"), F.lit("http://a.net/").alias("url"))
    plan = url_filter.url_verdicts(df, spark.sql("SELECT 'net' AS host, '/' AS path, 'block' AS verdict"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
