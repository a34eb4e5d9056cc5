"""URL filters in SQL functions: host suffixes and path prefixes, short hash prefixes, full digests, longest rule.

A rule is a host and the beginning of a path. Each URL is expanded into its host's suffixes at
label ends times its path's prefixes at slashes (and at the lengths of rules that don't end in
one), no deeper than any rule goes. Expressions meet rules on the first 32 bits of their SHA-256
and count if the whole digests agree. Of a rule a long is carried along, its precedence, from
which rule and verdict are read back off the URL itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to which they are broadcast (some 100 bytes each); counted first. Beyond it they are dealt out, SALTS times.
BROADCAST_RULES, SALTS = 100_000, 32
#: Hex digits of a digest that expressions and rules are joined on.
SHORT = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """``host, path``: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end. Both empty for a null or without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _compiled(rules: DataFrame) -> DataFrame:
    """``host, path, digest, code``, a row per (host, path); the code orders rules: the longest, of those the one of the longest host, and has block in its last bit."""
    host, path = F.translate("host", _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    known = rules.filter((F.col("host") != "") & F.col("verdict").isin("block", "allow")).select(host.alias("host"), path.alias("path"), (F.col("verdict") == "block").cast("long").alias("block"))
    code = F.shiftleft((F.length("host") + F.length("path")).cast("long"), 32) + F.shiftleft(F.length("host").cast("long"), 1) + F.max("block")
    return known.groupBy("host", "path").agg(code.alias("code")).withColumn("digest", F.sha2(F.concat("host", "path"), 256))


def _expressions(labels: int, slashes: int, lengths: list[int]) -> Column:
    """Every host suffix of at most so many labels before every path prefix: up to a slash, of which there are at most so many, or of a given length."""
    parts, pieces = F.split("host", "\\."), F.split("path", "/", slashes + 2)
    n = F.size(parts)
    hosts = F.transform(F.sequence(F.greatest(n - labels, F.lit(0)) + 1, n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    paths = F.transform(F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(slashes))), lambda j: F.when(j == 0, "").otherwise(F.concat(F.array_join(F.slice(pieces, 1, j), "/"), F.lit("/"))))
    if lengths:
        given = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length("path"))
        paths = F.concat(paths, F.transform(given, lambda x: F.substring(F.col("path"), F.lit(1), x)))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def url_verdicts(urls: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: ``id, host, path, rule, verdict``.

    ``rules``: ``host, path, verdict`` (``block`` or ``allow``). A rule fits its host and all
    subdomains where the URL's path starts with the rule's; the longest host and path wins, of
    equally long ones that of the longer host, of two verdicts for the same rule ``block``.
    Where none fits, ``rule`` is null and the verdict ``default``. Rules of a null or empty host
    or of another verdict fit nothing; a null path is empty. A null URL or one without ``://``
    has an empty host and path, and no rule. Repeated rows and null ids are rows like others;
    extra columns are ignored; without rows there are none.
    """
    compiled = _compiled(rules)
    deep = compiled.agg(
        F.count("*").alias("n"), F.max(F.size(F.split("host", "\\."))).alias("labels"), F.max(F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).alias("slashes"),
        F.sort_array(F.collect_set(F.when((F.col("path") != "") & ~F.col("path").endswith("/"), F.length("path")))).alias("lengths"),
    ).first()
    host, path = url_parts(F.col(url_col))
    rows = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    # beside its expressions each row has one that meets no rule, by which rows are counted
    met = rows.withColumn("e", F.explode(F.concat(F.array(F.lit(None).cast("string")), _expressions(deep.labels or 1, deep.slashes or 0, deep.lengths))))
    own = F.xxhash64("id", "host", "path")
    met = met.withColumn("digest", F.sha2("e", 256)).withColumn("short", F.coalesce(F.substring("digest", 1, SHORT), F.concat(F.lit("-"), own.cast("string"))))
    known = compiled.select(F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("whole"), "code")
    if deep.n <= BROADCAST_RULES:
        met = met.join(F.broadcast(known), "short", "left")
    else:
        known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = met.withColumn("salt", F.pmod(own, F.lit(SALTS)).cast("int")).join(known, ["short", "salt"], "left")
    best = met.groupBy("id", "host", "path").agg(F.sum(F.col("e").isNull().cast("int")).alias("n"), F.max(F.when(F.col("digest") == F.col("whole"), F.col("code"))).alias("code"))
    best = best.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    length, of_host = F.shiftright("code", 32).cast("int"), F.shiftright(F.col("code").bitwiseAND((1 << 32) - 1), 1).cast("int")
    rule = F.when(F.col("code").isNotNull(), F.concat(F.right("host", of_host), F.left("path", length - of_host)))
    verdict = F.when(F.col("code").isNull(), default).when(F.col("code").bitwiseAND(1) == 1, "block").otherwise("allow")
    return best.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def drop_blocked(rows: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows, with all their columns, whose URL isn't blocked; each distinct URL is judged once."""
    judged = url_verdicts(rows.select(F.col(url_col).alias("id"), F.col(url_col)).distinct(), rules, id_col="id", url_col=url_col, default=default)
    blocked = judged.filter("verdict = 'block'").select(F.col("id").alias("__blocked"))
    return rows.join(blocked, F.col(url_col).eqNullSafe(F.col("__blocked")), "left_anti")
