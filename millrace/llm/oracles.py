"""DuckDB SQL for the training-data queries that SQL can express."""

#: What the quality rules measure, written out apart from the operator: measure -> (SQL over the base counts, least distance from the median, whether low values fail too, whether zeros are left out of its quantiles).
MEASURES = {
    "symbols": ("1e3 * n_symbols / n_words", 100, False, False),
    "dup_lines": ("1e3 * n_dup_lines / greatest(n_lines, 1)", 250, False, True),
    "repeats": ("1e3 * n_repeat_words / n_words", 100, False, True),
    "word_length": ("1e2 * word_chars / n_words", 100, True, False),
}
#: Growth of the sketch's bins, the bin of zero, the rows by which a language counts beside a group, spreads between median and threshold.
GAMMA, ZERO, PRIOR, SPREADS = 1.02, -100_000, 20, 8

_OP1 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, regexp_matches(role || text, '</turn>|### |\\[bche]') OR contains(role, ': ') AS odd,
    replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\e'), '### ', '\h'), ': ', '\c') AS role_e,
    replace(replace(replace(text, '\', '\b'), '</turn>', '\e'), '### ', '\h') AS text_e
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + CASE WHEN odd THEN length(role_e) + length(text_e) ELSE length(role) + length(text) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP2 = r"""
WITH l AS (
  SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS w FROM labels GROUP BY doc_id
), d AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(l.w, 1.0) AS key
  FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, 3.0 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight)::DOUBLE AS target FROM c
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), r AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM d
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target - epochs * source_size)::BIGINT - start)))::BIGINT AS taken
FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source
"""

_OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
n AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT r.x AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.y) AS component_id, r.x = min(r.y) AS kept FROM r LEFT JOIN n ON n.x = r.x GROUP BY r.x
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP5 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_transform({_WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
h AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 190 * shared >= 90 * (nx.n + ny.n)),
p AS (SELECT x, y FROM h UNION ALL SELECT y, x FROM h),
r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(r.y) AS component_id FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id
"""


def _op7() -> str:
    zeros_out = ", ".join(f"'{m}'" for m, (*_, out) in MEASURES.items() if out)
    rows = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, ({sql})::DOUBLE AS v FROM k" for m, (sql, *_) in MEASURES.items())
    value = lambda i: f"CASE WHEN b{i} = {ZERO} THEN 0.0::DOUBLE ELSE 2e0 * pow({GAMMA}::DOUBLE, b{i}) / (1e0 + {GAMMA}::DOUBLE) END AS q{i}"
    q = lambda keys, t: (
        f"SELECT {keys}measure, rows, {', '.join(map(value, (1, 2, 3)))} FROM (SELECT {keys}measure, max(rows) AS rows, " + ", ".join(f"min(bin) FILTER (upto * 4 >= rows * {i}) AS b{i}" for i in (1, 2, 3))
        + f" FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys}measure) AS rows FROM {t}) GROUP BY ALL)"
    )
    fails = []
    for m, (sql, least, low, _) in MEASURES.items():
        hi = f"q2 + greatest({least}::DOUBLE, {SPREADS} * (q3 - q2))"
        lo = f"q2 - greatest({least}::DOUBLE, {SPREADS} * (q2 - q1))" if low else "0"
        fails.append(f"WHEN '{m}' THEN ({sql})::DOUBLE NOT BETWEEN {lo} AND {hi}")
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
ww AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT *, lead(a, 1) OVER (PARTITION BY doc_id ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM ww),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + v.k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
lc AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS different FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
a AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  coalesce(lc.n - lc.different, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lc.n, 0)::BIGINT AS n_lines FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lc USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a),
k AS (SELECT * FROM b WHERE NOT base_failed),
fine AS (SELECT lang, source, measure, CASE WHEN v > 0 THEN ceil(ln(v) / ln({GAMMA}::DOUBLE))::INT ELSE {ZERO} END AS bin, count(*) FILTER (v > 0 OR measure NOT IN ({zeros_out})) AS n FROM ({rows}) GROUP BY ALL),
by_lang AS (SELECT lang, measure, bin, sum(n) AS n FROM fine GROUP BY ALL),
oq AS ({q("lang, source, ", "fine")}), lq AS ({q("lang, ", "by_lang")}),
cut AS (SELECT o.lang, o.source, o.measure, {", ".join(f"(o.rows::DOUBLE * o.q{i} + {PRIOR} * l.q{i}) / (o.rows + {PRIOR})::DOUBLE AS q{i}" for i in (1, 2, 3))}
  FROM oq o JOIN lq l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure),
bad AS (SELECT DISTINCT doc_id FROM k JOIN cut ON k.lang IS NOT DISTINCT FROM cut.lang AND k.source IS NOT DISTINCT FROM cut.source WHERE CASE measure {" ".join(fails)} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b
"""


_OP4 = """
WITH RECURSIVE c AS (SELECT list(x ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS x FROM range(256) t(i))),
d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
s AS (SELECT r, doc_id, octet_length(raw) + 16 AS size,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(raw), '..'), lambda h: ('0x' || h)::BIGINT)), lambda v, b: xor(v >> 8, tab[(xor(v, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, c),
j(r, x, j, step, draw) AS (
  SELECT r, ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::HUGEINT, 0::BIGINT, 0, 0::BIGINT FROM d
  UNION ALL SELECT r, y, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((y // 8589934592) + 1)::DOUBLE))::BIGINT, step + 1, CASE step WHEN 0 THEN (y // 8589934592)::BIGINT ELSE draw END
  FROM (SELECT r, (x * 2862933555777941757::HUGEINT + 1) % 18446744073709551616 AS y, j, step, draw FROM j WHERE j <= 40)
),
k AS (SELECT r, max(j) FILTER (j < 40) AS shard, max(j) FILTER (j <= 40) AS grown, max(draw) AS draw FROM j GROUP BY r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY draw & 255, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown::INT AS grown_shard FROM s JOIN k USING (r)
"""

_OP6 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT r, k, substr(h, (800 * k + 1)::INT, 1200) AS p FROM (SELECT r, h, unnest(range((length(h) + 799) // 800)) AS k FROM d)),
w AS (SELECT r, 400 * k + s AS s, md5(substr(p, (2 * s + 1)::INT, 400)) AS m FROM (SELECT r, k, p, unnest(range(least(400, length(p) // 2 - 199))) AS s FROM b)),
hit AS (SELECT r, s FROM w SEMI JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
isle AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS k FROM (SELECT r, s, CASE WHEN s > lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 1 ELSE 0 END AS fresh FROM hit)),
span AS (SELECT r, min(s) AS a, max(s) + 200 AS b FROM isle GROUP BY r, k),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM span),
kept AS (SELECT d.r, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h, sum(b - a) AS removed, count(*) AS spans FROM d JOIN cut USING (r) GROUP BY d.r)
SELECT doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

_OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha1(html), (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM p
"""


_OP11 = "WITH s AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM embeddings WHERE len(embedding) = 64), v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS x FROM s WHERE len(list_filter(e, lambda x: isfinite(x))) = 64)"
_OP11 += ", c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS j, x AS c FROM v ORDER BY j LIMIT 8)"
for _i in range(11):
    _OP11 += f", a{_i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 8 + j) AS m FROM v CROSS JOIN c{_i} GROUP BY r)"
    _OP11 += f", e{_i} AS (SELECT m % 8 AS j, unnest(x) AS x, generate_subscripts(x, 1) AS p FROM a{_i}), f{_i} AS (SELECT j, p, sum(x)::BIGINT AS t, count(*) AS n FROM e{_i} GROUP BY j, p)"
    _OP11 += f", c{_i + 1} AS MATERIALIZED (SELECT j, list((t - ((t % n) + n) % n) // n ORDER BY p) AS c FROM f{_i} GROUP BY j UNION ALL SELECT j, c FROM c{_i} WHERE j NOT IN (SELECT j FROM f{_i}))"
_OP11 += " SELECT vec_id, j::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM (SELECT vec_id, m % 8 AS j, m // 8 AS d FROM a10) JOIN c10 USING (j)"

_OP12 = """
WITH RECURSIVE tab AS (SELECT list(x ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS x FROM range(256) t(i))),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(r) || ':' || r || x), 1, 32)) AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS donor,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda v, b: xor(v >> 8, tab[(xor(v, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), tab),
b AS (SELECT c.conv_id, 0 AS own, i, r, x FROM c JOIN k ON k.conv_id = donor AND i <= h UNION ALL SELECT conv_id, 1, i, r, x FROM c JOIN k USING (conv_id) WHERE i > h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS d FROM b),
p AS MATERIALIZED (SELECT conv_id, d, md5(string_agg(length(r) || ':' || length(x) || ':' || r || x, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node, length(x) AS chars FROM o UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS MATERIALIZED (SELECT d, node, min(conv_id) AS conv, count(*) AS members, max(chars) AS chars FROM p GROUP BY d, node),
up AS (SELECT n.d, n.node, q.node AS above, m.conv AS parent FROM n JOIN p q ON q.conv_id = n.conv AND q.d = n.d - 1 JOIN n m ON m.d = q.d AND m.node = q.node),
kids AS (SELECT d - 1 AS d, above AS node, count(*) AS n FROM up GROUP BY ALL),
sub AS (SELECT a.d, a.node, sum((n.members - 1) * n.chars) AS saved, count(*) FILTER (k.n IS NULL) AS leaves FROM n LEFT JOIN kids k ON k.d = n.d AND k.node = n.node JOIN p a ON a.conv_id = n.conv AND a.d <= n.d GROUP BY a.d, a.node),
fin AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
ends AS (SELECT p.d, p.node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM p JOIN fin USING (conv_id, d) GROUP BY p.d, p.node)
SELECT n.conv AS conv_id, n.d::BIGINT AS depth, up.parent AS parent_conv_id, n.members::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n JOIN sub ON sub.d = n.d AND sub.node = n.node LEFT JOIN up ON up.d = n.d AND up.node = n.node LEFT JOIN kids ON kids.d = n.d AND kids.node = n.node LEFT JOIN ends ON ends.d = n.d AND ends.node = n.node
"""

_OP13 = """
WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, s, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (SELECT r, h || s AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(h || s) DESC) AS k FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN fit ON fit.r = p.r AND k = 1
"""


SQL = {
    "op1_chat_formatting": _OP1, "op2_mixing": _OP2, "op3_embedding_near_dedup": _OP3, "op4_sharding": _OP4, "op5_ngram_join": _OP5,
    "op6_suffix_dedup": _OP6, "op7_quality_rules": _op7(), "op9_warc": _OP9, "op11_centroid_clustering": _OP11, "op12_prefix_trie": _OP12, "op13_url_filters": _OP13,
}
