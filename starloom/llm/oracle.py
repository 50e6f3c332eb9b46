"""DuckDB SQL of the operators that SQL can express, written from their contracts alone (plain joins, no pruning).

``documents`` rows are told apart by a row number, so repeated ids would do no harm. The remaining operators (extraction,
fingerprints, token counts, language models) are beyond SQL and are tested against brute force.
"""

import math

from starloom.llm import licenses
from starloom.llm.mixing import OP10_SQL

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s + 1:s + 10], ' ') AS t FROM p),
sizes AS (SELECT DISTINCT k FROM windows),
q AS (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS s FROM d, sizes WHERE len(w) >= k),
g AS (SELECT r, k, s, array_to_string(w[s + 1:s + k], ' ') AS t FROM q),
h AS (SELECT DISTINCT r, g.k, s, item_id FROM g JOIN windows ON g.t = windows.t AND g.k = windows.k),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(s, s + k)) AS place FROM (SELECT DISTINCT r, s, k FROM h)) GROUP BY r),
item AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (
  SELECT DISTINCT r, item_id::VARCHAR AS id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(item.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)
"""

#: Bytes are handled as pairs of hex digits.
OP2_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT r, doc_id, x, unnest(range(greatest(0, length(x) // 2 - 99))) AS s FROM d),
m AS (SELECT r, doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS t FROM p),
l AS (SELECT r, s FROM (SELECT r, s, rank() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, s) AS n FROM m) WHERE n > 1),
b AS (SELECT r, s, s > coalesce(lag(s) OVER (PARTITION BY r ORDER BY s) + 100, -1) AS fresh FROM l),
c AS (SELECT r, s, sum(fresh::INT) OVER (PARTITION BY r ORDER BY s) AS run FROM b),
g AS (SELECT r, min(s) AS s, max(s) + 100 AS e FROM c GROUP BY r, run),
k AS (SELECT r, e AS s, lead(s) OVER (PARTITION BY r ORDER BY s) AS e FROM (SELECT r, s, e FROM g UNION ALL SELECT r, -1, 0 FROM d)),
kept AS (SELECT r, string_agg(substr(x, 2 * s + 1, 2 * (coalesce(e, length(x) // 2) - s)), '' ORDER BY s) AS x FROM k JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(e - s) AS removed, count(*) AS spans FROM g GROUP BY r)
SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN n USING (r)
"""

OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
g AS (SELECT count(*)::DOUBLE AS n, avg(len(w)) AS mean FROM d),
t AS (SELECT r, doc_id, any_value(len) AS len, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS len, unnest(w) AS term FROM d) GROUP BY r, doc_id, term),
f AS (SELECT term, ln(1 + (any_value(g.n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t, g GROUP BY term),
x AS (SELECT t.r, t.doc_id, t.term, t.tf * 2.2::DOUBLE / (t.tf + 1.2::DOUBLE * (0.25 + 0.75 * t.len / g.mean)) AS weight FROM t, g),
s AS (SELECT q.r AS qr, q.doc_id AS query_id, x.r, x.doc_id, round(sum(q.tf * f.idf * x.weight), 9) AS score
  FROM t q JOIN f USING (term) JOIN x USING (term) WHERE q.doc_id % 100 = 0 GROUP BY q.r, q.doc_id, x.r, x.doc_id),
o AS (SELECT query_id, row_number() OVER (PARTITION BY qr ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT query_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10
"""

#: kind, pattern, what stands before the part whose length counts, that length. Places come from marking each match.
_RULES = (
    ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
     r"""["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)""", r"""^[A-Za-z_]+["\x27]?\x20*[:=]\x20*["\x27]?""", 6),
    ("access", r"AKIA[A-Z0-9]+", "^", 20),
    ("hex", r"[0-9a-f]+", "^", 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", "^", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", "^", 15),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "^", 0),
)

_FOUND = " UNION ALL ".join(
    f"""SELECT r, {k} AS k, '{kind}' AS kind, c.at - length(c.hit) AS s, c.at AS e FROM (
      SELECT r, string_split(part, chr(57345))[1] AS hit, n, sum(length(replace(part, chr(57345), ''))) OVER (PARTITION BY r ORDER BY n)
        - length(replace(part, chr(57345), '')) + length(string_split(part, chr(57345))[1]) AS at
      FROM (SELECT r, unnest(parts) AS part, unnest(range(len(parts))) AS n FROM (
        SELECT r, string_split(regexp_replace(text, '{rule}', chr(57344) || '\\0' || chr(57345), 'g'), chr(57344)) AS parts FROM d)
        ) ) c WHERE n > 0 AND length(regexp_replace(c.hit, '{before}', '')) >= {least}"""
    for k, (kind, rule, before, least) in enumerate(_RULES))

OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_FOUND}),
a AS (SELECT r, count(*) FILTER (WHERE k = 0) AS n0, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)
"""

OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(greatest(0, len(w) - 49))) AS s FROM d),
m AS (SELECT r, doc_id, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS t FROM p),
l AS (SELECT r, s FROM (SELECT r, s, coalesce(doc_id, -9223372036854775808) AS id, min(coalesce(doc_id, -9223372036854775808)) OVER (PARTITION BY t) AS least FROM m) WHERE id > least),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 50)) AS at FROM l),
word AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS at FROM d),
k AS (SELECT word.r, count(gone.at) AS removed, string_agg(word, ' ' ORDER BY word.at) FILTER (WHERE gone.at IS NULL) AS kept
  FROM word LEFT JOIN gone ON gone.r = word.r AND gone.at = word.at GROUP BY word.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

#: Zlib's CRC-32 byte by byte, from a table made by its rule.
OP11_SQL = r"""
WITH RECURSIVE step(i, n, c) AS (SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE n < 8),
byte AS (SELECT i, c FROM step WHERE n = 8),
crc(c, s, n, x) AS (SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL SELECT crc.c, s, n + 1, xor(x >> 8, byte.c) FROM crc JOIN byte ON byte.i = xor(x & 255, ord(substr(s, n + 1, 1))) WHERE n < length(s)),
conv AS (SELECT c, xor(x, 4294967295) & 3 AS h, c - c % 20 AS base FROM crc WHERE n = length(s)),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS p,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
built AS (SELECT conv.c, p, role, text FROM conv JOIN own ON own.c = conv.base WHERE p < h
  UNION ALL SELECT conv.c, p, role, text FROM conv JOIN own ON own.c = conv.c WHERE p >= h),
turn AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, sha256(length(role)::VARCHAR || ':' || role || text) AS t,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words FROM built),
path AS (SELECT c, d, string_agg(t, ',') OVER (PARTITION BY c ORDER BY d) AS key, words FROM turn UNION ALL SELECT c, 0, '', 0 FROM conv),
ending AS (SELECT key, p.d, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids, count(*) AS n FROM path p
  JOIN (SELECT c, max(d) AS d FROM path GROUP BY c) l ON l.c = p.c AND l.d = p.d GROUP BY key, p.d),
node AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM path GROUP BY key, d),
known AS (SELECT node.*, coalesce(ending.ids, '') AS ids, (n_convs = coalesce(ending.n, 0))::INT AS leaf FROM node LEFT JOIN ending USING (key, d)),
below AS (SELECT p.key, p.d, sum(x.leaf) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved, sum((x.d = p.d + 1)::INT) AS n_children
  FROM known x JOIN path p ON p.c = x.conv_id AND p.d <= x.d GROUP BY p.key, p.d)
SELECT k.conv_id::BIGINT AS conv_id, k.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, k.n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(k.ids) AS ends_sha256
FROM known k JOIN below USING (key, d)
LEFT JOIN path above ON above.c = k.conv_id AND above.d = k.d - 1 LEFT JOIN node up ON up.key = above.key AND up.d = above.d
"""


def _op12_sql(size: int = 64, centroids: int = 8, rounds: int = 10) -> str:
    near = ("SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS n FROM (SELECT v.r, k.c, "
            "sum((v.z - k.z) * (v.z - k.z)) AS d FROM v JOIN c{i} k ON v.i = k.i GROUP BY v.r, k.c)) WHERE n = 1")
    steps = "".join(f""",
n{i} AS MATERIALIZED ({near.format(i=i)}),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, c{i}.i, coalesce((m.s - (m.s % m.n + m.n) % m.n) // m.n, c{i}.z) AS z FROM c{i}
  LEFT JOIN (SELECT c, i, sum(z)::BIGINT AS s, count(*) AS n FROM n{i} JOIN v USING (r) GROUP BY c, i) m ON m.c = c{i}.c AND m.i = c{i}.i)"""
                    for i in range(rounds))
    return f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding AS x FROM embeddings WHERE len(embedding) = {size}),
u AS (SELECT r, vec_id, unnest(x) AS x, unnest(range({size})) AS i FROM e),
bad AS (SELECT DISTINCT r FROM u WHERE x IS NULL OR NOT isfinite(x)),
v AS MATERIALIZED (SELECT r, vec_id, i, floor(1024 * x::DOUBLE)::BIGINT AS z FROM u WHERE r NOT IN (SELECT r FROM bad)),
w AS (SELECT r, sha256('3:' || vec_id::VARCHAR) AS h, list(z ORDER BY i) AS x FROM v GROUP BY r, vec_id),
o AS (SELECT r, row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c FROM w),
c0 AS MATERIALIZED (SELECT c, i, z FROM o JOIN v USING (r) WHERE c < {centroids}){steps},
a AS MATERIALIZED ({near.format(i=rounds)}),
digest AS (SELECT c, sha256(string_agg(z::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, a.c::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, digest.h AS centroid_sha256
FROM a JOIN digest USING (c) JOIN e USING (r)
"""


def _op13_sql() -> str:
    rows = [(label, True, text.split()) for text, label in licenses.PHRASES] + [(label, False, text.split()) for label, text in licenses.NOTICES]
    places = ", ".join(f"({i}, {at}, '{a} {b}')" for i, (_, _, w) in enumerate(rows) for at, (a, b) in enumerate(zip(w, w[1:])))
    need = lambda exact, n: n if exact or n < licenses.WHOLE else math.ceil(licenses.COVER * n)
    names = ", ".join(f"({i}, '{label}', {exact}, {len(w) - 1}, {need(exact, len(w) - 1)})" for i, (label, exact, w) in enumerate(rows))
    return f"""
WITH place(t, tp, gram) AS (VALUES {places}), template(t, label, exact, n, need) AS (VALUES {names}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
word AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
pair AS (SELECT a.r, a.p, a.word || ' ' || b.word AS gram FROM word a JOIN word b ON a.r = b.r AND b.p = a.p + 1),
vote AS (SELECT r, t, p - tp AS diagonal, p, tp FROM pair JOIN place USING (gram)),
base AS (SELECT r, label, diagonal AS s FROM (SELECT r, t, diagonal, count(*) AS n FROM vote GROUP BY r, t, diagonal) x
  JOIN template USING (t) WHERE exact AND x.n = template.n),
near AS (SELECT m.r, m.t, count(DISTINCT tp) AS n, max(p) - min(p) + 2 AS span FROM (SELECT DISTINCT r, t, diagonal FROM vote) m
  JOIN vote v ON v.r = m.r AND v.t = m.t AND v.diagonal BETWEEN m.diagonal - {licenses.SLACK} AND m.diagonal + {licenses.SLACK}
  JOIN template ON template.t = m.t WHERE NOT exact GROUP BY m.r, m.t, m.diagonal),
found AS (SELECT r, label, near.n::DOUBLE / template.n AS score FROM near JOIN template USING (t) WHERE near.n >= need AND span <= 1.5 * (template.n + 1)
  UNION ALL SELECT r, label, 1.0 FROM base),
b AS (SELECT r, count(*) AS n, min(s) AS least, max(s) AS most, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
f AS (SELECT r, max(score) AS score, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, least::BIGINT AS first_word, most::BIGINT AS last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(f.labels, '') AS labels, coalesce(f.score, 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN f USING (r)
"""


ORACLE = {"op1_decontaminate": OP1_SQL, "op2_suffix_dedup": OP2_SQL, "op5_search": OP5_SQL, "op6_secrets": OP6_SQL,
          "op8_phrase_dedup": OP8_SQL, "op10_mix": OP10_SQL, "op11_prefix_trie": OP11_SQL, "op12_centroids": _op12_sql(),
          "op13_licenses": _op13_sql()}
