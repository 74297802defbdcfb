"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

_REACHED = """
sides AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reached AS (
  SELECT id AS origin, id AS node FROM nodes
  UNION
  SELECT r.origin, b.b FROM reached r JOIN sides b ON b.a = r.node)
"""

OP1 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
nodes AS (SELECT DISTINCT doc_id AS id FROM documents),
{_REACHED}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT origin, min(node) AS component_id FROM reached GROUP BY 1) r ON r.origin = d.doc_id
"""

OP3 = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(greatest(strlen(coalesce(text, '')), 1))::BIGINT AS bytes FROM documents GROUP BY 1),
rates AS (
  SELECT source, sqrt(bytes::DOUBLE) / sum(sqrt(bytes::DOUBLE)) OVER () * sum(bytes) OVER () / bytes AS rate FROM sizes),
steps AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM rates),
masses AS (
  SELECT source, k, exp(k * ln(rate) - rate - sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k)) AS mass FROM steps),
tables AS (
  SELECT source, k, sum(mass) OVER (PARTITION BY source ORDER BY k) AS cdf FROM masses),
drawn AS (
  SELECT d.doc_id, d.source, d.text, count(*) FILTER (WHERE t.cdf <= ('0x' || substr(md5('7:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) AS n_copies
  FROM documents d JOIN tables t ON t.source IS NOT DISTINCT FROM d.source GROUP BY 1, 2, 3),
copies AS (SELECT *, unnest(range(0, n_copies)) AS copy FROM drawn)
SELECT doc_id, source, length(text)::INTEGER AS text_chars, text, n_copies::INTEGER AS n_copies, copy::INTEGER AS copy,
  row_number() OVER (ORDER BY ('0x' || substr(md5('7:' || doc_id || ':' || copy), 1, 13))::BIGINT, doc_id, copy) - 1 AS position
FROM copies
"""

OP5 = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings),
{_REACHED}
SELECT v.vec_id, (SELECT count(*) FROM sides WHERE sides.a = v.vec_id) AS n_links, r.component_id, v.vec_id = r.component_id AS kept
FROM embeddings v JOIN (SELECT origin, min(node) AS component_id FROM reached GROUP BY 1) r ON r.origin = v.vec_id
"""

OP7 = """
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length('<turn ') + length(role) + length('>') + length(text) + length('</turn>') + 1
    + (length(text) - length(replace(text, '\\', '')))
    + (length(text) - length(replace(text, '<turn', ''))) // 5 + (length(text) - length(replace(text, '</turn', ''))) // 6 AS n
  FROM rows_)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"

#: kind, pattern, judged group, least length
_KINDS = (
    ("assign", rf"""({_NAME})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[opsu]_[A-Za-z0-9]+", 0, 30),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)


def _found(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT rid, {rank} AS rank, '{kind}' AS kind, begin_ AS b, begin_ + length(hits[i]) AS e FROM (
      SELECT rid, hits, good, i, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS begin_
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', {group}) AS good
        FROM d WHERE regexp_matches(t, '{pattern}'))))
    WHERE length(good[i]) >= {least}"""


OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_found(i, *k) for i, k in enumerate(_KINDS))}),
g AS (
  SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, rank) AS spans
  FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON g.rid = d.rid
"""

OP11 = """
WITH w AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS o, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
places AS (SELECT o, i, array_to_string(w[i:i+19], ' ') AS s FROM (SELECT o, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
later AS (SELECT o, i FROM places QUALIFY row_number() OVER (PARTITION BY s ORDER BY o, i) > 1),
gone AS (SELECT DISTINCT o, i + k AS i FROM later, range(0, 20) AS r(k)),
words AS (SELECT o, w[i] AS x, i FROM (SELECT o, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
left_ AS (SELECT o, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (o, i) GROUP BY o)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ USING (o)
"""

OP12 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, w[i:i+m-1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS s(m))),
f AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY 1, 2),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY 1),
c AS (SELECT lang, g, a FROM f WHERE len(g) > 1 AND a >= 30),
inner_ AS (
  SELECT lang, g[i:i+m-1] AS g, max(a) AS most
  FROM (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i FROM c, (VALUES (2), (3)) AS s(m) WHERE m < len(g)) GROUP BY 1, 2),
alive AS (SELECT c.* FROM c LEFT JOIN inner_ USING (lang, g) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * c.a::HUGEINT),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM alive),
scored AS (
  SELECT cuts.lang, cuts.g, cuts.a, k, x.a AS l, y.a AS r, ((2000000 * cuts.a::HUGEINT) // (x.a + y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k+1:]),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase FROM worst)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000
"""

SQL = {
    "op1_minhash_odd_sketches": OP1,
    "op3_poisson_mixing": OP3,
    "op5_pruned_graph": OP5,
    "op7_event_sourced_chat": OP7,
    "op8_trigram_secrets": OP8,
    "op11_count_min_windows": OP11,
    "op12_de_bruijn_phrases": OP12,
}
