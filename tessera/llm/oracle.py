"""DuckDB SQL of the queries that SQL can express.

The others have none: SimHash and virtual slots need XXH64, the fitted models
and token vocabularies have no SQL form, and the neighbour search is
approximate; tests hold those against brute force.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('7:' || coalesce(doc_id::VARCHAR, '') || CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN ':' || md5(coalesce(text, ''))
      || ':' || (row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, '')), source) - 1)::VARCHAR ELSE '' END) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (2 * sum(size))::DOUBLE AS most,
    ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5 AS total, sum(w) OVER () AS weight_sum,
    coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(w) OVER o, 0) AS w_before
  FROM s WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, most / w <= (total - most_before) / (weight_sum - w_before) AS is_full FROM f),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN most ELSE
    w * ((total - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (), 0)) END AS target
  FROM g),
r AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d),
e AS (
  SELECT r.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
    CASE WHEN t.source_size > 0 THEN floor(t.target + 0.5)::BIGINT // t.source_size ELSE 0 END AS epochs
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM e
"""

CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (
  SELECT conv_id, list({'r': role, 'x': text} ORDER BY turn NULLS LAST, role, text) AS l, count(*) AS n FROM t GROUP BY conv_id),
k AS (
  SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_copies FROM c
  WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.n > c.n AND o.l[1] = c.l[1] AND o.l[1:c.n] = c.l)
  GROUP BY l, n)
SELECT t.conv_id, coalesce(t.turn // 1024, 4611686018427387904)::BIGINT AS segment, n_turns, n_copies,
  string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '<||') || '<|end|>' || chr(10), ''
    ORDER BY turn NULLS LAST, role, text) AS text
FROM t JOIN k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY t.conv_id, segment, n_turns, n_copies
"""

LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM s),
y AS (SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS line_key FROM l),
f AS (SELECT line_key FROM y WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10),
d AS (SELECT doc_id, line, pos, line_key IN (SELECT line_key FROM f) AS gone FROM y)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

# CRC-32 of the decimal id, bit by bit: a byte is mixed in, then eight steps (-1).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
    lambda ch: list_concat([ascii(ch)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)"""

TRIE = rf"""
WITH t AS (
  SELECT conv_id::BIGINT AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, md5(length(r)::VARCHAR || ':' || r || x)) AS l FROM t GROUP BY c),
h AS (SELECT c, l, {_CRC} % 4 AS h FROM o),
b AS (SELECT h.c, list_concat(coalesce(f.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN h AS f ON f.c = h.c - h.c % 20),
p AS (SELECT c, len(l) AS n, d, l[1:d] AS path FROM (SELECT c, l, unnest(generate_series(0, len(l))) AS d FROM b)),
n AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM p GROUP BY d, path),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.path[d].x, '[^\x20\x09-\x0D]+')) END AS own
  FROM n LEFT JOIN k ON n.path = k.path),
a AS (
  SELECT path[1:e] AS path, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM (SELECT path, n_children, own, unnest(generate_series(0, d)) AS e FROM m) GROUP BY 1)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.n_leaves, a.saved_tokens, m.ends_sha256
FROM m JOIN a ON m.path = a.path LEFT JOIN m AS u ON m.d > 0 AND u.path = m.path[1:m.d - 1]
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN label END AS label, embedding::DOUBLE[] AS e
  FROM embeddings),
p AS (
  SELECT a.row AS a, b.row AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.row <> b.row AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT row, row FROM v UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT r.a, min(v.vec_id) AS component_id FROM r JOIN v ON r.b = v.row GROUP BY r.a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN c ON c.a = v.row LEFT JOIN n ON n.a = v.row
"""

LLM_ORACLE: dict[str, str] = {
    "op7_mixing": MIXING,
    "op8_chat": CHAT,
    "op9_lines": LINES,
    "op11_trie": TRIE,
    "op12_embedding_dedup": EMBEDDINGS,
}
