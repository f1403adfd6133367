"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import url_filter

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
     w AS (SELECT n, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id FROM d GROUP BY n)
SELECT d.doc_id, w.keep_id, w.group_size, d.doc_id = w.keep_id AS kept, sha256(d.n) AS text_sha256
FROM d JOIN w USING (n)
"""

OP3 = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations),
     every_call AS (SELECT *, conv_id || '-' || turn AS call_id, CASE role WHEN 'system' THEN 'configure' ELSE 'answer' END AS name
               FROM c WHERE role IN ('system', 'user')),
     -- of calls with one id the smallest by name and text stands (their turns are equal)
     calls AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY name, text) AS nth FROM every_call),
     every_result AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn, text AS content FROM c WHERE role = 'assistant'),
     results AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, content) AS nth FROM every_result),
     linked AS (
       SELECT coalesce(a.conv_id, r.conv_id) AS conv_id, coalesce(a.call_id, r.call_id) AS call_id, coalesce(a.turn, r.turn) AS turn, a.turn AS own, a.role,
              a.text, a.words, r.content, o.call_id IS NOT NULL AS opened,
              CASE WHEN a.role IS NULL THEN 'orphan' WHEN r.content IS NULL THEN 'unanswered' ELSE 'linked' END AS status
       FROM (SELECT * FROM calls WHERE nth = 1 AND call_id IS NOT NULL) a
       FULL JOIN (SELECT * FROM results WHERE nth = 1 AND call_id IS NOT NULL) r ON a.conv_id = r.conv_id AND a.call_id = r.call_id
       LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM calls WHERE turn = 0) o ON o.conv_id = a.conv_id
       UNION ALL SELECT conv_id, call_id, turn, turn, role, text, words, NULL, false, CASE WHEN call_id IS NULL THEN 'no_id' ELSE 'repeated' END
       FROM calls WHERE nth > 1 OR call_id IS NULL
       UNION ALL SELECT conv_id, call_id, turn, NULL, NULL, NULL, NULL, content, false, CASE WHEN call_id IS NULL THEN 'orphan' ELSE 'repeated_result' END
       FROM results WHERE nth > 1 OR call_id IS NULL
       UNION ALL SELECT conv_id, NULL, turn, NULL, NULL, NULL, NULL, text, false, 'other' FROM c WHERE role IS NULL OR role NOT IN ('system', 'user', 'assistant')),
     e AS (SELECT *, role = 'user' AND own IS DISTINCT FROM 0 AS cites, status IN ('linked', 'unanswered', 'orphan') AS part FROM linked),
     f AS (SELECT *, CASE WHEN part THEN list_filter([CASE WHEN role = 'system' THEN 'unknown words' END,
                                  CASE WHEN cites AND NOT opened THEN 'uncited result' END], lambda x: x IS NOT NULL) ELSE [status] END AS faults FROM e)
SELECT conv_id, call_id, (CASE WHEN role IS NULL OR NOT part THEN NULL WHEN cites AND opened THEN 1 ELSE 0 END)::INT AS level,
       turn, status, len(faults) = 0 AS valid, array_to_string(faults, ',') AS errors,
       '{"arguments":' || coalesce('{' || CASE WHEN cites THEN '"context":"' || coalesce('$result:' || conv_id || '-0', '') || '",' ELSE '' END
         || '"text":' || to_json(text) || ',"turn":' || coalesce(own::VARCHAR, '""') || ',"words":'
         || CASE WHEN role = 'user' THEN words::VARCHAR ELSE '"' || words || '"' END || '}', 'null')
       || ',"id":' || coalesce(to_json(call_id)::VARCHAR, 'null') || ',"name":'
       || coalesce(CASE role WHEN 'system' THEN '"configure"' WHEN 'user' THEN '"answer"' END, 'null')
       || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM f
"""

OP4 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
     w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(ws) - 11)) AS t(i)),
     m AS (SELECT g, min(doc_id) AS lo FROM w GROUP BY g),
     gone AS (SELECT DISTINCT doc_id, i + k AS p FROM w JOIN m USING (g), range(13) AS r(k) WHERE lo < doc_id),
     words AS (SELECT doc_id, i AS p, ws[i] AS word FROM d, unnest(range(1, len(ws) + 1)) AS t(i)),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
              FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE
 d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
       FROM d, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS t(i) WHERE len(ws) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
 e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 reach(doc_id, far) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM reach r JOIN e ON e.x = r.far)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(far) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def op9(iterations: int = 12, damping: float = 0.85) -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", a, h + p) for a, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in fits) + " END"
    action = "CASE " + " ".join(f"WHEN {c} THEN '{a}'" for c, a, _ in fits) + " END"
    host = r"translate(regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1), '" + url_filter.UPPER + "', '" + url_filter.LOWER + "')"
    href = url_filter.HREF.replace("'", "''")
    steps = []
    for i in range(iterations):
        steps.append(f"""r{i + 1} AS MATERIALIZED (
  SELECT n.kind, n.host, {1 - damping} * n.s + {damping} * coalesce(g.x, 0) AS r FROM nodes n LEFT JOIN (
    SELECT kind, host, sum(x) AS x FROM (
      SELECT e.kind, e.b AS host, r * w AS x FROM r{i} q JOIN e ON e.kind = q.kind AND e.a = q.host
      UNION ALL SELECT q.kind, q.host, r FROM r{i} q JOIN nodes k ON k.kind = q.kind AND k.host = q.host AND k.sink) z
    GROUP BY ALL) g USING (kind, host))""")
    return rf"""
WITH p AS MATERIALIZED (SELECT page_id, {host.format("coalesce(url, '')")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
j AS MATERIALIZED (SELECT page_id, host, path, {rule} AS rule, {action} AS action FROM p),
h AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i){href}', 1)) AS href FROM p),
links AS (SELECT src, {host.format("CASE WHEN starts_with(href, '//') THEN 'x:' || href ELSE href END")} AS dst FROM h),
kin AS (SELECT host, parent FROM (SELECT DISTINCT host, regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) AS parent FROM p WHERE host <> '') WHERE parent <> ''),
edges AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM (
  SELECT src, dst FROM links WHERE src <> '' AND dst <> '' AND src <> dst
  UNION ALL SELECT host, parent FROM kin UNION ALL SELECT parent, host FROM kin) GROUP BY ALL),
both_ways AS (SELECT 'trust' AS kind, src AS a, dst AS b, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges),
e AS MATERIALIZED (SELECT kind, a, b, n / sum(n) OVER (PARTITION BY kind, a) AS w FROM both_ways),
c AS MATERIALIZED (SELECT host, count(*) FILTER (action = 'allow') AS a, count(*) FILTER (action = 'block') AS b
  FROM j WHERE action IS NOT NULL AND host <> '' GROUP BY host),
seed AS MATERIALIZED (SELECT 'trust' AS kind, host, coalesce(a / nullif(sum(a) OVER (), 0), 0) AS s FROM c
  UNION ALL SELECT 'distrust', host, coalesce(b / nullif(sum(b) OVER (), 0), 0) FROM c),
names AS (SELECT kind, a AS host FROM e UNION SELECT kind, b FROM e UNION SELECT kind, host FROM seed),
nodes AS MATERIALIZED (SELECT m.kind, m.host, coalesce(s, 0) AS s,
  NOT EXISTS (SELECT 1 FROM e WHERE e.kind = m.kind AND e.a = m.host) AS sink FROM names m LEFT JOIN seed USING (kind, host)),
r0 AS (SELECT kind, host, s AS r FROM nodes),
{", ".join(steps)},
score AS (SELECT host, max(r) FILTER (kind = 'trust') AS t, max(r) FILTER (kind = 'distrust') AS d FROM r{iterations} GROUP BY host)
SELECT page_id, j.host, path, rule,
  coalesce(action, CASE WHEN coalesce(d, 0) > 0 AND coalesce(d, 0) >= coalesce(t, 0) * (1 - 1e-9) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN score ON score.host = j.host
"""


# CRC-32 of the decimal id, bit by bit; nodes are keyed by the hash chain of their turns
OP11 = r"""
WITH t AS MATERIALIZED (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
o AS MATERIALIZED (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
    substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS i,
  sha256(strlen(role) || ':' || role || text) AS g,
  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM t),
ids AS MATERIALIZED (SELECT c, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)),
head AS (SELECT ids.c, i, g, w FROM ids JOIN o ON o.c = ids.c - ids.c % 20 AND i <= h),
rest AS (SELECT ids.c, i + 1000000 AS i, g, w FROM ids JOIN o ON o.c = ids.c AND i > h),
b AS MATERIALIZED (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, g, w FROM (SELECT * FROM head UNION ALL SELECT * FROM rest)),
m AS MATERIALIZED (SELECT c, 0 AS d, '' AS k, '' AS up, 0 AS w FROM ids UNION ALL
  SELECT c, d, sha256(string_agg(g, '' ORDER BY e)), CASE WHEN d > 1 THEN sha256(string_agg(g, '' ORDER BY e) FILTER (e < d)) ELSE '' END, max(w) FILTER (e = d)
  FROM (SELECT x.c, x.d, y.d AS e, y.g, y.w FROM b x JOIN b y ON y.c = x.c AND y.d <= x.d) GROUP BY c, d),
l AS (SELECT c, max(d) AS len FROM m GROUP BY c),
n AS MATERIALIZED (SELECT d, k, min(up) AS up, min(c) AS c, count(*) AS members, max(w) AS w, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '') AS ends
  FROM m JOIN l USING (c) GROUP BY d, k),
kids AS MATERIALIZED (SELECT p.d, p.k, count(x.k) AS children FROM n p LEFT JOIN n x ON x.d = p.d + 1 AND x.up = p.k GROUP BY p.d, p.k),
sub AS (SELECT a.d, a.k, count(*) FILTER (z.children = 0) AS leaves, sum((u.members - 1) * u.w)::BIGINT AS saved
  FROM n u JOIN kids z USING (d, k) JOIN m a ON a.c = u.c AND a.d <= u.d GROUP BY a.d, a.k)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.members AS n_convs, children AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN kids USING (d, k) JOIN sub USING (d, k) LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.up
"""

OP12 = """
WITH r AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
    coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS MATERIALIZED (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b, p.score AS ps, s.b AS x, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT a AS anchor_id, b AS positive_id, rank::INTEGER AS rank, x AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= 3
"""

ORACLES = {"op1_exact_dedup": OP1, "op3_chat_format": OP3, "op4_substring_dedup": OP4, "op8_jaccard_join": OP8,
           "op9_url_filter": op9(), "op11_conversation_trie": OP11, "op12_hard_negatives": OP12}
