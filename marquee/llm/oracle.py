"""DuckDB SQL of the registered queries that SQL can express (over whole tables)."""

from __future__ import annotations

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: CRC-32 bit by bit over the text's bytes, then ranks, fractions and cuts by windows.
SHARDS = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) r(i)
), bytes AS (
  SELECT rowid AS r, doc_id, source, coalesce(text, '') AS s FROM (
    SELECT row_number() OVER () AS rowid, doc_id, source, text FROM documents)
), sized AS (
  SELECT doc_id, source, strlen(s) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               regexp_extract_all(hex(encode(s)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table
), ranked AS (
  SELECT *, coalesce('s' || source, '') AS src,
         md5(concat_ws(chr(31), '17', coalesce(doc_id::VARCHAR, ''), text_crc32::VARCHAR,
                       size::VARCHAR)) AS draw
  FROM sized
), shared AS (
  SELECT *, (2 * (row_number() OVER (PARTITION BY src ORDER BY draw, doc_id, text_crc32, size) - 1) + 1)
            / (2 * count(*) OVER (PARTITION BY src)) AS share
  FROM ranked
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY share, src, draw, doc_id, text_crc32, size) - 1 AS i,
         count(*) OVER () AS n
  FROM shared
), cut AS (SELECT *, (i * 16) // n AS shard FROM numbered)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       i - (shard * n + 15) // 16 AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

EXACT_DEDUP = f"""
WITH norm AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {AZ})) AS d FROM documents),
best AS (SELECT d, max(doc_id) AS keep_id, count(*) AS n FROM norm GROUP BY d)
SELECT doc_id, keep_id, n AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       d AS text_sha256
FROM norm JOIN best USING (d)
"""

#: All pairs that share a shingle, by counting; then the transitive closure.
NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {AZ}),
                                                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                      lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs WHERE 100 * common >= 80 * (na + nb - common)
), linked AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN least ON doc_id = a
"""


def url_filter(rules, rounds: int = 12, damping: float = 0.85) -> str:
    """Rules by longest match; trust and distrust by as many rounds of sums over the host links."""
    listed = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    steps = ""
    for k in range(1, rounds + 1):
        steps += f""", s{k} AS (
  SELECT host, sum(t) AS t, sum(d) AS d FROM (
    SELECT host, t, d FROM s0
    UNION ALL SELECT dst, {damping} * t / n_out, 0 FROM s{k - 1} JOIN edges ON host = src
    UNION ALL SELECT src, 0, {damping} * d / n_in FROM s{k - 1} JOIN edges ON host = dst
  ) GROUP BY host)"""
    return f"""
WITH parts AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (VALUES {listed}),
fitting AS (
  SELECT s.host, s.path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY s.host, s.path
                            ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM (SELECT DISTINCT host, path FROM split) s JOIN rules
    ON (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)
), judged AS (
  SELECT page_id, s.host, s.path, rule, rule_verdict
  FROM split s LEFT JOIN (SELECT * FROM fitting WHERE place = 1) f ON s.host = f.host AND s.path = f.path
), links AS (
  SELECT DISTINCT src, dst FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(
      html, '(?i)href\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^"''\\s>/?#]+)', 1)), {AZ}) AS dst
    FROM split) WHERE src <> dst AND src <> ''
), edges AS (
  SELECT src, dst, count(*) OVER (PARTITION BY src) AS n_out, count(*) OVER (PARTITION BY dst) AS n_in FROM links
), hosts AS (
  SELECT host, count(*) FILTER (rule_verdict = 'allow') AS a, count(*) FILTER (rule_verdict = 'block') AS b
  FROM judged GROUP BY host
), s0 AS (
  SELECT host, {1 - damping} * a / greatest(sum(a) OVER (), 1) AS t,
         {1 - damping} * b / greatest(sum(b) OVER (), 1) AS d FROM hosts
){steps}
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN d > t THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN s{rounds} USING (host)
"""


def license_scan(templates: dict[str, str], percent: int = 80) -> str:
    """Exact containment of every template in every document, without retrieval."""
    listed = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in templates.items())
    apart = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def shingles(key: str, text: str, table: str) -> str:
        words = f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), {AZ}), '{apart}'), lambda w: w <> '')"
        return (f"SELECT {key}, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s FROM "
                f"(SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT {key}, {words} AS w FROM {table}))")

    return f"""
WITH templates(license, body) AS (VALUES {listed}),
wanted AS (SELECT DISTINCT license, s FROM ({shingles('license', 'body', 'templates')})),
sizes AS (SELECT license, count(*) AS n_template FROM wanted GROUP BY license),
own AS (SELECT doc_id, s, min(place) AS place FROM ({shingles('doc_id', 'text', 'documents')}) GROUP BY doc_id, s)
SELECT doc_id, license, count(*) AS n_shared, any_value(n_template) AS n_template, min(place) AS first_word
FROM own JOIN wanted USING (s) JOIN sizes USING (license)
GROUP BY doc_id, license HAVING 100 * count(*) >= {percent} * any_value(n_template)
"""


#: Every 400-byte string by its place, counted; then runs of covered bytes.
SUBSTRINGS = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT r, unnest(range(0, len(h) // 2 - 399)) AS i FROM docs WHERE len(h) >= 800
), strings AS (
  SELECT p.r, i, md5_number(substr(h, 2 * i + 1, 800)) AS s FROM places p JOIN docs USING (r)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM strings) WHERE c > 1
), runs AS (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS head FROM again
), numbered AS (
  SELECT r, i, sum(head) OVER (PARTITION BY r ORDER BY i) AS g FROM runs
), spans AS (
  SELECT r, g, min(i) AS lo, max(i) + 400 AS hi FROM numbered GROUP BY r, g
), cuts AS (
  SELECT r, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his, sum(hi - lo) AS n_removed,
         count(*) AS n_spans FROM spans GROUP BY r
), pieces AS (
  SELECT doc_id, h, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         coalesce(los, []) AS los, coalesce(his, []) AS his FROM docs LEFT JOIN cuts USING (r)
)
SELECT doc_id, len(h) // 2 AS n_bytes, n_removed::BIGINT AS n_removed, n_spans,
       len(h) // 2 - n_removed::BIGINT AS kept_bytes, n_spans > 0 AS has_repeats,
       sha256(unhex(array_to_string(list_transform(range(0, len(los) + 1), lambda k:
         substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * his[k] + 1 END,
                2 * ((CASE WHEN k = len(los) THEN len(h) // 2 ELSE los[k + 1] END)
                     - (CASE WHEN k = 0 THEN 0 ELSE his[k] END)))), ''))) AS kept_sha256
FROM pieces
"""


#: Every query row against every other row.
TOP_K = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.r <> x.r WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: Every conversation's every beginning by the digest of its turns; subtrees as pairs of beginnings of one conversation.
TRIE = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) r(i)
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     sha256(coalesce(text, ''))) - 1 AS place,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), drawn AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT conv_id, count(*) AS own FROM turns GROUP BY conv_id), crc_table
), known AS (
  SELECT d.*, least(d.h, coalesce(b.own, 0)) AS taken FROM drawn d LEFT JOIN drawn b ON b.conv_id = d.base
), rebuilt AS (
  SELECT k.conv_id, place, turn, chars FROM known k JOIN turns t ON t.conv_id = k.base AND place < k.h
  UNION ALL
  SELECT k.conv_id, place - h + taken, turn, chars FROM known k JOIN turns t ON t.conv_id = k.conv_id AND place >= h
), whole AS (
  SELECT conv_id, coalesce(list(turn ORDER BY place) FILTER (turn IS NOT NULL), []) AS l,
         list(chars ORDER BY place) FILTER (turn IS NOT NULL) AS c
  FROM known LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), begun AS (
  SELECT conv_id, d, sha256(array_to_string(l[1:d], ',')) AS node, d = len(l) AS ends, coalesce(c[d], 0) AS chars,
         CASE WHEN d > 0 THEN sha256(array_to_string(l[1:d - 1], ',')) END AS parent
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM begun GROUP BY node
), kids AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node, b.node AS under FROM begun a JOIN begun b ON a.conv_id = b.conv_id AND a.d <= b.d
), sums AS (
  SELECT below.node, sum(n.saved) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM below JOIN nodes n ON n.node = under LEFT JOIN kids ON kids.parent = under GROUP BY below.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.node = n.node LEFT JOIN nodes p ON p.node = n.parent
LEFT JOIN kids ON kids.parent = n.node
"""
