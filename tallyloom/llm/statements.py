"""SQL of the registered queries, for a second engine."""

from __future__ import annotations

import re
from functools import reduce

from tallyloom.llm.chat_format import CLOSE, CONT, CONTROL, OPEN, SEP
from tallyloom.llm.queries import CONTROL_TEXT
from tallyloom.llm.url_lists import BLOCKED_WORDS, globs


def _escaped(column: str) -> str:
    breaks = [("\\", "\\\\"), *((c, f"{c[0]}\\{c[1:]}") for c in CONTROL)]
    return reduce(lambda out, pair: f"replace({out}, '{pair[0]}', '{pair[1]}')", breaks, column)


def chat_format() -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')
), sides AS (
  SELECT *, lag(role) OVER said IS NOT DISTINCT FROM role AS goes_on
  FROM turns WINDOW said AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length({_escaped('text')})
           + CASE WHEN goes_on THEN {len(CONT)}
                  ELSE {len(OPEN) + len(SEP) + len(CLOSE)} + length({_escaped('role')}) END)::BIGINT
         AS formatted_chars
FROM sides GROUP BY conv_id
"""


def url_filter() -> str:
    rules = [("block", f"*{word}*", f"[^/]*{re.escape(word)}[^/]*(/.*)?") for word in BLOCKED_WORDS]
    for verdict, pattern in globs():
        parts = [[re.escape(name) for name in part.split("*")] for part in pattern.split("**")]
        rules.append((verdict, pattern, ".*".join("[^/]*".join(part) for part in parts)))
    listed = ",\n         ".join(
        f"({place}, '{verdict}', '{name}', '(?s){expression}')" for place, (verdict, name, expression) in enumerate(rules)
    )
    return f"""
WITH rests AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), parts AS (
  SELECT page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM cut
), site_rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT page_id,
         arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts
  JOIN site_rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
), globs(place, verdict, name, expression) AS (
  VALUES {listed}
), others AS (
  SELECT page_id, name AS other, globs.verdict AS other_verdict
  FROM parts JOIN globs ON regexp_full_match(host || path, expression)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(name) DESC, globs.verdict <> 'block', place) = 1
)
SELECT page_id, host, path, rule,
       coalesce(verdict, other_verdict, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN other END AS other_rule
FROM parts LEFT JOIN fits USING (page_id) LEFT JOIN others USING (page_id)
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         [x FOR x IN string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
         END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT node, b FROM reached JOIN edges ON other = a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reached GROUP BY node) USING (doc_id)
"""


#: 40 hexadecimal digits are 8 groups of 20 bits, each four letters of base32.
WARC = """
WITH sums AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digits FROM pages
), groups AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM sums
), letters AS (
  SELECT *, [('0x' || substr(digits, 5 * i + 1, 5))::BIGINT FOR i IN range(8)] AS bits FROM groups
)
SELECT page_id,
       strlen(payload)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((bits[1 + i // 4] >> (15 - 5 * (i % 4))) & 31), 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM letters
"""

SPELLING = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS numbers(i))
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]{7,}')) AS run
        FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                               ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END
                          FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')]) AS b
  FROM runs
), sums AS (
  SELECT run, n, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM sums)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM words a JOIN cuts b ON a.word = b.cut
  UNION SELECT b.word, a.word FROM words a JOIN cuts b ON a.word = b.cut
), best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS most, arg_min(b, (-n, b)) AS partner
  FROM pairs JOIN words ON b = word GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN most >= 10 * n THEN partner END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains(word, place, steps) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL
  SELECT chains.word, form, steps + 1 FROM chains JOIN formed ON place = formed.word WHERE form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(place, steps) AS root FROM chains GROUP BY word) USING (word)
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p
JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


STATEMENTS: dict[str, str] = {
    "op1_chat_format": chat_format(),
    "op3_near_dedup": NEAR_DUPLICATES,
    "op8_url_filter": url_filter(),
    "op11_warc": WARC,
    "op12_spelling": SPELLING,
    "op13_hard_negatives": HARD_NEGATIVES,
}
