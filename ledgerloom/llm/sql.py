"""The operators' queries in DuckDB SQL, where SQL can say what they compute."""

from __future__ import annotations

import math

from ledgerloom.llm import chat, link_rank

_UPPER, _LOWER = f"'{link_rank.UPPER}'", f"'{link_rank.LOWER}'"

# All pairs that share a shingle, then all that is reachable over links.
NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
           lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) END AS s
  FROM words
), kinds AS (
  SELECT min(doc_id) AS id, any_value(s) AS s FROM (SELECT doc_id, list_sort(s) AS s FROM sets)
  WHERE len(s) > 0 GROUP BY s
), rows AS (
  SELECT id, len(s) AS n, unnest(s) AS shingle FROM kinds
), links AS (
  SELECT a.id AS a, b.id AS b FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached(id, other) AS (
  SELECT id, id FROM kinds UNION SELECT reached.id, links.b FROM reached JOIN links ON reached.other = links.a
), labels AS (
  SELECT kinds.s, min(other) AS component FROM kinds JOIN reached USING (id) GROUP BY kinds.id, kinds.s
)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component, doc_id) AS component_id,
       doc_id = coalesce(component, doc_id) AS kept
FROM sets LEFT JOIN labels ON list_sort(sets.s) = labels.s
"""


def _host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({_rest(url)}, '^[^/?#]*'), ''), {_UPPER}, {_LOWER})"


def _rest(url: str) -> str:
    return f"(CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) END)"


def _fit(value: int) -> str:
    rules = sorted(link_rank.RULES, key=lambda r: (-len(r[0]), r[0]))
    tests = []
    for rule in rules:
        domain, slash, path = rule[0].partition("/")
        host = f"(host = '{domain}' OR ends_with(host, '.{domain}'))"
        tests.append(f"WHEN {host} AND starts_with(path, '{slash + path}') THEN '{rule[value]}'")
    return f"CASE {' '.join(tests)} END"


# Rounds that leave less than a part of 1e-15 of all rank on its way, whatever the operator
# does.
_ROUNDS = math.ceil(math.log(1e-15) / math.log(link_rank.DAMPING))

LINK_RANK = rf"""
WITH RECURSIVE places AS (
  SELECT page_id, html, {_host("url")} AS host,
         coalesce(regexp_extract({_rest("url")}, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), judged AS (
  SELECT page_id, html, host, path, {_fit(0)} AS rule, {_fit(1)} AS verdict FROM places
), seeds AS (
  SELECT kind, host, count(*) FILTER (WHERE verdict = of) / count(*) AS seed
  FROM judged, (VALUES ('trust', 'allow'), ('distrust', 'block')) kinds(kind, of)
  WHERE host <> '' GROUP BY kind, host HAVING count(*) FILTER (WHERE verdict = of) > 0
), hrefs AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS href
  FROM judged
), links AS (
  SELECT src, CASE WHEN starts_with(href, '//') THEN {_host("concat('x:', href)")}
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {_host("href")}
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN '' ELSE src END AS dst FROM hrefs
), counted AS (
  SELECT src, dst, count(*) AS n FROM links WHERE src <> '' AND dst <> '' GROUP BY src, dst
), edges AS (
  SELECT 'trust' AS kind, src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS share FROM counted
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM counted
), moving(k, kind, host, rank) AS (
  SELECT 0, kind, host, seed * (1 - {link_rank.DAMPING}) FROM seeds
  UNION ALL
  SELECT moving.k + 1, moving.kind, b, sum(rank * share) * {link_rank.DAMPING}
  FROM moving JOIN edges ON moving.kind = edges.kind AND moving.host = a
  WHERE moving.k < {_ROUNDS} GROUP BY moving.k, moving.kind, b
), ranks AS (
  SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust,
         coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust
  FROM moving GROUP BY host
)
SELECT page_id, judged.host, path, rule, coalesce(verdict, CASE
    WHEN coalesce(distrust, 0) - {link_rank.MARGIN} * coalesce(trust, 0) > {link_rank.EQUAL} * coalesce(distrust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN ranks ON judged.host = ranks.host
"""


def _escaped(text: str) -> str:
    for raw, told in chat.ESCAPES:
        text = f"replace({text}, '{raw}', '{told}')"
    return text


_MARKED = r"\### Assistant: </turn> ok"

CHAT_FORMAT = rf"""
WITH turns AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own,
         turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, NULL, 0, 'user', '{_MARKED}'), (-7, NULL, 1, 'assistant', '{_MARKED}')
), talks AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         list(role ORDER BY turn, role, text) AS roles,
         sum(length({_escaped("text")}) + length(replace({_escaped("role")}, '>', '\g'))
             + {len(chat.OPEN) + 2 + len(chat.CLOSE)}) AS chars
  FROM turns GROUP BY conv_id, own
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars,
       CASE WHEN roles = ['user', 'assistant'] THEN 'prompt'
            WHEN roles = ['system', 'user', 'assistant'] THEN 'instruction_input'
            ELSE 'messages' END AS layout
FROM talks
"""

# Every document's terms counted one by one.
LEXICAL_SEARCH = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), corpus AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM texts WHERE len(terms) > 0
), counted AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM texts) GROUP BY r, term
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * any_value(n_docs) + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, corpus WHERE term IN (SELECT term FROM wanted) GROUP BY term
), scored AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN texts USING (r), corpus
  GROUP BY item_id, r
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored JOIN texts USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Every window of thirteen words with the smallest document that has it.
SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS told
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts)
), lowest AS (
  SELECT told, min(doc_id) AS least FROM windows GROUP BY told
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS place FROM windows JOIN lowest USING (told) WHERE least < doc_id
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS words, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts) ANTI JOIN gone USING (r, place)
  GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
