"""SQL that says the same as an operator's query, where SQL can."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

LINE_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents
), w AS (
  SELECT *, [x FOR x IN string_split_regex(body, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
    [x FOR x IN string_split(body, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), win AS (
  SELECT rid, i, array_to_string(words[i : i + 7], ' ') AS said FROM w, unnest(range(1, len(words) - 6)) AS t(i) WHERE len(words) >= 8
), twice AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, said) > 1
), steps AS (
  SELECT rid, least(8, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 8)) AS fresh FROM twice
), repeated AS (
  SELECT rid, sum(fresh) AS n FROM steps GROUP BY rid
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    [x FOR x IN lines
     IF regexp_matches(x, '[.!?…。！？]["\''”’»)\]]*([\x20\x09-\x0D]|$)')
     AND 100 * (length(x) - length(regexp_replace(x, '[#*$%&|<>!]', '', 'g'))) <= 50 * len([y FOR y IN string_split_regex(x, '[\x20\x09-\x0D]+') IF y <> ''])
     AND NOT regexp_matches(x, '(\||»|›|>>).*(\||»|›|>>)|(\||»|›|>>)[\x20\x09-\x0D]*$')
     AND NOT regexp_matches(lower(x), 'all rights reserved|cookie|privacy policy|terms of (use|service)|click here|sign up|log in|subscribe|javascript|lorem ipsum|read more|share (this|on)|back to top|skip to')
    ] AS good
  FROM w LEFT JOIN repeated USING (rid)
), judged AS (
  SELECT * EXCLUDE (good), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    length(regexp_replace(array_to_string(good, ''), '[\x20\x09-\x0D]', '', 'g')) AS kept_chars
  FROM counted
)
SELECT *, NOT base_failed AND 100 * kept_chars >= 50 * word_chars AS kept FROM judged
"""

#: Unsigned CRC-32 (reflected polynomial 0xEDB88320) of a column of short ASCII texts.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split({text}, '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]),
        lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (
    SELECT row_number() OVER () AS rid, doc_id, source, {_leaf("text")} AS leaf, {_leaf("changed")} AS found
    FROM (SELECT *, CASE WHEN {CRC32.format(text="doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents)
  )
), nodes AS (
  SELECT source, 0 AS level, pos, leaf AS digest, n FROM d
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 2) // 3) FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 2) // 3) FROM upper WHERE n > 1 GROUP BY level, pos // 3
), beside AS (
  SELECT source, level, pos, 0 AS high, coalesce(string_agg(digest, '') OVER l, '') AS lft, coalesce(string_agg(digest, '') OVER r, '') AS rgt
  FROM nodes WHERE n > 1
  WINDOW l AS (PARTITION BY source, level, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         r AS (PARTITION BY source, level, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
  UNION ALL
  SELECT NULL, level, pos, 1, coalesce(string_agg(digest, '') OVER l, ''), coalesce(string_agg(digest, '') OVER r, '')
  FROM upper WHERE n > 1
  WINDOW l AS (PARTITION BY level, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         r AS (PARTITION BY level, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), path AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY high, level) - 1 AS step, lft, rgt
  FROM (
    SELECT rid, high, level, lft, rgt FROM d JOIN beside b ON high = 0 AND d.source IS NOT DISTINCT FROM b.source AND b.pos = d.pos // (3 ** level)::BIGINT
    UNION ALL
    SELECT rid, high, level, lft, rgt FROM d JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source
    JOIN beside b ON high = 1 AND b.pos = s.pos // (3 ** level)::BIGINT
  )
), folded AS (
  SELECT rid, 0 AS step, found AS digest FROM d
  UNION ALL
  SELECT rid, step + 1, sha256(lft || digest || rgt) FROM folded JOIN path USING (rid, step)
), ends AS (
  SELECT rid, arg_max(digest, step) AS folded_root FROM folded GROUP BY rid
), proofs AS (
  SELECT rid, string_agg(lft || rgt, '' ORDER BY step) AS said FROM path GROUP BY rid
)
SELECT doc_id, leaf, s.digest AS subroot, u.digest AS root, sha256(coalesce(said, '')) AS proof_sha256, folded_root, folded_root = u.digest AS verified
FROM d JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source JOIN upper u ON u.n = 1 JOIN ends USING (rid) LEFT JOIN proofs USING (rid)
"""

TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS said_by, coalesce(text, '') AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations
), c AS (
  SELECT conv_id, {CRC32.format(text="conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations)
), both_parts AS (
  SELECT c.conv_id, pos, said_by, said FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL
  SELECT c.conv_id, pos, said_by, said FROM c JOIN t USING (conv_id) WHERE pos > h
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, length(said) AS size, string_agg(sha256(strlen(said_by) || ':' || said_by || said), '') OVER w AS node
  FROM both_parts WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c
), marked AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM paths
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, max(size) AS size, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM marked GROUP BY node
), children AS (
  SELECT left(node, length(node) - 64) AS node, count(*) AS n FROM nodes WHERE node <> '' GROUP BY 1
), weighed AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * size AS saved FROM nodes LEFT JOIN children USING (node)
), below AS (
  SELECT p.node, sum(CASE WHEN p.conv_id = w.conv_id THEN saved ELSE 0 END) OVER d AS saved,
    sum(CASE WHEN p.conv_id = w.conv_id AND n_children = 0 THEN 1 ELSE 0 END) OVER d AS leaves
  FROM paths p JOIN weighed w USING (node) WINDOW d AS (PARTITION BY p.conv_id ORDER BY p.depth DESC)
), sums AS (
  SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaves)::BIGINT AS n_leaves FROM below GROUP BY node
)
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ends) AS ends_sha256
FROM weighed w JOIN sums USING (node) LEFT JOIN weighed u ON w.node <> '' AND u.node = left(w.node, length(w.node) - 64)
"""

ORACLES = {"op2_exact_dedup": EXACT_DEDUP, "op6_line_rules": LINE_RULES, "op12_merkle_manifest": MERKLE, "op13_prefix_trie": TRIE}
