"""SQL twin of the conversation trie: prefixes as lists of turns, subtrees by comparing them."""

from __future__ import annotations

from .merkle_sql import crc32


def oracle() -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}}
    ORDER BY turn NULLS FIRST, sha256(CAST(octet_length(encode(role)) AS VARCHAR) || ':' || role || text)) AS seq
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.seq[:o.h], []), o.seq[o.h + 1:]) AS seq
  FROM (SELECT *, {crc32('conv_id')} % 6 AS h FROM own) o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
paths AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt),
prefixes AS (SELECT conv_id, depth, seq[:depth] AS prefix, len(seq) = depth AS final FROM paths),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (final), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(prefix[depth].text) END AS saved
  FROM prefixes GROUP BY depth, prefix),
children AS (SELECT depth - 1 AS depth, prefix[:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix),
sums AS (
  SELECT a.depth, a.conv_id, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM counted a JOIN counted b ON b.depth >= a.depth AND b.prefix[:a.depth] = a.prefix GROUP BY a.depth, a.conv_id)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.depth = n.depth AND s.conv_id = n.conv_id
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[:n.depth - 1]"""
