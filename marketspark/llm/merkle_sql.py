"""SQL twin of the Merkle manifest: every level of the trees as a table of its own."""

from __future__ import annotations

#: Levels written out, enough for 16**4 rows of a source and 16**4 sources.
LEVELS = 4
#: crc32 of a number's decimal text; the constants are the polynomial's.
CRC32 = """(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split({x}, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda h, c: list_reduce(list_concat([xor(h, c)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), 4294967295))"""


def crc32(number: str) -> str:
    return CRC32.format(x=f"CAST({number} AS VARCHAR)")


def _part(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_part, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, nodes: str) -> list[str]:
    """Tables {name}k of each level's runs over ``nodes`` (t, i, d, n): whole runs as lists, and what they hash to."""
    out = [f"{name}0 AS ({nodes})"]
    for k in range(LEVELS):
        out.append(f"""{name}r{k} AS (SELECT t, i // 16 AS i, list(d ORDER BY i) AS run, max(n) AS n FROM {name}{k} WHERE n > 1 GROUP BY t, i // 16)""")
        out.append(f"""{name}{k + 1} AS (SELECT t, i, sha256(array_to_string(run, '')) AS d, (n + 15) // 16 AS n FROM {name}r{k})""")
    return out


def _climb(rows: str, name: str, tree: str) -> list[str]:
    """Tables of ``rows`` (t, i, own, sib, ...) one level higher each: siblings added and the own digest folded."""
    out, last = [], rows
    for k in range(LEVELS):
        out.append(f"""{name}{k} AS (
  SELECT x.* EXCLUDE (i, own, sib), x.i // 16 AS i,
    CASE WHEN r.run IS NULL THEN own ELSE sha256(array_to_string(run[:x.i % 16], '') || own || array_to_string(run[x.i % 16 + 2:], '')) END AS own,
    sib || coalesce(array_to_string(run[:x.i % 16], '') || array_to_string(run[x.i % 16 + 2:], ''), '') AS sib
  FROM {last} x LEFT JOIN {tree}r{k} r ON r.t IS NOT DISTINCT FROM x.t AND r.i = x.i // 16)""")
        last = f"{name}{k}"
    return out


def oracle() -> str:
    roots = " UNION ALL ".join(f"SELECT t, d FROM s{k} WHERE n = 1" for k in range(LEVELS + 1))
    tops = " UNION ALL ".join(f"SELECT d FROM p{k} WHERE n = 1" for k in range(LEVELS + 1))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = [
        f"l AS (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {crc32('doc_id')} % 5 = 0 THEN {_leaf(lowered)} END AS claim FROM documents)",
        """q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l)""",
        *_tree("s", "SELECT source AS t, i, leaf AS d, n FROM q"),
        f"roots AS ({roots})",
        "ranks AS (SELECT t AS source, d, row_number() OVER (ORDER BY encode(t) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM roots)",
        *_tree("p", "SELECT 0 AS t, i, d, n FROM ranks"),
        f"top AS ({tops})",
        "w AS (SELECT doc_id, leaf, source AS t, i, coalesce(claim, leaf) AS own, '' AS sib FROM q)",
        *_climb("w", "u", "s"),
        f"v AS (SELECT u.doc_id, u.leaf, ranks.d AS subroot, 0 AS t, ranks.i, u.own, u.sib FROM u{LEVELS - 1} u JOIN ranks ON ranks.source IS NOT DISTINCT FROM u.t)",
        *_climb("v", "z", "p"),
    ]
    return f"""WITH {', '.join(tables)}
SELECT doc_id, leaf, subroot, top.d AS root, sha256(sib) AS proof_sha256, own AS folded_root, own = top.d AS verified
FROM z{LEVELS - 1} JOIN top ON true"""
