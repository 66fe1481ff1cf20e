"""SQL twin of the quality rules: the same robust estimate as one chain of DuckDB table expressions."""

from __future__ import annotations

from . import outliers as rules

_WORD = r"[^\x20\x09-\x0D]"
_N = range(len(rules.NAMES))
_FLOORS = list(rules.FLOORS.values())


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _distance() -> str:
    """Squared distance of the row's x0.. by the centre m0.. and factor l00.. beside them."""
    solved: list[str] = []
    for i in _N:
        y = f"(x{i} - m{i})"
        for j in range(i):
            y = f"({y} - l{i}{j} * {solved[j]})"
        solved.append(f"({y} / l{i}{i})")
    total = f"{solved[0]} * {solved[0]}"
    for y in solved[1:]:
        total = f"({total} + {y} * {y})"
    return total


def _factor(name: str, rows: str, scale: float) -> str:
    """Table ``name`` (g, m*, l**) from the rows (g, x*) of table ``rows``."""
    sums = [f"sum(x{i}) AS s{i}" for i in _N] + [f"sum(x{i} * x{j}) AS p{i}{j}" for i, j in rules.PAIRS]
    columns = [f"CAST(s{i} AS DOUBLE) / n AS m{i}" for i in _N]
    for i, j in rules.PAIRS:
        floor = float(_FLOORS[i] ** 2) if i == j else 0.0
        rest = f"((CAST(p{i}{j} AS DOUBLE) / n - m{i} * m{j}) * {_number(scale)} + {_number(floor)})"
        for k in range(j):
            rest = f"({rest} - l{i}{k} * l{j}{k})"
        columns.append(f"sqrt(greatest({rest}, {_number(1.0)})) AS l{i}{j}" if i == j else f"{rest} / l{j}{j} AS l{i}{j}")
    return f"""{name}_sums AS (SELECT g, CAST(count(*) AS DOUBLE) AS n, {', '.join(sums)} FROM {rows} GROUP BY g),
{name} AS (SELECT g, {', '.join(columns)} FROM {name}_sums)"""


def oracle() -> str:
    x = {"len": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup": ("n_dup_lines", "n_words"),
         "repeat": ("n_repeat_words", "n_words"), "upper": ("n_upper", "word_chars")}
    grid = ", ".join(
        f"CAST(floor(sqrt(CAST({x[n][0]} AS DOUBLE) / CAST({x[n][1]} AS DOUBLE)) * {rules.GRID} + 0.5) AS BIGINT) AS x{i}" for i, n in enumerate(rules.NAMES))
    start = [f"CAST(quantile_disc(x{i}, 0.5) AS DOUBLE) AS m{i}" for i in _N]
    start += [f"{_number(float(_FLOORS[i]) if i == j else 0.0)} AS l{i}{j}" for i, j in rules.PAIRS]
    steps, est, xs = [], "est0", ", ".join(f"x{i}" for i in _N)
    for k in range(rules.STEPS):
        steps += [
            f"near{k} AS (SELECT r.g, {xs}, CAST(least(floor(sqrt({_distance()}) * 100), 100000) AS BIGINT) AS r FROM rows r JOIN {est} USING (g))",
            f"limit{k} AS (SELECT g, quantile_disc(r, {rules.H_SHARE}) AS lim FROM near{k} GROUP BY g)",
            f"inner{k} AS (SELECT g, {xs} FROM near{k} JOIN limit{k} USING (g) WHERE r <= lim)",
            _factor(f"est{k + 1}", f"inner{k}", rules.consistency(rules.H_SHARE)),
        ]
        est = f"est{k + 1}"
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    coalesce('=' || lang, '-') || chr(9) || coalesce('=' || source, '-') AS g FROM documents),
words AS (SELECT *, regexp_extract_all(text, '{_WORD}+') AS w,
    list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '{_WORD}')) AS lines FROM texts),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, t) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(3) s(k) GROUP BY rid),
counts AS (SELECT rid, doc_id, g, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS n_upper
  FROM words LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words AS base_failed FROM counts),
rows AS (SELECT rid, g, {grid} FROM judged WHERE NOT base_failed),
est0 AS (SELECT g, {', '.join(start)} FROM rows GROUP BY g),
{(',' + chr(10)).join(steps)},
inside AS (SELECT r.g, {xs} FROM rows r JOIN {est} USING (g) WHERE {_distance()} <= {_number(rules.REWEIGHT)}),
{_factor('last', 'inside', 1.0)},
sized AS (SELECT g, count(*) AS many FROM rows GROUP BY g),
out AS (SELECT rid, {_distance()} > {_number(rules.CUTOFF)} AND many >= {rules.MIN_GROUP} AS rejected
  FROM rows r JOIN last USING (g) JOIN sized USING (g))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM judged LEFT JOIN out USING (rid)"""
