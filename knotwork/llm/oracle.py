"""SQL for the queries that SQL can express in full."""

from __future__ import annotations

from .quality import ERROR, LADDER, RISK, SIGNALS, ladder
from .secrets import BASE, RULES

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def substring_dedup() -> str:
    return f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w WHERE len(ws) >= 20),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM k WHERE n > 1),
flat AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
left_over AS (SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.j) AS kept, count(*) AS n FROM flat f LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.j = f.j WHERE g.j IS NULL GROUP BY f.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256 FROM w LEFT JOIN left_over l ON l.doc_id = w.doc_id"""


def secret_scans() -> str:
    parts = []
    for rank, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, k, list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda x: length(x))), 0) AS s, length(found[k]) AS n
FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found, regexp_extract_all(text, '{pattern}', {r.group}) AS part FROM t)) WHERE length(part[k]) >= {r.least}""")
    counts = ", ".join(f"CAST(count(x.kind) FILTER (x.kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    line = "x.kind || ':' || CAST(x.s AS BIGINT) || ':' || CAST(x.s + x.n AS BIGINT), ',' ORDER BY x.s, x.rank"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), x AS ({" UNION ALL ".join(parts)})
SELECT t.doc_id, {counts}, sha256(coalesce(string_agg({line}) FILTER (x.rank < {len(BASE)}), '')) AS base_sha256, coalesce(string_agg({line}), '') AS spans FROM t LEFT JOIN x ON x.doc_id = t.doc_id GROUP BY t.doc_id"""


def quality_rules() -> str:
    ratio = lambda a, b: f"{a} / CAST(greatest({b}, 1) AS DOUBLE)"
    signal = {"symbols_a_word": ratio("n_symbols", "n_words"), "other_share": ratio("n_other", "word_chars"), "upper_share": ratio("n_upper", "word_chars"), "repeat_share": ratio("n_repeat_words", "n_words"), "dup_line_share": ratio("n_dup_lines", "n_lines"), "word_length": ratio("word_chars", "n_words")}
    rungs = " UNION ALL ".join(f"SELECT '{s}' AS signal, unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in ladder(s))}]) AS cutoff, unnest(range(0, {LADDER})) AS rung" for s in SIGNALS)
    values = " UNION ALL ".join(f"SELECT doc_id, stratum, '{s}' AS signal, {v} AS v FROM m WHERE NOT base_failed" for s, v in signal.items())
    p = RISK / len(SIGNALS)
    return rf"""WITH t AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text, {WORDS} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
tri AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM t WHERE len(ws) >= 3),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM tri),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice WHERE n > 1) GROUP BY doc_id),
m0 AS (SELECT t.doc_id, t.stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
 length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper, length(text) - length(regexp_replace(text, '[!-/:-@\[-`{{-~]', '', 'g')) AS n_other, len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m0),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
v AS ({values}), gv AS (SELECT v.* FROM v JOIN good ON good.doc_id = v.doc_id), r AS ({rungs}),
g AS (SELECT stratum, r.signal, r.rung, r.cutoff, count(*) AS n, count(*) FILTER (gv.v > r.cutoff) AS k FROM gv JOIN r ON r.signal = gv.signal GROUP BY stratum, r.signal, r.rung, r.cutoff),
f AS (SELECT *, CASE WHEN k >= n * {p!r} THEN 1e0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) END > {ERROR}e0 / ((SELECT count(DISTINCT coalesce(stratum, '')) FROM g) * {len(SIGNALS)}) AS fails FROM g),
h AS (SELECT *, max(CAST(fails AS INTEGER)) OVER (PARTITION BY stratum, signal ORDER BY rung DESC) AS ended FROM f),
c AS (SELECT stratum, signal, min(cutoff) AS cutoff FROM h WHERE ended = 0 GROUP BY stratum, signal),
bad AS (SELECT DISTINCT v.doc_id FROM v JOIN c ON c.stratum IS NOT DISTINCT FROM v.stratum AND c.signal = v.signal AND v.v > c.cutoff)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept FROM m LEFT JOIN bad ON bad.doc_id = m.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op2_secret_scans": secret_scans(), "op6_quality_rules": quality_rules(), "op9_substring_dedup": substring_dedup()}
