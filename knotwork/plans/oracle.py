"""The queries of `queries.py` as DuckDB SQL, put together from common table expressions."""

from __future__ import annotations

from ..functions.text import ADDRESS_STOP, BUSINESS_STOP
from ..operators.features import ADDRESS, CROSS, FEATURES, NAME
from ..operators.matching import PREFIXES, RULE
from ..operators.metrics import TAUS
from ..operators.union import STRATEGIES
from .queries import CAP, RULE_TAU, SMALL_CAP, SMALL_K, K


def words(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def normal(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN CAST([] AS VARCHAR[]) ELSE list_distinct(string_split({x}, ' ')) END"


def grams(x: str, n: int) -> str:
    c = rf"regexp_replace({x}, '\s+', '', 'g')"
    return f"CASE WHEN {c} = '' THEN CAST([] AS VARCHAR[]) WHEN length({c}) <= {n} THEN [{c}] ELSE list_distinct(list_transform(range(1, length({c}) - {n} + 2), lambda i: substring({c}, i, {n}))) END"


def postal(x: str) -> str:
    codes = rf"list_transform(regexp_extract_all({x}, '\b[A-Za-z]{{1,2}}\d{{1,2}}[A-Za-z]?\s*\d[A-Za-z]{{2}}\b'), lambda m: lower(regexp_replace(m, '\s+', '', 'g')))"
    return rf"list_distinct(list_concat(regexp_extract_all({x}, '\b\d{{3,6}}\b'), {codes}))"


def line(x: str) -> str:
    return f"array_to_string(list_sort({x}), ',')"


NAME_TERMS = f"list_filter(name_tokens, lambda t: length(t) > 1 AND t NOT IN {words(BUSINESS_STOP)})"
ADDR_TERMS = f"list_filter(addr_tokens, lambda t: length(t) >= 3 AND t NOT IN {words(ADDRESS_STOP)})"
COMPOSITE = f"list_distinct(list_concat(name_tokens, list_filter(addr_tokens, lambda t: length(t) >= 4 AND t NOT IN {words(BUSINESS_STOP)})))"

RECORDS = f"""d AS (SELECT doc_id, n_chars, string_split({normal("text")}, ' ') AS w, lang FROM documents),
raw AS (SELECT 'S' || CAST(doc_id % 3 + 1 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS id, 'S' || CAST(doc_id % 3 + 1 AS VARCHAR) AS src, doc_id AS ord, n_chars,
  array_to_string(w[1:4], ' ') AS norm_name, array_to_string(w[5:12], ' ') AS norm_addr, upper(trim(coalesce(lang, ''))) AS country FROM d),
e0 AS (SELECT *, {tokens("norm_name")} AS name_tokens, {tokens("norm_addr")} AS addr_tokens, {grams("norm_name", 3)} AS char3, {grams("norm_name", 4)} AS char4, {grams("norm_addr", 3)} AS addr_char3, {postal("norm_addr")} AS postal FROM raw),
e AS (SELECT *, list_distinct(list_concat(name_tokens, addr_tokens)) AS comb FROM e0),
qs AS (SELECT * FROM e WHERE src = 'S1'), ts AS (SELECT * FROM e WHERE src <> 'S1')"""
NUMBERED = RECORDS + """,
en AS (SELECT * REPLACE (list_distinct(list_concat(addr_tokens, [CAST(n_chars AS VARCHAR)])) AS addr_tokens,
  CASE WHEN length(CAST(n_chars AS VARCHAR)) BETWEEN 3 AND 6 THEN list_distinct(list_concat(postal, [CAST(n_chars AS VARCHAR)])) ELSE postal END AS postal) FROM e),
qn AS (SELECT * FROM en WHERE src = 'S1'), tn AS (SELECT * FROM en WHERE src <> 'S1')"""
TRUTH = "truth AS (SELECT qs.id AS q, ts.id FROM qs JOIN ts ON qs.norm_name = ts.norm_name AND qs.norm_addr = ts.norm_addr WHERE qs.norm_name <> '')"

INDEX = {"tokens": NAME_TERMS, "char3": "char3", "char4": "char4", "addr": f"list_distinct(list_concat(postal, {ADDR_TERMS}))"}
ASKED = {"tokens": f"list_filter(name_tokens, lambda t: t NOT IN {words(BUSINESS_STOP)})", "char3": "char3", "char4": "char4"}
FALL = {"tokens": "0.1e0", "char3": "0.05e0", "char4": "0.05e0", "addr": "0.1e0"}
FALLBACK = {"tokens": 2, "char3": 4, "char4": 4}


def weight(df: str, fall: str, head: str = "1e0") -> str:
    return f"{head} / (1e0 + {fall} * greatest(1, {df}))"


def postings(kind: str, p: str = "", ts: str = "ts") -> str:
    return f"{p}p AS (SELECT src, country, id, ord, unnest({INDEX[kind]}) AS term FROM {ts}), {p}v AS (SELECT src, term, count(*) AS df FROM {p}p GROUP BY src, term), {p}known AS (SELECT DISTINCT src, country FROM {p}p), {p}there AS (SELECT DISTINCT src, country, term FROM {p}p)"


def counted(p: str, asked: str, more: str = "") -> str:
    """CTEs {p}a and {p}c: query terms with their scope, then those that are in it, with their df."""
    return f"""{p}x AS ({asked}),
{p}a AS (SELECT DISTINCT x.q, s.src, x.term, coalesce(k.country, '*') AS scope{more} FROM {p}x x CROSS JOIN (SELECT DISTINCT src FROM {p}p) s LEFT JOIN {p}known k ON k.src = s.src AND k.country = x.country),
{p}c AS (SELECT a.*, v.df FROM {p}a a JOIN {p}v v ON v.src = a.src AND v.term = a.term LEFT JOIN {p}there h ON h.src = a.src AND h.term = a.term AND h.country = a.scope WHERE a.scope = '*' OR h.term IS NOT NULL)"""


def ranked(p: str, k: int) -> str:
    """CTEs {p}m and {p}r from {p}g (q, src, term, scope, w): summed and ranked candidates."""
    return f"""{p}m AS (SELECT g.q, g.src, p.id, p.ord, round(sum(g.w), 12) AS score FROM {p}g g JOIN {p}p p ON p.src = g.src AND p.term = g.term WHERE g.scope = '*' OR p.country = g.scope GROUP BY g.q, g.src, p.id, p.ord),
{p}r AS (SELECT * FROM (SELECT q, src, id, ord, score, row_number() OVER (PARTITION BY q, src ORDER BY score DESC, ord, id) AS rank FROM {p}m) WHERE rank <= {k})"""


def by_terms(kind: str, k: int = K, p: str = "", qs: str = "qs", own: str | None = None, cap: int = CAP) -> str:
    asked = f"SELECT id AS q, country, unnest({own or ASKED[kind]}) AS term FROM {qs}"
    return f"""{postings(kind, p)},
{counted(p, asked)},
{p}f AS (SELECT *, max(CASE WHEN df <= {cap} THEN 1 ELSE 0 END) OVER (PARTITION BY q, src) AS fits, row_number() OVER (PARTITION BY q, src ORDER BY df, term) AS rarity FROM {p}c),
{p}g AS (SELECT q, src, term, scope, {weight("df", FALL[kind])} AS w FROM {p}f WHERE (fits = 1 AND df <= {cap}) OR (fits = 0 AND rarity <= {FALLBACK[kind]})),
{ranked(p, k)}"""


def by_address(k: int = K, p: str = "", qs: str = "qs", ts: str = "ts", cap: int = CAP) -> str:
    asked = f"SELECT id AS q, country, unnest(list_filter(addr_tokens, lambda t: t NOT IN {words(ADDRESS_STOP)})) AS term, 0 AS postal FROM {qs} UNION ALL SELECT id, country, unnest(postal), 1 FROM {qs}"
    return f"""{postings("addr", p, ts)},
{counted(p, asked, ", x.postal")},
{p}g AS (SELECT q, src, term, scope, CASE WHEN postal = 1 THEN {weight("df", "0.05e0", "3e0")} ELSE {weight("df", "0.1e0")} END AS w FROM {p}c WHERE postal = 1 OR df <= {cap}),
{ranked(p, k)}"""


def exact(p: str = "", k: int = K) -> str:
    return f"""{p}h AS (SELECT qs.id AS q, ts.src, ts.id, ts.ord, CASE WHEN qs.country <> '' AND qs.country = ts.country THEN 1 ELSE 0 END AS same FROM qs JOIN ts ON qs.norm_name = ts.norm_name WHERE qs.norm_name <> ''),
{p}r AS (SELECT q, src, id, ord, 1e0 AS score, row_number() OVER (PARTITION BY q, src ORDER BY ord, id) AS rank FROM (SELECT *, max(same) OVER (PARTITION BY q, src) AS here FROM {p}h) WHERE here = 0 OR same = 1 QUALIFY rank <= {k})"""


SHOW = "SELECT q, src, id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM r"


def first_seen(parts: list[tuple[str, int]], k: int) -> str:
    """A list for each query: (select of q, id, place by part), kept where first met, at most k."""
    every = " UNION ALL ".join(f"SELECT q, id, {i} AS part, rank AS place FROM ({s})" for i, (s, _) in enumerate(parts))
    return f"u AS (SELECT q, id, min(part * 1000000 + place) AS place FROM ({every}) GROUP BY q, id), n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY place) AS nth FROM u)"


LISTED = f"SELECT qs.id AS q, coalesce(l.c, '') AS candidates FROM qs LEFT JOIN (SELECT q, string_agg(id, ',' ORDER BY nth) AS c FROM n WHERE nth <= {K} GROUP BY q) l ON l.q = qs.id"


def single_tier(cte: str, half: int | None) -> str:
    limit = "" if half is None else f" AND rank <= {half}"
    parts = [(f"SELECT * FROM r WHERE src = '{s}'{limit}", 0) for s in ("S2", "S3")]
    return f"WITH {RECORDS}, {cte}, {first_seen(parts, K)} {LISTED}"


def exact_then(cte: str) -> str:
    """Exact names first, not capped; then from each source half of the places that are free then."""
    return f"""WITH {RECORDS}, {exact("x")}, {cte},
xs AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY src, rank) AS place FROM xr),
rem AS (SELECT qs.id AS q, {K} - (SELECT count(*) FROM xs WHERE xs.q = qs.id) AS free FROM qs),
add AS (SELECT r.q, r.id, CASE WHEN r.src = 'S2' THEN 100000 ELSE 200000 END + r.rank AS place FROM r JOIN rem ON rem.q = r.q WHERE free > 0 AND r.rank <= greatest(1, free // 2)),
u AS (SELECT q, id, min(place) AS place FROM (SELECT * FROM xs UNION ALL SELECT * FROM add) GROUP BY q, id),
n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY place) AS nth FROM u) {LISTED}"""


SHARES = {s: STRATEGIES[s].tiers for s in STRATEGIES}


def folded(strategy: str, k: int = K, cap: int = CAP, each: int | None = None, sources: tuple[str, ...] = ("S2", "S3"), halved: bool = True) -> str:
    """CTEs up to n (q, id, nth): the tiers of a strategy one after the other, exact names first, each filling its share of the places still free."""
    each = each or k
    tier = lambda t, p: by_address(each, p, cap=cap) if t == "addr" else by_terms(t, each, p, cap=cap)
    src = words(sources)
    out = [exact("x", each), f"u0 AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY src, rank) AS place FROM xr WHERE src IN {src})"]
    for i, (t, share) in enumerate(SHARES[strategy], 1):
        quota = f"greatest(1, CAST(floor(free * CAST({share} AS DOUBLE)) AS INTEGER))"
        out += [
            tier(t, f"t{i}"),
            f"f{i} AS (SELECT qs.id AS q, {k} - count(u.id) AS free FROM qs LEFT JOIN u{i - 1} u ON u.q = qs.id GROUP BY qs.id)",
            f"h{i} AS (SELECT q, free, {f'greatest(1, {quota} // 2)' if halved else quota} AS half FROM f{i} WHERE free > 0)",
            f"a{i} AS (SELECT r.q, r.id, h.free, min(CASE WHEN r.src = 'S2' THEN 0 ELSE 100000 END + r.rank) AS place FROM t{i}r r JOIN h{i} h ON h.q = r.q LEFT JOIN u{i - 1} u ON u.q = r.q AND u.id = r.id WHERE r.rank <= h.half AND u.id IS NULL AND r.src IN {src} GROUP BY r.q, r.id, h.free)",
            f"u{i} AS (SELECT q, id, place FROM u{i - 1} UNION ALL SELECT q, id, {i} * 1000000 + place FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY place) AS nth FROM a{i}) WHERE nth <= free)",
        ]
    return ", ".join(out) + f", n AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY place) AS nth FROM u{len(SHARES[strategy])})"


def union(strategy: str, k: int = K, **more) -> str:
    return f"WITH {RECORDS}, {folded(strategy, k, **more)} " + LISTED.replace(f"nth <= {K}", f"nth <= {k}")


def jac(a: str, b: str) -> str:
    i = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0e0 ELSE {i} / CAST(len({a}) + len({b}) - {i} AS DOUBLE) END"


def ratio(a: str, b: str) -> str:
    both = f"coalesce(list_sum(list_transform(list_distinct(string_split({a}, '')), lambda ch: least(length({a}) - length(replace({a}, ch, '')), length({b}) - length(replace({b}, ch, ''))))), 0)"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0e0 WHEN {a} = {b} THEN 1e0 ELSE 2e0 * {both} / (length({a}) + length({b})) END"


def feature(name: str) -> str:
    both = lambda c: (f"x.{c}", f"y.{c}")
    same = lambda c: f"CAST(x.{c} <> '' AND x.{c} = y.{c} AS INTEGER)"
    inter = lambda c: f"len(list_intersect(x.{c}, y.{c}))"
    ovr = lambda c: f"CASE WHEN len(x.{c}) = 0 OR len(y.{c}) = 0 THEN 0e0 ELSE {inter(c)} / CAST(least(len(x.{c}), len(y.{c})) AS DOUBLE) END"
    return {
        "name_exact_match": same("norm_name"), "name_token_jaccard": jac(*both("name_tokens")), "name_token_overlap_count": inter("name_tokens"), "name_token_overlap_ratio": ovr("name_tokens"),
        "name_char3_jaccard": jac(*both("char3")), "name_char4_jaccard": jac(*both("char4")), "name_seq_sim": ratio(*both("norm_name")), "name_len_diff": "abs(length(x.norm_name) - length(y.norm_name))",
        "name_len_ratio": "CASE WHEN x.norm_name = '' OR y.norm_name = '' THEN 0e0 ELSE least(length(x.norm_name), length(y.norm_name)) / CAST(greatest(length(x.norm_name), length(y.norm_name)) AS DOUBLE) END",
        "name_token_count_diff": "abs(len(x.name_tokens) - len(y.name_tokens))", "addr_exact_match": same("norm_addr"), "addr_token_jaccard": jac(*both("addr_tokens")), "addr_token_overlap_count": inter("addr_tokens"),
        "addr_token_overlap_ratio": ovr("addr_tokens"), "addr_char3_jaccard": jac(*both("addr_char3")), "addr_seq_sim": ratio(*both("norm_addr")), "postal_exact_match": f"CAST({inter('postal')} > 0 AS INTEGER)",
        "postal_overlap_count": inter("postal"), "s1_addr_missing": "CAST(x.norm_addr = '' AS INTEGER)", "cand_addr_missing": "CAST(y.norm_addr = '' AS INTEGER)", "both_addr_missing": "CAST(x.norm_addr = '' AND y.norm_addr = '' AS INTEGER)",
        "country_match": "CAST(x.country = '' OR y.country = '' OR x.country = y.country AS INTEGER)", "combined_token_jaccard": jac(*both("comb")), "is_source2": "CAST(y.src = 'S2' AS INTEGER)", "is_source3": "CAST(y.src = 'S3' AS INTEGER)",
    }[name]


def features_of(names: list[str]) -> str:
    columns = ", ".join(f"round(CAST({feature(n)} AS DOUBLE), 9) AS {n}" for n in names)
    return f"WITH {RECORDS}, {by_terms('tokens')} SELECT r.q, r.id, {columns} FROM r JOIN qs x ON x.id = r.q JOIN ts y ON y.id = r.id"


def scored(k: int = K, allowed: list[str] | None = None) -> str:
    rule = " + ".join(f"CAST({w} AS DOUBLE) * ({feature(n)})" for n, w in RULE.items() if allowed is None or n in allowed)
    return f"{RECORDS}, {TRUTH}, {by_terms('tokens', k)}, s AS (SELECT r.q, r.id, r.rank, round({rule}, 9) AS p FROM r JOIN qs x ON x.id = r.q JOIN ts y ON y.id = r.id), found AS (SELECT q, id, p FROM s WHERE p >= {RULE_TAU})"


F05 = "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1e0 WHEN n_true = 0 OR n_pred = 0 OR n_hit = 0 THEN 0e0 ELSE 1.25e0 * (n_hit / CAST(n_pred AS DOUBLE)) * (n_hit / CAST(n_true AS DOUBLE)) / (0.25e0 * (n_hit / CAST(n_pred AS DOUBLE)) + n_hit / CAST(n_true AS DOUBLE)) END"


def entities(allowed: list[str] | None = None) -> str:
    return f"""{scored(allowed=allowed)},
cnt AS (SELECT qs.id AS q, qs.country, coalesce(a.n, 0) AS n_true, coalesce(b.n, 0) AS n_pred, coalesce(c.n, 0) AS n_hit FROM qs
 LEFT JOIN (SELECT q, count(*) AS n FROM truth GROUP BY q) a ON a.q = qs.id LEFT JOIN (SELECT q, count(*) AS n FROM found GROUP BY q) b ON b.q = qs.id
 LEFT JOIN (SELECT f.q, count(*) AS n FROM found f JOIN truth t ON t.q = f.q AND t.id = f.id GROUP BY f.q) c ON c.q = qs.id),
ent AS (SELECT *, CASE WHEN n_pred = 0 THEN 1e0 ELSE n_hit / CAST(n_pred AS DOUBLE) END AS precision, CASE WHEN n_true = 0 THEN 1e0 ELSE n_hit / CAST(n_true AS DOUBLE) END AS recall, {F05} AS f05 FROM cnt)"""


MACRO = "SELECT count(*) AS entities, round(avg(f05), 6) AS macro_f05, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, count(*) FILTER (n_true = 0) AS singletons, count(*) FILTER (n_true = 0 AND n_pred = 0) AS correct_singletons, count(*) FILTER (n_true = 0 AND n_pred > 0) AS false_singletons FROM ent"
SWEEP = f"""WITH {scored()},
tau AS (SELECT unnest([{", ".join(f"CAST({t} AS DOUBLE)" for t in TAUS)}]) AS tau),
cnt AS (SELECT tau, qs.id AS q, (SELECT count(*) FROM truth WHERE truth.q = qs.id) AS n_true, coalesce(b.n_pred, 0) AS n_pred, coalesce(b.n_hit, 0) AS n_hit FROM qs CROSS JOIN tau
 LEFT JOIN (SELECT tau.tau AS t2, s.q, count(*) AS n_pred, count(truth.id) AS n_hit FROM s JOIN tau ON s.p >= tau.tau LEFT JOIN truth ON truth.q = s.q AND truth.id = s.id GROUP BY tau.tau, s.q) b ON b.t2 = tau.tau AND b.q = qs.id),
sw AS (SELECT tau, round(avg({F05}), 9) AS macro_f05 FROM cnt GROUP BY tau)"""


def id_lists(select: str, name: str) -> str:
    return f"SELECT qs.id AS source1_entity_id, coalesce(l.c, '') AS {name} FROM qs LEFT JOIN (SELECT q, string_agg(id, ',' ORDER BY id) AS c FROM ({select}) GROUP BY q) l ON l.q = qs.id"


def profile(frame: str, source: str, key: str, texts: list[str], group: str) -> str:
    rows = [f"SELECT '{frame}' AS frame, 'rows' AS metric, '' AS part, CAST(count(*) AS DOUBLE) AS value FROM {source}", f"SELECT '{frame}', 'duplicate_keys', '{key}', CAST(count({key}) - count(DISTINCT {key}) AS DOUBLE) FROM {source}"]
    for c in texts:
        rows.append(f"SELECT '{frame}', 'blank', '{c}', CAST(count(*) FILTER (coalesce(trim(CAST({c} AS VARCHAR)), '') = '') AS DOUBLE) FROM {source}")
        rows.append(f"SELECT '{frame}', 'mean_length', '{c}', round(avg(length(coalesce(CAST({c} AS VARCHAR), ''))), 6) FROM {source}")
    rows.append(f"SELECT '{frame}', 'group', coalesce(CAST({group} AS VARCHAR), ''), CAST(count(*) AS DOUBLE) FROM {source} GROUP BY 3")
    return " UNION ALL ".join(rows)


SPOILED = f"""{RECORDS}, {by_terms("tokens", 3)},
b0 AS (SELECT qs.id AS q, qs.ord AS n, coalesce(l.ids, CAST([] AS VARCHAR[])) AS ids FROM qs LEFT JOIN (SELECT q, list(id ORDER BY id) AS ids FROM r GROUP BY q) l ON l.q = qs.id),
b1 AS (SELECT q, n, CASE WHEN n % 21 = 0 THEN list_append(ids, 'S1-' || CAST(n AS VARCHAR)) WHEN n % 27 = 0 THEN list_append(ids, 'X9-1') WHEN n % 33 = 0 THEN list_append(ids, 'S2-999999999') WHEN n % 15 = 0 AND len(ids) > 0 THEN list_concat(ids, ids[1:1]) ELSE ids END AS ids FROM b0),
b2 AS (SELECT * FROM b1 WHERE n % 39 <> 0 UNION ALL SELECT * FROM b1 WHERE n % 39 <> 0 AND n % 45 = 0),
b AS (SELECT q, ids FROM b2 UNION ALL SELECT 'S1-x' || CAST(n AS VARCHAR), ids FROM b2 WHERE n % 63 = 0),
bi AS (SELECT q, unnest(ids) AS id FROM b)"""


def checked(code: str, keys: str, severity: str = "error") -> str:
    return f"WITH {SPOILED}, two AS (SELECT q, id FROM r WHERE rank <= 2), bad AS ({keys}) SELECT '{severity}' AS severity, '{code}' AS code, count(*) AS count, (SELECT coalesce(string_agg(key, ',' ORDER BY key), '') FROM (SELECT key FROM bad ORDER BY key LIMIT 5)) AS examples FROM bad"


def full_link() -> str:
    """Candidates of the full hybrid, and those whose rule score is high enough, in the candidates' order."""
    rule = " + ".join(f"CAST({w} AS DOUBLE) * ({feature(n)})" for n, w in RULE.items())
    lists = ", ".join(f"coalesce((SELECT string_agg(id, ',' ORDER BY nth) FROM s WHERE s.q = qs.id{more}), '') AS {name}" for name, more in (("candidates", ""), ("matches", f" AND p >= {RULE_TAU}")))
    return f"WITH {RECORDS}, {folded('ablation_E_full_hybrid')}, s AS (SELECT n.q, n.id, n.nth, round({rule}, 9) AS p FROM n JOIN qs x ON x.id = n.q JOIN ts y ON y.id = n.id WHERE n.nth <= {K}) SELECT qs.id AS source1_entity_id, {lists} FROM qs"


def oracle_sql() -> dict[str, str]:
    with_e = lambda s: f"WITH {RECORDS} {s}"
    lists = ", ".join(f"{line(c)} AS {c}" for c in ("name_tokens", "addr_tokens", "char3", "char4", "postal", "comb"))
    named = "SELECT id, norm_name AS name FROM e UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), lower(p_brand) FROM part UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), lower(r_name) FROM region"
    quantiles = ", ".join(f"CAST(quantile_cont(n, {q}) AS DOUBLE) AS {name}" for q, name in ((0.5, "median_len"), (0.9, "p90_len"), (0.95, "p95_len"), (0.99, "p99_len")))
    out = {
        "normalize_names": f"SELECT 'd' || CAST(doc_id AS VARCHAR) AS key, {normal('text')} AS normal FROM documents UNION ALL SELECT 'c-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), {normal('text')} FROM conversations",
        "tokenize_distinct": with_e(f"SELECT id, {line('name_tokens')} AS name_tokens, {line(NAME_TERMS)} AS name_terms, {line(ADDR_TERMS)} AS addr_terms, {line(COMPOSITE)} AS composite FROM e"),
        "char_trigrams": with_e(f"SELECT id, {line(grams('name', 3))} AS grams FROM ({named})"),
        "char_fourgrams": with_e(f"SELECT id, {line(grams('name', 4))} AS grams FROM ({named})"),
        "postal_tokens": f"SELECT key, {line(postal('text'))} AS codes FROM (SELECT 'd' || CAST(doc_id AS VARCHAR) AS key, text FROM documents UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), c_name FROM customer UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'SW1A 1AA no ' || CAST(o_orderkey AS VARCHAR) || ' x' FROM orders)",
        "enriched_record": with_e(f"SELECT id, src, norm_name, norm_addr, country, {lists} FROM e"),
        "split_agg_idlists": f"WITH {RECORDS}, {TRUTH} SELECT qs.id AS q, coalesce(l.c, '') AS ids, coalesce(l.n, 0) AS n FROM qs LEFT JOIN (SELECT q, string_agg(id, ',' ORDER BY id) AS c, count(*) AS n FROM truth GROUP BY q) l ON l.q = qs.id",
        "exact_postings": with_e("SELECT src, country, norm_name, string_agg(id, ',' ORDER BY ord, id) AS ids FROM ts WHERE norm_name <> '' GROUP BY src, country, norm_name"),
        "posting_stats": f"WITH {RECORDS}, {postings('tokens')}, l AS (SELECT src, scope, term, count(*) AS n FROM (SELECT src, unnest([country, '*']) AS scope, term FROM p) GROUP BY src, scope, term) SELECT src, scope, CAST(count(*) AS DOUBLE) AS terms, CAST(sum(n) AS DOUBLE) AS postings, CAST(min(n) AS DOUBLE) AS min_len, round(avg(n), 9) AS mean_len, {quantiles}, CAST(max(n) AS DOUBLE) AS max_len FROM l GROUP BY src, scope",
        "traversed_postings": f"WITH {RECORDS}, {postings('char3')}, a AS (SELECT q, s.src, term FROM (SELECT id AS q, unnest(char3) AS term FROM qs) x CROSS JOIN (SELECT DISTINCT src FROM p) s) SELECT a.q, count(*) AS terms, CAST(sum(v.df) AS BIGINT) AS postings FROM a JOIN v ON v.src = a.src AND v.term = a.term GROUP BY a.q",
        "block_exact": f"WITH {RECORDS}, {exact()} {SHOW}",
        "block_address": f"WITH {NUMBERED}, {by_address(qs='qn', ts='tn')} {SHOW}",
        "block_scope_fallback": f"WITH {RECORDS}, mv AS (SELECT * REPLACE (CASE WHEN country = 'EN' AND ord % 2 = 0 THEN 'XX' ELSE country END AS country) FROM qs), {by_terms('char3', SMALL_K, qs='mv', cap=SMALL_CAP)} {SHOW}",
        "jaccard_rerank": f"WITH {RECORDS}, {by_terms('tokens')}, j AS (SELECT r.q, r.id, r.ord, round({jac('x.name_tokens', 'y.name_tokens')}, 9) AS score FROM r JOIN qs x ON x.id = r.q JOIN ts y ON y.id = r.id) SELECT q, id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, ord, id) AS rank FROM j) WHERE rank <= 5",
        "posting_self_pairs": with_e(", t AS (SELECT id, unnest(name_tokens) AS term FROM ts), ok AS (SELECT term FROM t WHERE length(term) >= 3 GROUP BY term HAVING count(*) BETWEEN 2 AND 49) SELECT DISTINCT a.id AS a, b.id AS b FROM t a JOIN t b ON a.term = b.term AND a.id < b.id WHERE a.term IN (SELECT term FROM ok)").replace("src <> 'S1') ,", "src <> 'S1'),"),
        "union_exact_name": single_tier(exact(), None),
        "union_address": single_tier(by_address(), K // 2),
        "union_A": exact_then(by_terms("tokens")),
        "union_composite": exact_then(by_terms("tokens", own=f"list_filter({COMPOSITE}, lambda t: t NOT IN {words(BUSINESS_STOP)})")),
        "guaranteed_universe": f"WITH {RECORDS}, {TRUTH}, need AS (SELECT id, ord FROM ts WHERE id IN (SELECT id FROM truth)) SELECT id, ord FROM need UNION ALL SELECT id, ord FROM (SELECT id, ord, row_number() OVER (ORDER BY ord, id) AS n FROM ts WHERE id NOT IN (SELECT id FROM truth)) WHERE n <= greatest(0, 300 - (SELECT count(*) FROM need))",
        "rule_score_matches": f"WITH {scored()} SELECT q, id, p FROM found",
        "matching_results": f"WITH {scored()} {id_lists('SELECT q, id FROM found', 'matched_entity_ids')}",
        "candidate_pairs": f"WITH {RECORDS}, {by_terms('tokens')} {id_lists('SELECT q, id FROM r', 'candidate_entity_ids')}",
        "entity_f05": f"WITH {entities()} SELECT q, n_true, n_pred, n_hit, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f05, 9) AS f05 FROM ent",
        "macro_f05": f"WITH {entities()} {MACRO}",
        "ablation_name_only": f"WITH {entities(PREFIXES['name_only'])} {MACRO}",
        "ablation_name_addr": f"WITH {entities(PREFIXES['name_address'])} {MACRO}",
        "global_pair_metrics": f"WITH {entities()}, gp AS (SELECT CAST(sum(n_true) AS BIGINT) AS t, CAST(sum(n_pred) AS BIGINT) AS p, CAST(sum(n_hit) AS BIGINT) AS h FROM ent) SELECT t AS true_pairs, p AS predicted_pairs, h AS true_positives, round(h / CAST(p AS DOUBLE), 6) AS global_precision, round(h / CAST(t AS DOUBLE), 6) AS global_recall, round(1.25e0 * (h / CAST(p AS DOUBLE)) * (h / CAST(t AS DOUBLE)) / (0.25e0 * (h / CAST(p AS DOUBLE)) + h / CAST(t AS DOUBLE)), 6) AS global_f05 FROM gp",
        "country_f05": f"WITH {entities()} SELECT coalesce(country, '*') AS country, count(*) AS entities, round(avg(f05), 6) AS macro_f05 FROM ent GROUP BY ROLLUP (country)",
        "threshold_sweep": f"{SWEEP} SELECT tau, macro_f05 FROM sw",
        "best_threshold": f"{SWEEP} SELECT tau, macro_f05 FROM sw ORDER BY macro_f05 DESC, tau LIMIT 1",
        "blocking_recall": f"""WITH {RECORDS}, {TRUTH}, {by_terms("tokens")}, h AS (SELECT t.q, t.id, CASE WHEN r.id IS NULL THEN 0 ELSE 1 END AS h FROM truth t LEFT JOIN r ON r.q = t.q AND r.id = t.id), per AS (SELECT q, max(h) AS a, min(h) AS b FROM h GROUP BY q)
SELECT * FROM (SELECT count(*) AS true_pairs, CAST(sum(h) AS BIGINT) AS recovered, round(avg(h), 6) AS recall, round(avg(h) FILTER (id LIKE 'S2-%'), 6) AS recall_s2, round(avg(h) FILTER (id LIKE 'S3-%'), 6) AS recall_s3 FROM h), (SELECT count(*) AS entities, CAST(sum(a) AS BIGINT) AS covered, CAST(sum(b) AS BIGINT) AS fully_covered, round(avg(a), 6) AS coverage FROM per)""",
        "candidate_volume": f"WITH {RECORDS}, {by_terms('tokens')}, n AS (SELECT coalesce(l.n, 0) AS n FROM qs LEFT JOIN (SELECT q, count(*) AS n FROM r GROUP BY q) l ON l.q = qs.id) SELECT CAST(sum(n) AS BIGINT) AS total, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, min(n) AS least, max(n) AS most FROM n",
        "marginal_gain": f"WITH {RECORDS}, {TRUTH}, {by_terms('char3', p='a')}, {by_terms('tokens', p='b')} SELECT count(*) AS new_pairs FROM ar JOIN truth t ON t.q = ar.q AND t.id = ar.id WHERE NOT EXISTS (SELECT 1 FROM br WHERE br.q = ar.q AND br.id = ar.id)",
        "run_diff": f"WITH {RECORDS}, {by_terms('tokens')}, rd AS (SELECT qs.id AS q, count(r.id) AS n_a, count(r.id) FILTER (r.rank <= 5) AS n_b FROM qs LEFT JOIN r ON r.q = qs.id GROUP BY qs.id) SELECT q, n_a, n_b, n_b AS n_both, CASE WHEN n_a = 0 THEN 1e0 ELSE round(n_b / CAST(n_a AS DOUBLE), 9) END AS jaccard, n_a <> n_b AS changed FROM rd",
        "profile_table": with_e(" UNION ALL ".join([profile("records", "(SELECT id AS entity_id, norm_name AS business_name, norm_addr AS business_address, lower(country) AS country FROM e)", "entity_id", ["business_name", "business_address"], "country"), profile("customer", "customer", "c_custkey", ["c_name", "c_mktsegment"], "c_mktsegment"), profile("events", "events", "event_id", ["event_type", "props"], "event_type")])),
        "match_summary": f"WITH {scored()}, n AS (SELECT qs.id, count(found.id) AS n FROM qs LEFT JOIN found ON found.q = qs.id GROUP BY qs.id) SELECT count(*) FILTER (n = 0) AS zero, count(*) FILTER (n = 1) AS single, count(*) FILTER (n > 1) AS multi, CAST(sum(n) AS BIGINT) AS matches FROM n",
        "partition_bounds": with_e(", o AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS nth, count(*) OVER () AS n FROM qs), b AS (SELECT w, w * (n // 7) + least(w, n % 7) AS s, w * (n // 7) + least(w, n % 7) + n // 7 + CASE WHEN w < n % 7 THEN 1 ELSE 0 END AS t FROM (SELECT DISTINCT n FROM o), (SELECT unnest(range(0, 7)) AS w)) SELECT CAST(w AS INTEGER) AS worker, count(*) AS n, min(id) AS first, max(id) AS last FROM o JOIN b ON nth >= s AND nth < t GROUP BY w"),
        "merge_partitions": f"WITH {RECORDS}, {by_terms('tokens', 3)} SELECT qs.id AS q, coalesce(l.c, '') AS ids FROM qs LEFT JOIN (SELECT q, string_agg(id, ',' ORDER BY id) AS c FROM r GROUP BY q) l ON l.q = qs.id",
        "best_owner": f"WITH {scored()} SELECT id, q, p FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, q) AS n FROM s) WHERE n = 1",
        "score_margin": f"WITH {scored()} SELECT q, id, p, round(p - lead(p) OVER (PARTITION BY q ORDER BY p DESC, id), 9) AS margin FROM s",
        "validate_duplicate_row": checked("duplicate_row", "SELECT q AS key FROM b GROUP BY q HAVING count(*) > 1"),
        "validate_duplicate_id": checked("duplicate_id", "SELECT q AS key FROM b WHERE len(ids) <> len(list_distinct(ids))"),
        "validate_self_match": checked("self_match", "SELECT id AS key FROM bi WHERE id LIKE 'S1-%'"),
        "validate_bad_prefix": checked("bad_prefix", "SELECT id AS key FROM bi WHERE NOT regexp_matches(id, '^S[123]-')"),
        "validate_unknown_id": checked("unknown_id", "SELECT DISTINCT id AS key FROM bi WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT id FROM ts)"),
        "validate_missing_s1": checked("missing_s1", "SELECT id AS key FROM qs WHERE id NOT IN (SELECT q FROM b)"),
        "validate_extra_s1": checked("extra_s1", "SELECT DISTINCT q AS key FROM b WHERE q NOT IN (SELECT id FROM qs)"),
        "validate_not_subset": checked("not_subset", "SELECT q || ':' || id AS key FROM (SELECT DISTINCT q, id FROM bi) WHERE NOT EXISTS (SELECT 1 FROM two WHERE two.q = bi_q AND two.id = bi_id)", "warning").replace("FROM (SELECT DISTINCT q, id FROM bi) WHERE", "FROM (SELECT DISTINCT q, id, q AS bi_q, id AS bi_id FROM bi) z WHERE"),
    }
    out |= {name: f"WITH {RECORDS}, {postings(kind)} SELECT src, term, df, round({weight('df', FALL[kind])}, 9) AS weight FROM v" for name, kind in (("token_df", "tokens"), ("trigram_df", "char3"), ("fourgram_df", "char4"), ("address_df", "addr"))}
    out |= {f"block_{name}": f"WITH {RECORDS}, {by_terms(kind)} {SHOW}" for name, kind in (("tokens", "tokens"), ("trigrams", "char3"), ("fourgrams", "char4"))}
    out |= {f"union_{name}": single_tier(by_terms(kind), K // 2) for name, kind in (("rare_tokens", "tokens"), ("char_3gram", "char3"), ("char_4gram", "char4"))}
    out |= {f"block_{name}_capped": f"WITH {RECORDS}, {by_terms(kind, SMALL_K, cap=SMALL_CAP)} {SHOW}" for name, kind in (("tokens", "tokens"), ("trigrams", "char3"), ("fourgrams", "char4"))}
    out["block_address_capped"] = f"WITH {NUMBERED}, {by_address(SMALL_K, qs='qn', ts='tn', cap=SMALL_CAP)} {SHOW}"
    out |= {f"union_{name}": union(s) for name, s in (("B", "ablation_B_char3"), ("C", "ablation_C_char4"), ("D", "ablation_D_char3_char4"), ("E", "ablation_E_full_hybrid"))}
    out["union_E_capped"] = union("ablation_E_full_hybrid", SMALL_K, cap=SMALL_CAP)
    out["union_single"] = union("single_source", sources=("S2",), halved=False)
    out["tier_merge"] = union("ablation_E_full_hybrid", SMALL_K, each=50)
    out["full_link"] = full_link()
    out["entity_split"] = f"WITH {RECORDS} SELECT id AS q, CAST('0x' || substring(md5(id || ':42'), 1, 8) AS BIGINT) % 100 < 80 AS train FROM qs"
    out |= {"features_name": features_of(NAME), "features_address": features_of(ADDRESS), "features_cross": features_of(CROSS), "features_all": features_of(FEATURES)}
    return out
