"""DuckDB SQL for the queries: a chain of common table expressions, and a last SELECT for each."""

from __future__ import annotations

from ..functions.text import ADDRESS_WORDS, LEGAL
from ..operators.blocking import KEY_WEIGHTS
from ..operators.evaluate import CUTOFFS, GATES, LIMITS, MATCH_CAPS, NONE, STEPS, cutoff_name, threshold_values
from ..operators.features import FEATURES, HEURISTIC
from .queries import CONFIG, FRACTION, MODEL, PER_CLASS, PER_COUNTRY, SEED, THRESHOLD


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _key(family: str, body: str, source: str = "", where: str = "true") -> str:
    return f"SELECT entity_id, c || '|{family}|' || {body} AS key, '{family}' AS family, CAST({KEY_WEIGHTS[family]} AS BIGINT) AS weight FROM p{source} WHERE c <> '' AND len(nt) > 0 AND {where}"


def _set(kind: str, a: str, b: str) -> str:
    both, under = f"len(list_intersect({a}, {b}))", {"jaccard": f"len(list_distinct(list_concat({a}, {b})))", "overlap": f"least(len({a}), len({b}))", "dice": f"((len({a}) + len({b})) / 2.0)"}[kind]
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE CAST({both} AS DOUBLE) / {under} END"


_PAIR = (
    _set("jaccard", "a.name_tokens", "b.name_tokens"), _set("overlap", "a.name_tokens", "b.name_tokens"), _set("dice", "a.name_grams", "b.name_grams"), _set("jaccard", "a.address_tokens", "b.address_tokens"),
    _set("overlap", "a.address_tokens", "b.address_tokens"), _set("dice", "a.address_grams", "b.address_grams"), _set("overlap", "a.address_numbers", "b.address_numbers"),
    "CASE WHEN a.country <> '' AND a.country = b.country THEN 1.0 ELSE 0.0 END", "CASE WHEN a.name <> '' AND a.name = b.name THEN 1.0 ELSE 0.0 END", "CASE WHEN a.address <> '' AND a.address = b.address THEN 1.0 ELSE 0.0 END",
    "CASE WHEN b.address = '' THEN 1.0 ELSE 0.0 END", "CASE WHEN b.entity_id LIKE 'S2-%' THEN 1.0 ELSE 0.0 END",
)


def _grams(v: str) -> str:
    x = f"replace({v}, ' ', '')"
    return f"CASE WHEN len({x}) = 0 THEN [] WHEN len({x}) < 3 THEN [{x}] ELSE list_distinct(list_transform(range(1, CAST(len({x}) - 1 AS BIGINT)), lambda i: substr({x}, i, 3))) END"


def _f05(n: str, p: str, tp: str) -> str:
    precision, recall = f"({tp} / CAST({p} AS DOUBLE))", f"({tp} / CAST({n} AS DOUBLE))"
    return f"CASE WHEN {n} = 0 AND {p} = 0 THEN 1.0 WHEN {n} = 0 OR {p} = 0 OR {tp} = 0 THEN 0.0 ELSE 1.25 * {precision} * {recall} / (0.25 * {precision} + {recall}) END"


def _mean(value: str, where: str = "true") -> str:
    """The average in whole steps, which are added exactly."""
    total, count = f"sum(CAST(floor(({value}) * {float(STEPS)}) AS HUGEINT)) FILTER ({where})", f"count(*) FILTER ({where})"
    return f"CASE WHEN {count} > 0 THEN CAST({total} AS DOUBLE) / {float(STEPS)} / CAST({count} AS DOUBLE) ELSE 0.0 END"


_MACRO = f"""{_mean('f05')} AS macro_f05, {_mean('f05', 'n_truth = 0')} AS singleton_f05, {_mean('f05', 'n_truth > 0')} AS non_singleton_f05,
    count(*) AS entities, count(*) FILTER (n_truth = 0) AS singletons"""
_WORD = "'^(\\p{L})+$'"
_LINEAR = " + ".join(f"{k} * {w}" for k, w in zip(FEATURES, HEURISTIC, strict=False))
_LOGIT = f"{MODEL['bias']} + " + " + ".join(f"{k} * ({w})" for k, w in zip(FEATURES, MODEL["weights"], strict=True))
_CUT = [(cutoff_name(x), NONE if x is None else x) for x in CUTOFFS]
_CAP = [(cutoff_name(x), NONE if x is None else x) for x in MATCH_CAPS]


def _rows(names: str, rows: list[tuple]) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(repr(v) for v in r) + ')' for r in rows)}) {names}"


def _truth(mark: str, least: int) -> str:
    return f"""SELECT a.id AS query_id, b.id AS target_id FROM (SELECT 'S1-' || doc_id AS id, lang, array_to_string(w[{mark}], ' ') AS m FROM w WHERE len(w) >= {least} AND doc_id % 3 = 0) a
        JOIN (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS id, lang, array_to_string(w[{mark}], ' ') AS m FROM w WHERE len(w) >= {least} AND doc_id % 3 <> 0) b ON a.lang = b.lang AND a.m = b.m"""


CHAIN: dict[str, str] = {
    "n": "SELECT doc_id, lang, n_chars, text, trim(regexp_replace(replace(lower(replace(coalesce(text, ''), 'ß', 'ss')), '&', ' and '), '[^\\p{L}\\p{N}\\p{M}]+', ' ', 'g')) AS normal FROM documents",
    "w": "SELECT *, list_filter(string_split(normal, ' '), lambda x: x <> '') AS w FROM n",
    "rec": """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, array_to_string(w[1:4], ' ') AS business_name,
        CASE WHEN doc_id % 3 <> 0 AND doc_id % 31 = 0 THEN '' ELSE concat_ws(' ', CAST(n_chars // 100 AS VARCHAR), CASE WHEN len(w) >= 5 THEN array_to_string(w[5:8], ' ') END,
        CAST(10000 + length(string_split(coalesce(text, ''), chr(10))[1]) AS VARCHAR)) END AS business_address, lang AS country FROM w""",
    "q": "SELECT entity_id AS query_id, country FROM rec WHERE entity_id LIKE 'S1-%'",
    "t0": f"""SELECT entity_id, lower(country) AS c, list_filter(string_split(business_name, ' '), lambda x: len(x) > 1 AND x NOT IN {_in(LEGAL)}) AS nt,
        list_filter(string_split(business_address, ' '), lambda x: x <> '' AND x NOT IN {_in(ADDRESS_WORDS)}) AS adr FROM rec""",
    "p": f"""SELECT *, list_filter(adr, lambda x: regexp_matches(x, '^\\p{{Nd}}+$') AND len(x) <= 5) AS numbers, list_filter(adr, lambda x: regexp_matches(x, '^\\p{{Nd}}+$') AND len(x) IN (5, 6)) AS postal,
        list_filter(adr, lambda x: regexp_matches(x, {_WORD}) AND len(x) >= 4) AS locality FROM t0""",
    "k": "SELECT DISTINCT * FROM (" + " UNION ALL ".join([
        _key("name", "array_to_string(list_sort(list_distinct(nt)), ' ')"),
        _key("pair", "least(nt[i], nt[j]) || '|' || greatest(nt[i], nt[j])", ", range(1, 4) r(i), range(2, 5) s(j)", "j > i AND i <= len(nt) AND j <= len(nt)"),
        _key("postal", "nt[1] || '|' || postal[i]", ", range(1, 3) r(i)", "i <= len(postal)"), _key("number", "nt[1] || '|' || numbers[i]", ", range(1, 3) r(i)", "i <= len(numbers)"),
        _key("locality", "nt[1] || '|' || locality[i]", ", range(1, 3) r(i)", "i <= len(locality)"), _key("address", "array_to_string(list_sort(list_distinct(adr)), ' ')", "", "len(adr) > 0"),
        _key("addressnum", "numbers[i] || '|' || locality[j]", ", range(1, 4) r(i), range(1, 4) s(j)", "i <= len(numbers) AND j <= len(locality)"),
        _key("prefixaddr", "substr(nt[1], 1, 4) || '|' || substr(adr[1], 1, 4)", "", "len(nt[1]) >= 4 AND len(adr) > 0"),
    ]) + ")",
    "qk": "SELECT entity_id AS query_id, key, weight FROM k WHERE entity_id LIKE 'S1-%'",
    "tk": "SELECT entity_id AS target_id, key FROM k WHERE entity_id NOT LIKE 'S1-%'",
    "bs": "SELECT key, count(*) AS block_size FROM tk GROUP BY key",
    "s": f"SELECT query_id, target_id, CAST(sum(weight) AS BIGINT) AS score FROM qk JOIN tk USING (key) JOIN bs USING (key) WHERE block_size <= {CONFIG.max_block_size} GROUP BY ALL",
    "r": "SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, target_id DESC) AS INTEGER) AS rank FROM s",
    "cand": f"SELECT * FROM r WHERE rank <= {CONFIG.max_candidates}",
    "rf": f"""SELECT entity_id, business_name AS name, business_address AS address, lower(country) AS country, list_distinct(list_filter(string_split(business_name, ' '), lambda x: len(x) > 1 AND x NOT IN {_in(LEGAL)})) AS name_tokens,
        list_distinct(list_filter(string_split(business_address, ' '), lambda x: len(x) > 1)) AS address_tokens, list_distinct(list_filter(string_split(business_address, ' '), lambda x: regexp_matches(x, '^\\p{{Nd}}+$'))) AS address_numbers,
        {_grams('business_name')} AS name_grams, {_grams('business_address')} AS address_grams FROM rec""",
    "pf": "SELECT c.query_id, c.target_id, c.rank, " + ", ".join(f"CAST({e} AS DOUBLE) AS {k}" for k, e in zip(FEATURES, _PAIR, strict=True)) + ", a.country <> '' AND b.country <> '' AND a.country <> b.country AS differ FROM cand c JOIN rf a ON a.entity_id = c.query_id JOIN rf b ON b.entity_id = c.target_id",
    "h1": f"SELECT *, {_LINEAR} AS x FROM pf",
    "h2": "SELECT * REPLACE (CASE WHEN name_exact > 0 THEN greatest(x, CASE WHEN address_jaccard >= 0.15 OR address_number_overlap > 0 THEN 0.92 ELSE 0.82 END) ELSE x END AS x) FROM h1",
    "h3": "SELECT * REPLACE (CASE WHEN address_exact > 0 AND name_overlap >= 0.35 THEN greatest(x, 0.90) ELSE x END AS x) FROM h2",
    "h4": "SELECT * REPLACE (CASE WHEN differ THEN x * 0.25 ELSE x END AS x) FROM h3",
    "sc": "SELECT query_id, target_id, rank, greatest(0.0, least(1.0, CASE WHEN target_address_missing > 0 AND name_overlap < 0.80 THEN x * 0.70 ELSE x END)) AS score FROM h4",
    "m": f"SELECT query_id, target_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, target_id) AS INTEGER) AS match_rank FROM sc WHERE score >= {THRESHOLD}",
    "th": _truth("1:3", 3),
    "tb": _truth("9:11", 11),
    "pe": f"""SELECT query_id, n_truth, n_pred, tp, {_f05('n_truth', 'n_pred', 'tp')} AS f05 FROM (SELECT q.query_id, coalesce(a.n, 0) AS n_truth, coalesce(b.n, 0) AS n_pred, coalesce(c.n, 0) AS tp FROM q
        LEFT JOIN (SELECT query_id, count(*) AS n FROM tb GROUP BY 1) a USING (query_id) LEFT JOIN (SELECT query_id, count(*) AS n FROM m GROUP BY 1) b USING (query_id)
        LEFT JOIN (SELECT query_id, count(*) AS n FROM tb JOIN m USING (query_id, target_id) GROUP BY 1) c USING (query_id))""",
    "tr": "SELECT tb.query_id, tb.target_id, rank FROM tb LEFT JOIN cand USING (query_id, target_id)",
    "st": "SELECT query_id, target_id, score AS p, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, target_id) AS k, max(score) OVER (PARTITION BY query_id) AS best, (query_id, target_id) IN (SELECT (query_id, target_id) FROM tb) AS hit FROM sc",
    "sp": f"SELECT entity_id, country, CAST(CAST('0x' || substr(sha256('{SEED}' || chr(0) || entity_id), 1, 16) AS UBIGINT) % 10000 AS INTEGER) AS bucket FROM rec WHERE entity_id LIKE 'S1-%'",
    "lc": "SELECT q.query_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY rank), '') AS candidate_entity_ids FROM q LEFT JOIN cand USING (query_id) GROUP BY 1",
    "lm": "SELECT q.query_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY match_rank), '') AS matched_entity_ids FROM q LEFT JOIN m USING (query_id) GROUP BY 1",
}


def _tune(thresholds: list[float], limits: tuple, gates: tuple) -> str:
    g = _rows("g(threshold, max_matches, gate)", [(t, NONE if x is None else x, -1.0 if y is None else y) for t in thresholds for y in gates for x in limits])
    return f"""SELECT threshold, max_matches, gate, {_MACRO} FROM (SELECT *, {_f05('n_truth', 'n_pred', 'tp')} AS f05 FROM (
        SELECT CAST(threshold AS DOUBLE) AS threshold, max_matches, CAST(gate AS DOUBLE) AS gate, q.query_id, (SELECT count(*) FROM tb WHERE tb.query_id = q.query_id) AS n_truth,
        count(p) FILTER (p >= threshold AND k <= max_matches AND best >= gate) AS n_pred, count(p) FILTER (hit AND p >= threshold AND k <= max_matches AND best >= gate) AS tp
        FROM q CROSS JOIN {g} LEFT JOIN st ON st.query_id = q.query_id GROUP BY ALL)) GROUP BY ALL"""


_GRID = "SELECT threshold, macro_f05, singleton_f05, non_singleton_f05, entities, singletons FROM (" + _tune(threshold_values(0.50, 0.95, 0.05), (None,), (None,)) + ")"


def _recall(by: str) -> str:
    key = f"{by}, " if by else ""
    rows = f"SELECT {key}cutoff, count(*) AS truth_links, count(*) FILTER (rank <= top) AS found_links FROM tr JOIN q USING (query_id) CROSS JOIN {_rows('x(cutoff, top)', _CUT)} GROUP BY ALL"
    return f"SELECT *, found_links / CAST(greatest(truth_links, 1) AS DOUBLE) AS recall FROM ({rows})"


def _oracle(by: str) -> str:
    key = f"{by}, " if by else ""
    return f"""SELECT {key}cutoff, match_cap, {_mean(_f05('n_truth', 'tp', 'tp'))} AS oracle_f05 FROM (SELECT {key}q.query_id, cutoff, match_cap, count(target_id) AS n_truth, least(count(*) FILTER (rank <= top), cap) AS tp
        FROM q CROSS JOIN {_rows('x(cutoff, top)', _CUT)} CROSS JOIN {_rows('y(match_cap, cap)', _CAP)} LEFT JOIN tr USING (query_id) GROUP BY {key}q.query_id, cutoff, match_cap, cap) GROUP BY ALL"""


_COUNTRY = """SELECT country, count(*) AS queries, CAST(sum(links) AS BIGINT) AS truth_links, count(*) FILTER (n > 0) AS rows_with_candidate, count(*) FILTER (hits > 0) AS rows_with_true_candidate FROM (
    SELECT q.country, (SELECT count(*) FROM cand WHERE cand.query_id = q.query_id) AS n, (SELECT count(*) FROM tr WHERE tr.query_id = q.query_id) AS links,
    (SELECT count(rank) FROM tr WHERE tr.query_id = q.query_id) AS hits FROM q) GROUP BY ALL"""
_PROFILE = """SELECT country, field, rows, empty, round_even(100.0::DOUBLE * empty / rows, 4) AS empty_pct, CASE WHEN rows > empty THEN round_even(CAST(chars AS DOUBLE) / (rows - empty), 3) ELSE 0.0 END AS mean_chars_when_present,
    non_ascii_rows, round_even(100.0::DOUBLE * non_ascii_rows / rows, 4) AS non_ascii_pct, contains_digit_rows, round_even(100.0::DOUBLE * contains_digit_rows / rows, 4) AS contains_digit_pct FROM (
    SELECT country, field, count(*) AS rows, count(*) FILTER (v = '') AS empty, coalesce(sum(length(v)), 0) AS chars, count(*) FILTER (regexp_matches(v, '[^\\x00-\\x7F]')) AS non_ascii_rows,
    count(*) FILTER (regexp_matches(v, '\\p{Nd}')) AS contains_digit_rows FROM (SELECT country, 'business_name' AS field, business_name AS v FROM rec UNION ALL SELECT country, 'business_address', business_address FROM rec)
    GROUP BY GROUPING SETS ((country, field), (field)))"""
_KNOWN = "(SELECT entity_id FROM rec WHERE entity_id NOT LIKE 'S1-%' AND entity_id NOT LIKE '%7')"

LAST: dict[str, str] = {
    "normalize_text": "SELECT doc_id, normal FROM n",
    "source_records": "SELECT * FROM rec",
    "name_tokens": "SELECT entity_id, array_to_string(nt, ' ') AS name_tokens FROM p",
    "address_parts": "SELECT entity_id, array_to_string(adr, ' ') AS address_tokens, array_to_string(numbers, ' ') AS numbers, array_to_string(postal, ' ') AS postal, array_to_string(locality, ' ') AS locality FROM p",
    "char_grams": "SELECT entity_id, unnest(name_grams) AS gram FROM rf",
    "useful_tokens": "SELECT entity_id, " + ", ".join(f"array_to_string(list_sort({x}), ' ') AS {x}" for x in ("name_tokens", "address_tokens", "address_numbers")) + " FROM rf",
    "block_keys_long": "SELECT * FROM k",
    "block_keys_list": "SELECT rec.entity_id, coalesce(string_agg(key, ';' ORDER BY key), '') AS block_keys FROM rec LEFT JOIN k USING (entity_id) GROUP BY 1",
    "block_size_histogram": "SELECT block_size, count(*) AS blocks FROM bs GROUP BY 1",
    "purged_blocks": f"SELECT * FROM bs WHERE block_size > {CONFIG.max_block_size}",
    "eligible_index": f"SELECT target_id AS entity_id, key FROM tk JOIN bs USING (key) WHERE block_size <= {CONFIG.max_block_size}",
    "skipped_key_instances": f"SELECT count(*) AS skipped_keys FROM qk JOIN bs USING (key) WHERE block_size > {CONFIG.max_block_size}",
    "index_semi_join": "SELECT target_id AS entity_id, key FROM tk WHERE key IN (SELECT key FROM qk)",
    "candidate_scores": "SELECT * FROM s",
    "candidate_topk": "SELECT * FROM cand",
    "top1_baseline": "SELECT query_id, target_id FROM cand WHERE rank = 1",
    "candidate_lists": "SELECT * FROM lc",
    "candidate_lists_by_id": "SELECT q.query_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY target_id), '') AS candidate_entity_ids FROM q LEFT JOIN cand USING (query_id) GROUP BY 1",
    "candidates_unlimited": "SELECT query_id, target_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, target_id DESC) AS INTEGER) AS rank FROM (SELECT query_id, target_id, CAST(sum(weight) AS BIGINT) AS score FROM qk JOIN tk USING (key) GROUP BY ALL)",
    "capped_queries": f"SELECT query_id, count(*) AS candidates FROM s GROUP BY 1 HAVING count(*) > {CONFIG.max_candidates}",
    "blocking_stats": f"""SELECT (SELECT count(*) FROM q) AS queries, count(*) AS with_candidates, CAST(coalesce(sum(least(n, {CONFIG.max_candidates})), 0) AS BIGINT) AS candidate_links, count(*) FILTER (n > {CONFIG.max_candidates}) AS capped_queries,
        (SELECT count(*) FROM qk JOIN bs USING (key) WHERE block_size > {CONFIG.max_block_size}) AS skipped_keys FROM (SELECT query_id, count(*) AS n FROM s GROUP BY 1)""",
    "pair_features": "SELECT * EXCLUDE (rank, differ) FROM pf",
    "heuristic_scores": "SELECT * FROM sc",
    "scored_prefix": "SELECT query_id, target_id, score FROM sc WHERE rank <= 3",
    "model_scores": f"SELECT query_id, target_id, CASE WHEN z >= 0 THEN 1.0 / (1.0 + exp(-least(z, 60.0))) ELSE exp(greatest(z, -60.0)) / (1.0 + exp(greatest(z, -60.0))) END AS score FROM (SELECT *, {_LOGIT} AS z FROM pf)",
    "missing_targets": "SELECT query_id, count(*) AS missing FROM cand WHERE target_id LIKE '%1' GROUP BY 1",
    "matches_topk": "SELECT * FROM m WHERE match_rank <= 3",
    "matches_threshold": f"SELECT * FROM (SELECT query_id, target_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS match_rank FROM sc WHERE score >= {THRESHOLD}) WHERE match_rank <= 2",
    "matches_passthrough": "SELECT query_id, target_id, rank AS match_rank FROM cand WHERE rank <= 5",
    "matches_empty": "SELECT query_id AS source1_entity_id, '' AS matched_entity_ids FROM q",
    "matches_gated": "SELECT * FROM m WHERE query_id IN (SELECT query_id FROM sc GROUP BY 1 HAVING max(score) >= 0.88)",
    "match_lists": "SELECT * FROM lm",
    "output_stats": "SELECT (SELECT count(*) FROM q) AS rows, (SELECT count(*) FROM cand) AS candidate_links, (SELECT count(DISTINCT query_id) FROM cand) AS rows_with_candidates, (SELECT count(*) FROM m) AS match_links, (SELECT count(DISTINCT query_id) FROM m) AS rows_with_matches",
    "labelled_pairs": "SELECT query_id, target_id, CAST((query_id, target_id) IN (SELECT (query_id, target_id) FROM tb) AS INTEGER) AS label, CAST(string_split(query_id, '-')[2] AS BIGINT) % 5 = 0 AS holdout FROM cand",
    "class_sample": f"SELECT query_id, target_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sha256('{SEED}|' || query_id || '|' || target_id), query_id, target_id) AS n FROM (SELECT query_id, target_id, CAST((query_id, target_id) IN (SELECT (query_id, target_id) FROM tb) AS INTEGER) AS label FROM cand)) WHERE n <= {PER_CLASS}",
    "truth_links": "SELECT * FROM th UNION SELECT * FROM tb",
    "f05_per_entity": "SELECT * FROM pe",
    "macro_f05": f"SELECT {_MACRO} FROM pe",
    "macro_f05_head": f"""SELECT {_MACRO} FROM (SELECT *, {_f05('n_truth', 'n_pred', 'tp')} AS f05 FROM (SELECT q.query_id, (SELECT count(*) FROM th WHERE th.query_id = q.query_id) AS n_truth, (SELECT count(*) FROM m WHERE m.query_id = q.query_id) AS n_pred,
        (SELECT count(*) FROM th JOIN m USING (query_id, target_id) WHERE th.query_id = q.query_id) AS tp FROM q))""",
    "threshold_grid": _GRID,
    "best_threshold": f"SELECT threshold, macro_f05 FROM ({_GRID}) ORDER BY macro_f05 DESC, singleton_f05 DESC, non_singleton_f05 DESC, threshold DESC LIMIT 1",
    "tune_grid": _tune(threshold_values(0.60, 0.90, 0.10), LIMITS, GATES),
    "coverage_recall_at_k": _recall(""),
    "coverage_recall_by_country": _recall("country"),
    "rank_histogram": "SELECT CASE WHEN rank <= 20 THEN CAST(rank AS VARCHAR) ELSE '21+' END AS rank_bin, count(*) AS links FROM tr WHERE rank IS NOT NULL GROUP BY 1",
    "coverage_oracle": _oracle(""),
    "coverage_oracle_by_country": _oracle("country"),
    "coverage_by_country": _COUNTRY,
    "coverage_totals": f"SELECT CAST(sum(queries) AS BIGINT) AS queries, CAST(sum(truth_links) AS BIGINT) AS truth_links, CAST(sum(rows_with_candidate) AS BIGINT) AS rows_with_candidate, CAST(sum(rows_with_true_candidate) AS BIGINT) AS rows_with_true_candidate, (SELECT count(*) FROM cand) AS candidate_links FROM ({_COUNTRY})",
    "coverage_violations": "SELECT query_id AS source1_entity_id, 'unexpected id' AS violation FROM q WHERE query_id LIKE '%3'",
    "profile_fields": _PROFILE,
    "country_counts": "SELECT country, count(*) AS rows FROM rec GROUP BY 1",
    "truth_cardinality": "SELECT n AS matches, count(*) AS entities FROM (SELECT q.query_id, count(DISTINCT target_id) AS n FROM q LEFT JOIN tb USING (query_id) GROUP BY 1) GROUP BY 1",
    "truth_links_by_source": "SELECT substr(target_id, 1, 2) AS source, count(*) AS links FROM tb GROUP BY 1",
    "stable_split": f"SELECT *, bucket < {round(FRACTION * 10_000)} AS is_validation FROM sp",
    "split_counts": f"SELECT country, count(*) AS total, count(*) FILTER (bucket < {round(FRACTION * 10_000)}) AS validation FROM sp GROUP BY 1",
    "dev_sample": f"SELECT country, entity_id, bucket, rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY country ORDER BY bucket, entity_id) AS INTEGER) AS rn FROM sp) WHERE rn <= {PER_COUNTRY}",
    "validate_output_violations": f"""SELECT DISTINCT 'candidates' AS file, query_id AS source1_entity_id, 'unknown target id' AS violation FROM cand WHERE rank <= 5 AND target_id NOT IN {_KNOWN}
        UNION ALL SELECT DISTINCT 'matches', query_id, 'unknown target id' FROM m WHERE target_id NOT IN {_KNOWN}
        UNION ALL SELECT DISTINCT 'matches', query_id, 'warning: match is no candidate' FROM m WHERE (query_id, target_id) NOT IN (SELECT (query_id, target_id) FROM cand WHERE rank <= 5)""",
}

ORACLE_SQL = {name: "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in CHAIN.items()) + "\n" + last for name, last in LAST.items()}
