"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: The rules, the limit and the least prior in SQL's own words, so that a change of the operator's shows.
RULES = {
    "short": "n_words < 50",
    "repeating": "n_repeat_words * 100 > n_words * 50",
    "symbolic": "n_symbols * 10 > n_words",
    "same_lines": "n_dup_lines * 3 > n_lines",
    "odd_words": "n_words >= 1 AND NOT (word_chars BETWEEN 2 * n_words AND 12 * n_words)",
}
LIMIT, LEAST_PRIOR = 0.5, 5.0


def host_rules_sql() -> str:
    failures = ", ".join(f"CAST(sum(CAST(({rule}) AS INTEGER)) AS DOUBLE) AS {name}" for name, rule in RULES.items())
    moments = ", ".join(f"avg({name} / host_docs) AS {name}_mean, var_pop({name} / host_docs) AS {name}_var" for name in RULES)
    strength = "greatest({0}_mean * (1 - {0}_mean) / greatest({0}_var - {0}_mean * (1 - {0}_mean) * noise, 1e-6::DOUBLE) - 1, {1}::DOUBLE)"
    rate = "greatest(" + ", ".join(f"({n} + {n}_mean * {strength.format(n, LEAST_PRIOR)}) / (host_docs + {strength.format(n, LEAST_PRIOR)})" for n in RULES) + ")"
    base = f"({RULES['short']}) OR ({RULES['repeating']})"
    return rf"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) > 2),
    win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS c FROM pos),
    rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, range(0, 3) r(k) WHERE c > 1 GROUP BY 1),
    ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    st AS (SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
        FROM d JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
    h AS (SELECT source, CAST(count(*) AS DOUBLE) AS host_docs, {failures} FROM st GROUP BY source),
    m AS (SELECT {moments}, avg(1 / host_docs) AS noise FROM h),
    v AS (SELECT source, {rate} > {LIMIT}::DOUBLE AS host_rejected FROM h, m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, host_rejected, NOT ({base}) AND NOT host_rejected AS kept
    FROM st JOIN v ON st.source IS NOT DISTINCT FROM v.source"""


def jaccard_sql(words: int = 3, part: int = 90, whole: int = 100) -> str:
    following = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(words))
    return rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {words - 2})) AS i FROM d WHERE len(ws) >= {words}),
    sh AS (SELECT DISTINCT doc_id, {following} AS s FROM pos UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND {words - 1}),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
    both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE {whole} * k >= {part} * (x.n + y.n - k)),
    reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.doc_id)
    SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return {"op5_host_rules": host_rules_sql(), "op10_jaccard_join": jaccard_sql()}
