"""The corpus queries that SQL can express, for DuckDB."""

from __future__ import annotations

from tidemark.llm.quality import EVEN_HOSTS, HOST_LIMIT, KNOWN_FOR

WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
RULES = ("symbols", "marks", "repeated_lines", "long_words")


def _quality() -> str:
    moments = ", ".join(
        f"avg(failed_{r} / n_docs) AS mean_{r}, var_pop(failed_{r} / n_docs) - avg(failed_{r} / n_docs) * (1 - avg(failed_{r} / n_docs)) * avg(1 / n_docs) AS beyond_{r}"
        for r in (*RULES, "any")
    )

    def rate(r: str) -> str:
        weight = (
            f"CASE WHEN beyond_{r} > 0 THEN least({EVEN_HOSTS}, greatest(0.0, mean_{r} * (1 - mean_{r}) / beyond_{r} - 1)) ELSE {EVEN_HOSTS} END"
        )
        return f"(failed_{r} + mean_{r} * ({weight})) / (n_docs + ({weight}))"

    known = ", ".join(f"{rate(r)} >= {KNOWN_FOR} * mean_{r} AS known_{r}" for r in RULES)
    soft = " OR ".join(f"({r} AND known_{r})" for r in RULES)
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS ws FROM documents
    ), windows AS (
      SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS times
      FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d)
    ), repeated AS (
      SELECT r, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS v(k) WHERE times > 1 GROUP BY r
    ), counted AS (
      SELECT d.r, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_marks,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN repeated ON d.r = repeated.r
    ), measured AS (
      SELECT * EXCLUDE (lines), CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines
      FROM counted
    ), flags AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > n_words AS symbols,
        2 * n_marks > n_words AS marks, 2 * n_dup_lines > n_lines AS repeated_lines, word_chars > 12 * n_words AS long_words
      FROM measured
    ), hosts AS (
      SELECT source, CAST(count(*) AS DOUBLE) AS n_docs, {", ".join(f"CAST(count_if({r}) AS DOUBLE) AS failed_{r}" for r in RULES)},
        CAST(count_if(base_failed OR {" OR ".join(RULES)}) AS DOUBLE) AS failed_any
      FROM flags GROUP BY source
    ), moments AS (SELECT {moments} FROM hosts),
    verdicts AS (SELECT source AS host, {known}, {rate("any")} > {HOST_LIMIT} AS host_rejected FROM hosts, moments)
    SELECT doc_id, n_words, word_chars, n_symbols, n_marks, n_lines, n_dup_lines, n_repeat_words, base_failed, host_rejected,
      NOT base_failed AND NOT host_rejected AND NOT ({soft}) AS kept
    FROM flags JOIN verdicts ON source IS NOT DISTINCT FROM host"""


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM d WHERE len(ws) > 0)
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (
      SELECT x, y, c = a.n AND c = b.n AS same FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id
      WHERE 100 * c >= 80 * (a.n + b.n - c)
    ), e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
    reached AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT e.y, m FROM reached JOIN e ON doc_id = e.x),
    least AS (SELECT doc_id, min(m) AS component_id FROM reached GROUP BY doc_id),
    classes AS (SELECT y AS doc_id, min(x) AS class_id FROM l WHERE same GROUP BY y)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(class_id, d.doc_id) AS class_id, component_id
    FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN classes ON d.doc_id = classes.doc_id JOIN least ON d.doc_id = least.doc_id"""

LINES = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l
    ), often AS (
      SELECT key, min(doc_id) AS least FROM k WHERE doc_id IS NOT NULL AND length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)
    ), marked AS (SELECT k.*, coalesce(doc_id > least, false) AS gone FROM k LEFT JOIN often ON k.key = often.key)
    SELECT first(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY r"""

ORACLES = {"op1_quality_rules": _quality(), "op3_ngram_jaccard_join": JACCARD, "op11_line_dedup": LINES}
