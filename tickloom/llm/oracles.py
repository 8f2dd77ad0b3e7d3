"""Reference SQL of the operators that SQL can express."""

from __future__ import annotations

from tickloom.llm import line_dedup, risk_rules

ORACLES: dict[str, str] = {}

ORACLES["op8_line_dedup"] = f"""
WITH cut AS (
    SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
           regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') AS spaces,
           CASE WHEN regexp_matches(text, '^[\\x20\\x09-\\x0D]') THEN 1 ELSE 0 END AS lead
    FROM documents
), normed AS (
    SELECT *, list_transform(words, lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS norm FROM cut
), passages AS (
    SELECT *, list_transform(range(len(words)), lambda i: CASE WHEN i + {line_dedup.WORDS} <= len(words)
                             THEN md5(array_to_string(norm[i + 1 : i + {line_dedup.WORDS}], ' ')) END) AS passages FROM normed
), each AS (
    -- before word k stand k words and k + lead stretches of white space
    SELECT doc_id, CASE WHEN lead = 1 THEN length(spaces[1]) ELSE 0 END AS indent, unnest(words) AS word,
           unnest(spaces[1 + lead : len(words) - 1 + lead]) AS space, unnest(passages) AS passage,
           generate_subscripts(words, 1) - 1 AS k
    FROM passages
), placed AS (
    SELECT doc_id, k, passage, length(word) AS size,
           indent + coalesce(sum(length(word) + coalesce(length(space), 0)) OVER (
               PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
    FROM each
), ranked AS (
    SELECT *, passage IS NOT NULL AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, k) > 1 AS later FROM placed
), seen AS (
    SELECT *, coalesce(max(CASE WHEN later THEN k END) OVER (
        PARTITION BY doc_id ORDER BY k ROWS BETWEEN {line_dedup.WORDS - 1} PRECEDING AND CURRENT ROW) IS NOT NULL, false) AS gone
    FROM ranked
), spans AS (
    SELECT doc_id, CAST(min(pos) AS BIGINT) AS a, CAST(max(pos + size) AS BIGINT) AS b
    FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM seen WHERE gone) GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans
), joined AS (
    SELECT doc_id, count(*) AS n_removed, string_agg(a || ':' || b, ' ' ORDER BY a) AS removed_spans, max(b) AS last,
           string_agg(substr(text, CAST(before + 1 AS BIGINT), CAST(a - before AS BIGINT)), '' ORDER BY a) AS kept
    FROM pieces JOIN documents USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN n_removed IS NULL THEN text ELSE kept || substr(text, last + 1) END AS text,
       CAST(coalesce(n_removed, 0) AS INT) AS n_removed, coalesce(removed_spans, '') AS removed_spans
FROM documents LEFT JOIN joined USING (doc_id)
"""

_GRID = ", ".join(
    f"('{rule}', {i}, {cut})" for rule, (_, _, grid) in risk_rules.RULES.items() for i, cut in enumerate(grid)
)
_STATISTIC = "CASE rule {} END".format(
    " ".join(f"WHEN '{rule}' THEN {a} / nullif(CAST({b} AS DOUBLE), 0)" for rule, (a, b, _) in risk_rules.RULES.items())
)

ORACLES["op7_risk_rules"] = f"""
WITH cut AS (
    SELECT doc_id, lang, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, w, list_slice(words, w, w + 4) AS five
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS w FROM cut)
), twice AS (
    SELECT doc_id, w FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(w, w + 5)) AS place FROM twice) GROUP BY doc_id
), figures AS (
    SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM cut LEFT JOIN covered USING (doc_id)
), base AS (
    SELECT *, n_words < {risk_rules.MIN_WORDS} OR 100 * n_repeat_words > {risk_rules.MOST_REPEATED} * n_words AS base_failed
    FROM figures
), good AS (
    SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), grid(rule, i, cut) AS (
    VALUES {_GRID}
), stat AS (
    SELECT doc_id, lang, rule, i, CAST(grid.cut AS DOUBLE) AS cut, {_STATISTIC} AS x FROM base, grid
), counted AS (
    SELECT lang, rule, i, cut, count(*) AS n, count(*) FILTER (x > cut) AS k
    FROM stat SEMI JOIN good USING (doc_id) SEMI JOIN (SELECT doc_id FROM base WHERE NOT base_failed) b USING (doc_id)
    GROUP BY ALL
), tail AS (
    SELECT lang, rule, i, cut, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
           + j * ln({risk_rules.RISK}) + (n - j) * ln(1 - {risk_rules.RISK}))) AS p
    FROM (SELECT *, unnest(range(k + 1)) AS j FROM counted) GROUP BY ALL
), passed AS (
    SELECT *, bool_and(p <= {risk_rules.LEVEL} / ({len(risk_rules.RULES)} * (SELECT count(DISTINCT coalesce(lang, '')) FROM counted)))
              OVER (PARTITION BY lang, rule ORDER BY i) AS ok
    FROM tail
), best AS (
    SELECT lang, rule, min(cut) AS cut FROM passed WHERE ok GROUP BY ALL
), broken AS (
    SELECT DISTINCT doc_id FROM stat JOIN best ON stat.rule = best.rule AND stat.lang IS NOT DISTINCT FROM best.lang
    WHERE stat.x > best.cut
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM base
"""
