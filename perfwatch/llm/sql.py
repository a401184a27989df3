"""DuckDB SQL that gives the rows of the corpus queries, where SQL can express them."""

from __future__ import annotations

from perfwatch.llm import collocations, licenses, near_duplicates, quality_rules

_SPACED = r"'[^\x20\x09-\x0D]+'"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(lower(coalesce(text, '')), {_SPACED}) AS w
  FROM documents
),
texts AS (SELECT min(rid) AS node, text, any_value(w) AS w FROM docs WHERE len(w) > 0 GROUP BY text),
starts AS (SELECT node, w, unnest(range(1, greatest(2, len(w) - {near_duplicates.WORDS - 2}))) AS i FROM texts),
elements AS (
  SELECT node, array_to_string(w[i : i + {near_duplicates.WORDS - 1}], ' ') AS s, count(*) AS c FROM starts GROUP BY ALL
),
total AS (SELECT node, sum(c) AS n FROM elements GROUP BY node),
shared AS (
  SELECT a.node AS a, b.node AS b, sum(least(a.c, b.c)) AS common
  FROM elements a JOIN elements b ON a.s = b.s AND a.node <> b.node GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN total x ON x.node = a JOIN total y ON y.node = b
  WHERE common >= {near_duplicates.SIMILARITY} * (x.n + y.n - common)
),
reach AS (
  SELECT node AS start, node FROM texts
  UNION SELECT start, b FROM reach JOIN links ON a = node
),
label AS (SELECT node, min(start) AS label FROM reach GROUP BY node),
member AS (SELECT rid, doc_id, label FROM docs JOIN texts USING (text) JOIN label USING (node)),
classes AS (SELECT label, min(doc_id) AS class_id, count(*) AS class_size FROM member GROUP BY label)
SELECT d.doc_id,
       CASE WHEN len(d.w) > 0 THEN class_id ELSE d.doc_id END AS class_id,
       coalesce(class_size, 1)::BIGINT AS class_size,
       len(d.w) = 0 OR d.doc_id IS NOT DISTINCT FROM class_id AS keeps
FROM docs d LEFT JOIN member USING (rid) LEFT JOIN classes USING (label)
"""


def _rules() -> str:
    """(rule, level, cutoff) rows of all rules."""
    return ", ".join(f"('{r}', {i}, {c}::DOUBLE)" for r, (_, grid) in quality_rules.RULES.items() for i, c in enumerate(grid))


def _features() -> str:
    """One SELECT for each rule over the counted rows."""
    return " UNION ALL ".join(
        f"SELECT rid, doc_id, stratum, base_failed, '{r}' AS rule, {f} AS x FROM counted"
        for r, (f, _) in quality_rules.RULES.items()
    )


_SHARE = quality_rules.ALPHA / len(quality_rules.RULES)
QUALITY_RULES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '{quality_rules.NONE}') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_SPACED})) AS l
  FROM documents
),
grams AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n
  FROM (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(list_zip(w[:-3], w[2:-2], w[3:]), lambda x: concat_ws(' ', x[1], x[2], x[3]))) AS g
        FROM docs WHERE len(w) > 2)
),
covered AS (
  SELECT rid, sum(least(3, i - before)) AS n
  FROM (SELECT rid, i, lag(i, 1, -3) OVER (PARTITION BY rid ORDER BY i) AS before FROM grams WHERE n > 1) GROUP BY rid
),
counted AS (
  SELECT docs.rid, doc_id, stratum, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS chars,
         coalesce(chars, 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM docs LEFT JOIN covered USING (rid)
),
known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
grid(rule, level, cutoff) AS (VALUES {_rules()}),
features AS ({_features()}),
holdout AS (SELECT stratum, rule, x, good FROM features JOIN known USING (doc_id) WHERE NOT base_failed),
sums AS (
  SELECT h.stratum, rule, level, cutoff, count(*) FILTER (good) AS n,
         count(*) FILTER (good AND x > cutoff) AS k, count(*) FILTER (NOT good AND x > cutoff) AS caught
  FROM holdout h JOIN grid USING (rule) GROUP BY ALL
),
tested AS (
  SELECT *, CASE WHEN k >= n * {_SHARE} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
           lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({_SHARE}) + (n - j) * ln(1 - {_SHARE})))) END AS p
  FROM sums
),
safe AS (
  SELECT * FROM (SELECT *, max(p) OVER (PARTITION BY stratum, rule ORDER BY level) AS worst FROM tested)
  WHERE worst <= {quality_rules.DELTA} / greatest(1, {len(quality_rules.RULES)} * (SELECT count(DISTINCT stratum) FROM sums))
),
chosen AS (
  SELECT stratum, rule, cutoff FROM (
    SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - k DESC, level) AS place FROM safe
  ) WHERE place = 1
),
failed AS (SELECT DISTINCT rid FROM features JOIN chosen USING (stratum, rule) WHERE x > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed.rid IS NULL AS kept
FROM counted LEFT JOIN failed USING (rid)
"""


def _templates() -> str:
    rows, number = [], 0
    for exact, table in (("TRUE", licenses.PHRASES), ("FALSE", licenses.NOTICES)):
        for label, texts in table.items():
            for text in texts:
                rows.append(f"({number}, '{label}', {exact}, string_split('{text}', ' '))")
                number += 1
    return ", ".join(rows)


LICENSES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
template(template, label, exact, tw) AS (VALUES {_templates()}),
pairs AS (SELECT template, label, exact, len(tw) AS length, q, tw[q + 1] AS w1, tw[q + 2] AS w2
          FROM (SELECT *, unnest(range(0, len(tw) - 1)) AS q FROM template)),
grams AS (SELECT rid, p, w[p + 1] AS w1, w[p + 2] AS w2 FROM (SELECT rid, w, unnest(range(0, len(w) - 1)) AS p FROM docs)),
hits AS (SELECT * FROM grams JOIN pairs USING (w1, w2)),
diagonals AS (
  SELECT rid, template, label, exact, length, p - q AS d, min(p) AS lo, max(p) AS hi, count(*) AS votes, list(q) AS spots
  FROM hits GROUP BY ALL
),
marked AS (
  SELECT *, CASE WHEN lo - lag(hi) OVER runs <= {licenses.GAP} AND abs(d - lag(d) OVER runs) <= {licenses.DRIFT} THEN 0 ELSE 1 END AS fresh
  FROM diagonals WHERE NOT exact AND (votes > 1 OR length < 4) WINDOW runs AS (PARTITION BY rid, template ORDER BY lo, d)
),
merged AS (
  SELECT rid, label, length, len(list_distinct(flatten(list(spots)))) / (length - 1) AS covered
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY rid, template ORDER BY lo, d ROWS UNBOUNDED PRECEDING) AS run FROM marked)
  GROUP BY rid, template, label, length, run
),
spans AS (
  SELECT rid, label, TRUE AS exact, lo, 1.0::DOUBLE AS covered FROM diagonals WHERE exact AND votes = length - 1
  UNION ALL SELECT rid, label, FALSE, NULL, covered FROM merged WHERE covered >= CASE WHEN length <= {licenses.SHORT} THEN 1.0 ELSE {licenses.COVERED} END
),
found AS (
  SELECT rid, count(*) FILTER (exact) AS n_base, min(lo) AS first_word, max(lo) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(covered) AS score
  FROM spans GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (rid)
"""

FILTER_AUDIT = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w
  FROM documents
),
judged AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
),
firsts AS (SELECT text, min(doc_id) AS lowest FROM base GROUP BY text),
fails AS (
  SELECT part, good, toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > lowest THEN 'E' ELSE '' END AS failed
  FROM base JOIN firsts USING (text) LEFT JOIN judged USING (doc_id)
),
kinds AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL
),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letter a JOIN letter b ON b.f <> a.f JOIN letter c ON c.f NOT IN (a.f, b.f) JOIN letter d ON d.f NOT IN (a.f, b.f, c.f)
       JOIN letter e ON e.f NOT IN (a.f, b.f, c.f, d.f)
),
placed AS (
  SELECT part, filter_order, step, filter_order[step] AS f, failed, n, good, toxic,
         len(regexp_replace(filter_order, '[' || failed || '].*$', '')) + 1 AS gone
  FROM (SELECT kinds.*, filter_order, unnest(range(1, 6)) AS step FROM kinds CROSS JOIN orders WHERE failed <> '')
),
steps AS (
  SELECT part, filter_order, step, f,
         sum(n) FILTER (gone = step) AS removed, sum(n) FILTER (gone < step AND contains(failed, f)) AS redundant,
         sum(n) FILTER (gone <= step) AS gone, sum(n) FILTER (failed = f) AS alone,
         sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM placed GROUP BY ALL
),
whole AS (SELECT part, sum(n) AS n FROM kinds GROUP BY part),
grid AS (SELECT part, n, filter_order, unnest(range(1, 6)) AS step FROM whole CROSS JOIN orders),
filled AS (
  SELECT part, filter_order, step, filter_order[step] AS f, n - coalesce(gone, 0) AS kept, coalesce(removed, 0) AS removed,
         coalesce(redundant, 0) AS redundant, coalesce(alone, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
         coalesce(toxic_lost, 0) AS toxic_lost
  FROM grid LEFT JOIN steps USING (part, filter_order, step)
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM filled
"""

COLLOCATIONS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (SELECT lang, w, i, unnest(range(1, {collocations.LONGEST + 1})) AS size FROM starts),
f AS (
  SELECT lang, w[i : i + size - 1] AS words, count(*) AS a FROM grams WHERE i + size - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= {collocations.LEAST}
),
chosen AS (SELECT * FROM f WHERE len(words) > 1),
cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM chosen),
scored AS (
  SELECT cuts.lang, cuts.words, cuts.a, k, x.a AS l, y.a AS r, n, (1000::HUGEINT * cuts.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN totals USING (lang) JOIN f x ON x.lang = cuts.lang AND x.words = cuts.words[1 : k]
       JOIN f y ON y.lang = cuts.lang AND y.words = cuts.words[k + 1 : len(cuts.words)]
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, words[i : i + size - 1] AS words, a
  FROM (SELECT lang, words, a, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT lang, words, a, unnest(range(2, len(words))) AS size FROM chosen))
),
alone AS (
  SELECT * FROM weakest t WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = t.lang AND p.words = t.words AND 100 * p.a >= {collocations.WITHIN} * t.a
  )
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM alone
)
SELECT lang, rank::BIGINT AS rank, array_to_string(words, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {collocations.TOP}
"""
