"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from encore.llm import curriculum, licenses, quality

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1() -> str:
    position = "NULL"
    for name, knots in curriculum.SCHEDULES.items():
        at = "0.0"
        for t0, t1, w0, w1, before in curriculum.integrate(knots):
            rest, slope = f"(demand - {before!r})", (w1 - w0) / (t1 - t0)
            root = f"sqrt(greatest({w0 * w0!r} + 2 * {slope!r} * {rest}, 0.0))"
            here = f"least({t0!r} + coalesce(2 * {rest} / nullif({w0!r} + {root}, 0), 0.0), {t1!r})"
            at = f"CASE WHEN demand >= {before!r} THEN {here} ELSE {at} END"
        position = f"CASE WHEN schedule = '{name}' THEN {at} ELSE {position} END"
    fading, steady, growing = curriculum.SCHEDULES
    most = curriculum.MAX_EPOCHS
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '-' || coalesce(text, ''))) AS ticket
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum({most} * source_size) OVER earlier, 0) AS before,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weights
  FROM sources
  WINDOW earlier AS (ORDER BY {most} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (total - before) * weight >= {most} * source_size * weights AS filled FROM ranked
), lowest AS (
  SELECT arg_min(total - before, weights * -1.0) AS left_over, max(weights) AS weights FROM levels WHERE NOT filled
), targets AS (
  SELECT source, source_size,
    CASE weight WHEN 1 THEN '{fading}' WHEN 2 THEN '{steady}' ELSE '{growing}' END AS schedule,
    CASE WHEN filled THEN ({most} * source_size)::DOUBLE
      ELSE coalesce((lowest.left_over * weight)::DOUBLE / nullif(lowest.weights, 0)::DOUBLE, 0.0) END AS target
  FROM levels LEFT JOIN lowest ON true
), streams AS (
  SELECT doc_id, size, source_size, target, schedule,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY ticket, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS middle
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), taken AS (
  SELECT *, middle / nullif(target, 0) AS demand,
    greatest(0, least({most}, coalesce(ceil((target - middle) / nullif(source_size, 0)), 0)))::INTEGER AS copies
  FROM streams
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
  CASE WHEN copies > 0 THEN round({position}, 6) END AS first_position
FROM taken"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def op7() -> str:
    k, near, share = licenses.K, licenses.NEAR, licenses.SHARE
    grams = [
        (label, at, " ".join(words[at : at + k]), len(words), len(words) - k + 1)
        for label, words in ((label, text.split(" ")) for label, text in licenses.TEMPLATES.items())
        for at in range(len(words) - k + 1)
    ]
    phrases = [(phrase, label, len(phrase.split(" "))) for phrase, label in licenses.PHRASES.items()]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), placed AS (
  SELECT rid, words, unnest(generate_series(0, len(words) - 1)) AS pos FROM split
), phrases(phrase, label, length) AS (VALUES {_values(phrases)}),
base AS (
  SELECT rid, pos, label FROM placed JOIN phrases ON array_to_string(words[pos + 1 : pos + length], ' ') = phrase
), grams(label, place, gram, length, grams) AS (VALUES {_values(grams)}),
hits AS (
  SELECT rid, label, length, place, pos, pos - place AS diagonal
  FROM placed JOIN grams ON array_to_string(words[pos + 1 : pos + {k}], ' ') = gram
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, label ORDER BY diagonal) <= {near} THEN 0 ELSE 1 END AS new
  FROM (SELECT DISTINCT rid, label, diagonal FROM hits)
), spanned AS (
  SELECT rid, label, diagonal, sum(new) OVER (PARTITION BY rid, label ORDER BY diagonal) AS span FROM marked
), places AS (
  SELECT rid, label, span, place, any_value(length) AS length, min(pos) AS first, max(pos) AS last
  FROM hits JOIN spanned USING (rid, label, diagonal) GROUP BY rid, label, span, place
), steps AS (
  SELECT *, least({k}, coalesce(place - lag(place) OVER (PARTITION BY rid, label, span ORDER BY place), {k})) AS words FROM places
), spans AS (
  SELECT rid, label, sum(words) / any_value(length) AS share FROM steps
  GROUP BY rid, label, span
  HAVING sum(words) / any_value(length) >= {share} AND max(last) + {k} - min(first) <= 2 * any_value(length)
), base_of AS (
  SELECT rid, count(*) AS n, min(pos) AS first, max(pos) AS last, list(DISTINCT label) AS labels FROM base GROUP BY rid
), span_of AS (
  SELECT rid, max(share) AS share, list(DISTINCT label) AS labels FROM spans GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base,
  b.first::BIGINT AS first_word, b.last::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(s.labels, [])))), ','), '') AS labels,
  greatest(CASE WHEN b.n > 0 THEN 0.5 ELSE 0.0 END, coalesce(s.share, 0.0))::DOUBLE AS score
FROM split LEFT JOIN base_of b USING (rid) LEFT JOIN span_of s USING (rid)"""


def op10() -> str:
    size = quality.WINDOW
    return rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT rid, pos, words[pos : pos + {size - 1}] AS w
  FROM (SELECT rid, words, unnest(generate_series(1, len(words) - {size - 1})) AS pos FROM split)
), again AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, sum(least({size}, coalesce(next - pos, {size})))::BIGINT AS n
  FROM (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS next FROM again) GROUP BY rid
), measured AS (
  SELECT doc_id, text, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{quality.SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS capitals
  FROM split LEFT JOIN covered USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
    OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
    OR (letters > 0 AND 2 * capitals >= letters)
    OR 10 * letters < 6 * word_chars) AS kept
FROM measured"""


SQL: dict[str, str] = {
    "op1_mix_sources": op1(),
    "op7_license_scan": op7(),
    "op10_quality_rules": op10(),
}
