"""The same results as DuckDB SQL over the given tables, formulated anew."""

import re

from tidegauge.llm import licences

BLANK = r"[\x20\x09-\x0D]+"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_transform({WORDS},
           lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE
      WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3),
             lambda i: array_to_string(list_slice(words, i, i + 4), ' ')))) END AS grams
  FROM worded
), classes AS (
  SELECT min(doc_id) AS node, grams, len(grams) AS n
  FROM sets WHERE len(grams) > 0 GROUP BY grams
), entries AS (
  SELECT node, n, unnest(grams) AS gram FROM classes
), shared AS (
  SELECT x.node AS a, y.node AS b, x.n AS n_a, y.n AS n_b, count(*) AS overlap
  FROM entries x JOIN entries y ON x.gram = y.gram AND x.node < y.node
   AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * overlap >= 80 * (n_a + n_b - overlap)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, other) AS (
  SELECT node, node FROM classes
  UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), roots AS (
  SELECT node, min(other) AS root FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id
FROM sets s
LEFT JOIN classes c ON s.grams = c.grams
LEFT JOIN roots r ON r.node = c.node
"""

GRID = "[0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.175, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03]"

OP3 = rf"""
WITH worded AS (
  SELECT doc_id, lang, coalesce(text, '') AS body, {WORDS} AS words, row_number() OVER () AS id FROM documents
), places AS (
  SELECT id, unnest(range(1, greatest(len(words) - 1, 1))) AS p FROM worded WHERE len(words) >= 3
), runs AS (
  SELECT w.id, p, [words[p], words[p + 1], words[p + 2]] AS run FROM places JOIN worded w USING (id)
), again AS (
  SELECT id, p FROM runs QUALIFY count(*) OVER (PARTITION BY id, run) > 1
), repeated AS (
  SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest([p, p + 1, p + 2]) AS place FROM again) GROUP BY id
), counted AS (
  SELECT w.id, doc_id, lang, len(words) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(body) - length(regexp_replace(body, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals,
         list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM worded w LEFT JOIN repeated r ON r.id = w.id
), scored AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0.0 END AS symbols,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeats,
         CASE WHEN len(lines) > 0 THEN (len(lines) - len(list_distinct(lines))) / len(lines) ELSE 0.0 END AS dup_lines,
         CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0.0 END AS capitals
  FROM counted
), graded AS (
  SELECT coalesce('=' || lang, '') AS stratum, quality, unnest([
           {{'rule': 'symbols', 'score': symbols}}, {{'rule': 'repeats', 'score': repeats}},
           {{'rule': 'dup_lines', 'score': dup_lines}}, {{'rule': 'capitals', 'score': capitals}}]) AS x
  FROM scored JOIN (SELECT DISTINCT doc_id, quality FROM labels) USING (doc_id) WHERE NOT base_failed
), cuts AS (
  SELECT unnest({GRID}) AS cut
), tried AS (
  SELECT stratum, x.rule AS rule, cut,
         count(*) FILTER (quality = 1 AND x.score > cut) AS k,
         count(*) FILTER (quality = 0 AND x.score > cut) AS caught,
         count(*) FILTER (quality = 1) AS n
  FROM graded CROSS JOIN cuts GROUP BY ALL
), tested AS (
  SELECT *, CASE WHEN k >= n * 0.0125 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.0125) + (n - i) * ln(0.9875)))) END AS p,
         0.05 / (4 * (SELECT count(DISTINCT stratum) FROM graded)) AS level
  FROM tried
), best AS (
  SELECT stratum, rule, arg_max(cut, (caught - 20 * k) + cut / 10) AS cut
  FROM tested WHERE p <= level AND caught > 20 * k GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(symbols > a.cut, FALSE) OR coalesce(repeats > b.cut, FALSE)
            OR coalesce(dup_lines > c.cut, FALSE) OR coalesce(capitals > d.cut, FALSE)) AS kept,
       symbols, repeats, dup_lines, capitals
FROM scored s
LEFT JOIN best a ON a.stratum = coalesce('=' || lang, '') AND a.rule = 'symbols'
LEFT JOIN best b ON b.stratum = coalesce('=' || lang, '') AND b.rule = 'repeats'
LEFT JOIN best c ON c.stratum = coalesce('=' || lang, '') AND c.rule = 'dup_lines'
LEFT JOIN best d ON d.stratum = coalesce('=' || lang, '') AND d.rule = 'capitals'
"""


def _canonical(text: str) -> str:
    """The canonical form with line breaks kept, as nested SQL."""
    out = f"regexp_replace(lower({text}), '{licences.COPYRIGHT_LINE}', '', 'g')"
    out = f"regexp_replace({out}, '{licences.RIGHTS_LINE}', '', 'g')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"


def _spelled(form: str) -> str:
    for _, pattern, one in licences.SPELLINGS:
        form = f"regexp_replace({form}, '{pattern}', '{re.sub(r'[$]([0-9])', r'\\1', one)}', 'g')"
    return form


def _known() -> str:
    quoted = ((name, words.replace("'", "''")) for name, words in licences.known_texts())
    return ", ".join(f"('{name}', '{words}')" for name, words in quoted)


WHOLE = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'))"

OP8 = f"""
WITH known AS (
  SELECT {_spelled(WHOLE.format(_canonical("wording")))} AS form, min(licence) AS licence
  FROM (VALUES {_known()}) AS t(licence, wording) GROUP BY ALL
), forms AS (
  SELECT doc_id, row_number() OVER () AS id, {_canonical("coalesce(text, '')")} AS plain FROM documents
), spelled AS (
  SELECT doc_id, id, {_spelled(WHOLE.format("plain"))} AS whole, string_split({_spelled("plain")}, chr(10)) AS lines
  FROM forms
), found AS (
  SELECT id, licence FROM (SELECT id, trim(unnest(lines)) AS line FROM spelled) JOIN known ON form = line
  WHERE line <> ''
), notices AS (
  SELECT id, array_to_string(list_sort(list(DISTINCT licence)), ',') AS notices, count(*) AS n FROM found GROUP BY id
)
SELECT doc_id, k.licence, notices, coalesce(n, 0) AS n_notices
FROM spelled s LEFT JOIN known k ON k.form = s.whole AND s.whole <> '' LEFT JOIN notices USING (id)
"""

# The cut of the last pass and the curriculum, over running sums in digest order.
OP9 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len({WORDS}) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), sources AS (
  SELECT source, sum(size) :: BIGINT AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), rounds(left_over, share, turn) AS (
  SELECT sum(source_size) :: BIGINT, sum(weight) :: BIGINT, 0 FROM sources
  UNION ALL
  SELECT (SELECT sum(source_size) FROM sources)
           - coalesce((SELECT sum(3 * source_size) FROM sources WHERE 3 * source_size * share < weight * left_over), 0),
         (SELECT sum(weight) FROM sources)
           - coalesce((SELECT sum(weight) FROM sources WHERE 3 * source_size * share < weight * left_over), 0),
         turn + 1
  FROM rounds WHERE turn < 30
), level AS (
  SELECT left_over, share FROM rounds ORDER BY turn DESC LIMIT 1
), targets AS (
  SELECT source, source_size, weight,
         least(weight * (left_over :: DOUBLE) / (share :: DOUBLE), (3 * source_size) :: DOUBLE) AS target
  FROM sources, level
), placed AS (
  SELECT s.doc_id, s.source, size, source_size, weight, target, floor(target + 0.5) :: BIGINT AS words,
         (sum(size) OVER (PARTITION BY s.source ORDER BY digest, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size) :: BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passed AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN least(size, greatest(words % source_size - before, 0)) ELSE 0 END AS rest
  FROM placed
), demand AS (
  SELECT sum(words) FILTER (weight = 1) :: DOUBLE AS d1, sum(words) FILTER (weight = 2) :: DOUBLE AS d2,
         sum(words) FILTER (weight = 3) :: DOUBLE AS d3
  FROM (SELECT DISTINCT source, weight, words FROM placed)
), timed AS (
  SELECT *, size * whole + rest AS taken,
         CASE WHEN size * whole + rest > 0 THEN before / words * (1 + [0.5, 1.0, 2.0][weight])
           / (1 + sqrt(1 + ([0.5, 1.0, 2.0][weight] - 1) * (before / words * (1 + [0.5, 1.0, 2.0][weight])))) END AS t
  FROM passed
)
SELECT doc_id, source, size, source_size, target, taken,
       CASE WHEN size > 0 THEN whole + CAST(rest > 0 AS BIGINT) ELSE 0 END AS passes, t AS time,
       floor(coalesce(d1, 0) * ((2 * t - 0.5 * t * t) / 1.5) + coalesce(d2, 0) * t
             + coalesce(d3, 0) * ((2 * t + t * t) / 3) + 0.5) :: BIGINT AS position
FROM timed, demand
"""

OP11 = r"""
WITH found AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
           lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), places AS (
  SELECT id, lang, source, unnest(terms) AS term FROM found
), kept AS (
  SELECT lang, term FROM places GROUP BY ALL HAVING count(DISTINCT id) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM places JOIN kept USING (lang, term) GROUP BY ALL
), sites AS (
  SELECT DISTINCT lang, source FROM found
), site_shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1)
             // (sum(coalesce(c.n, 0)) OVER w + count(*) OVER w) AS p
  FROM sites s JOIN kept k ON s.lang = k.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
  WINDOW w AS (PARTITION BY s.lang, s.source)
), lang_counts AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL
), lang_shares AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER w + count(*) OVER w) AS q
  FROM lang_counts WINDOW w AS (PARTITION BY lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM site_shares a JOIN site_shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), scored AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM sites a JOIN sites b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q
  FROM site_shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM scored
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP12 = """
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents
), sized AS (
  SELECT *, length(body) // 2 AS n FROM texts
), places AS (
  SELECT id, body, unnest(range(0, n - 199)) AS i FROM sized WHERE n >= 200
), strings AS (
  SELECT id, i, md5_number(substr(body, 2 * i + 1, 400)) AS string FROM places
), repeated AS (
  SELECT string FROM strings GROUP BY string HAVING count(*) > 1
), begun AS (
  SELECT id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new
  FROM strings WHERE string IN (SELECT string FROM repeated)
), numbered AS (
  SELECT id, i, sum(new) OVER (PARTITION BY id ORDER BY i) AS span FROM begun
), spans AS (
  SELECT id, span, min(i) AS low, max(i) + 200 AS high FROM numbered GROUP BY id, span
), gaps AS (
  SELECT id, low, high, coalesce(lag(high) OVER (PARTITION BY id ORDER BY low), 0) AS since FROM spans
), cut AS (
  SELECT id, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS last,
         string_agg(substr(body, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS left_over
  FROM gaps JOIN texts USING (id) GROUP BY id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(left_over, '') || substr(body, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM sized LEFT JOIN cut USING (id)
"""

ORACLE: dict[str, str] = {
    "op3_quality_rules": OP3,
    "op4_ngram_jaccard_join": OP4,
    "op8_licence_scan": OP8,
    "op9_source_mix": OP9,
    "op11_source_audit": OP11,
    "op12_suffix_array_dedup": OP12,
}
