"""DuckDB statements of the queries that SQL can express, in plain form."""

BLANK = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = """
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM texts),
lines AS (
  SELECT doc_id, UNNEST(parts) AS line, UNNEST(range(len(parts))) AS pos FROM split
)"""

OP8 = LINES + f""",
keyed AS (
  SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^{BLANK}+', ''), '{BLANK}+$', ''), '{UPPER}', '{LOWER}') AS key
  FROM lines
), shared AS (
  SELECT key, MAX(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3
), kept AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""

WORD = r"[^\x20\x09-\x0D]+"


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{characters}', '', 'g')))"


OP4 = LINES + f""",
words AS (SELECT doc_id, UNNEST(w) AS word, UNNEST(range(len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM texts)),
windows AS (
  SELECT doc_id, i, concat_ws(' ', word, a, b, c, d) AS run FROM (
    SELECT doc_id, i, word, LEAD(word, 1) OVER o AS a, LEAD(word, 2) OVER o AS b, LEAD(word, 3) OVER o AS c, LEAD(word, 4) OVER o AS d
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE d IS NOT NULL
), again AS (
  SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM (SELECT *, COUNT(*) OVER (PARTITION BY doc_id, run) AS times FROM windows), range(5) r(k)
  WHERE times > 1 GROUP BY doc_id
), judged AS (
  SELECT *, length(regexp_replace(line, '{BLANK}', '', 'g')) AS chars, len(regexp_extract_all(line, '{WORD}')) AS n,
         ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM lines
), ruled AS (
  SELECT *, n > 0 AND (
    10 * {_count("line", "[#*$%&|<>]")} > 3 * n OR 10 * {_count("line", "!")} > 3 * n
    OR (n < 3 AND NOT regexp_matches(line, '[.!?:;,)"\'\'…]{BLANK}*$'))
    OR n <= 12 * (len(regexp_extract_all(line, '©')) + len(regexp_extract_all(' ' || regexp_replace(lower(line), '([^a-z0-9_])', '\\1\\1', 'g') || ' ', '[^a-z0-9_](all  rights  reserved|licensed  under|released  under|copyright|cookies?|privacy  policy|terms  of  use|terms  of  service|lorem  ipsum|javascript|subscribe|sign  up|log  in|click  here)[^a-z0-9_]')))
  ) AS fails FROM judged
), docs AS (
  SELECT doc_id, SUM(n)::BIGINT AS n_words, SUM(chars)::BIGINT AS word_chars, SUM({_count("line", "[#*$%&|<>]")})::BIGINT AS n_symbols,
         COUNT(*) FILTER (n > 0 AND nth > 1) AS n_dup_lines, COUNT(*) FILTER (fails) AS n_failed_lines,
         COALESCE(SUM(chars) FILTER (fails), 0)::BIGINT AS lost_chars FROM ruled GROUP BY doc_id
), based AS (
  SELECT docs.*, COALESCE(again.n, 0) AS n_repeat_words FROM docs LEFT JOIN again ON docs.doc_id = again.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 60 * word_chars AS kept, n_failed_lines, lost_chars
FROM based
"""

_LEADS = ", ".join(f"LEAD(t, {k}) OVER o AS t{k}" for k in range(1, 11))
_MASKS = ((0, 1, 3, 7, 9, 10), (0, 3, 5, 8, 9, 10), (0, 1, 2, 5, 6, 8))


def _hits(mask: tuple, items: str = "") -> str:
    same = " AND ".join(f"d.t{k} = b.t{k}" for k in mask)
    return f"SELECT d.doc_id, d.pos, b.item_id, b.pos AS at, b.size FROM doc d JOIN item b ON {same} {items}"


OP7 = f"""
WITH doc_tokens AS (
  SELECT doc_id, UNNEST(w) AS t, UNNEST(range(len(w))) AS pos FROM (
    SELECT doc_id, regexp_split_to_array(lower(COALESCE(text, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM documents)
), item_tokens AS (
  SELECT item_id, len(w) AS size, UNNEST(w) AS t, UNNEST(range(len(w))) AS pos FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(COALESCE(text, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) >= 5
), doc AS (SELECT doc_id, pos, t AS t0, {_LEADS} FROM doc_tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
item AS (SELECT item_id, size, pos, t AS t0, {_LEADS} FROM item_tokens WINDOW o AS (PARTITION BY item_id ORDER BY pos)),
hits AS (SELECT ROW_NUMBER() OVER () AS hit, * FROM (
  {" UNION ALL ".join(_hits(mask) for mask in _MASKS)} UNION ALL {_hits(tuple(range(5)), "WHERE b.size < 9")})
), pairs AS (
  SELECT h.hit, h.doc_id, h.item_id, h.pos, d.t IS NOT NULL AS inside, COALESCE(d.t = i.t, FALSE) AS same
  FROM hits h JOIN item_tokens i ON i.item_id = h.item_id AND i.pos >= GREATEST(0, h.at - 6) AND i.pos < h.at + 17
  LEFT JOIN doc_tokens d ON d.doc_id = h.doc_id AND d.pos = h.pos - h.at + i.pos
), checked AS (
  SELECT hit, doc_id, item_id, pos FROM pairs GROUP BY ALL
  HAVING COUNT(*) FILTER (inside) >= LEAST(13, COUNT(*)) AND 100 * COUNT(*) FILTER (same) >= 80 * COUNT(*) FILTER (inside)
)
SELECT doc_id, item_id, COUNT(*) AS n_windows, MIN(pos) AS first_token FROM checked GROUP BY ALL
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
WITH doc_terms AS (
  SELECT row_id, doc_id, UNNEST(terms) AS term, len(terms) AS n FROM (
    SELECT ROW_NUMBER() OVER () AS row_id, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents)
), lists AS (SELECT row_id, doc_id, term, n, COUNT(*) AS tf FROM doc_terms GROUP BY ALL),
docs AS (SELECT DISTINCT row_id, n FROM doc_terms),
totals AS (SELECT COUNT(*) AS n_docs, SUM(n)::BIGINT AS n_terms FROM docs),
weights AS (
  SELECT term, CAST(FLOOR(1000 * LN((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM lists, totals GROUP BY term, n_docs
), asked AS (
  SELECT item_id, UNNEST(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), scores AS (
  SELECT a.item_id, l.doc_id, l.row_id, SUM(w.w * ((1000000000 * l.tf) // (1000 * l.tf + 8 * (25 + (75 * l.n * t.n_docs) // t.n_terms))))::BIGINT AS score
  FROM asked a JOIN weights w ON a.term = w.term JOIN lists l ON l.term = a.term, totals t GROUP BY ALL
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
) WHERE place <= 10
"""

STATEMENTS = {"op4_line_first_rules": OP4, "op7_benchmark_decontamination": OP7, "op8_line_dedup": OP8, "op13_hybrid_lexical_search": OP13}
