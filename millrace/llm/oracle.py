"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from millrace.llm import quality_rules as rules


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(characters: str) -> str:
    return _quote("[" + "".join("\\" + c if c in "\\]^-[$.|*&" else c for c in characters) + "]")


_WORD = _quote(r"[^\x20\x09-\x0D]+")
_N = "len(regexp_extract_all({}, {}))"

QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, {_WORD}) AS w FROM docs
), windows AS (
  SELECT r, w, unnest(range(1, greatest(len(w) - {rules.WINDOW - 2}, 1)::BIGINT)) AS i FROM words
), grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + {rules.WINDOW - 1}]) AS n FROM windows
), covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + {rules.WINDOW})) AS p FROM grams WHERE n > 1) GROUP BY r
), split AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), lines AS (
  SELECT r, line, regexp_extract_all(line, {_WORD}) AS w, {_N.format('line', _class(rules.SEPARATORS))} AS seps,
    length(array_to_string(regexp_extract_all(line, {_quote('(?i)' + rules.BOILERPLATE)}), '')) AS phrase_chars
  FROM split WHERE regexp_matches(line, {_WORD})
), judged AS (
  SELECT r, line, list_sum(list_transform(w, lambda x: length(x))) AS chars,
    (4 * seps >= len(w) AND seps >= 2)
    OR 10 * {_N.format('line', _class(rules.SYMBOLS))} > length(line)
    OR (len(w) >= 3 AND 2 * {_N.format('line', _quote('!'))} >= len(w))
    OR (len(w) >= 8 AND 2 * len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) >= len(w))
    OR (phrase_chars > 0 AND (len(w) <= {rules.BOILERPLATE_LINE_WORDS} OR 2 * phrase_chars >= length(line)))
    OR (len(w) < {rules.LONG_LINE_WORDS} AND NOT contains({_quote(rules.TERMINAL)}, right(w[-1], 1))) AS failed
  FROM lines
), by_doc AS (
  SELECT r, sum(n - 1) AS dups FROM (SELECT r, line, count(*) AS n FROM lines GROUP BY r, line) GROUP BY r
), lost AS (
  SELECT r, count(*) FILTER (WHERE failed) AS n_failed_lines,
    coalesce(sum(chars) FILTER (WHERE failed), 0) AS lost_chars FROM judged GROUP BY r
), counted AS (
  SELECT words.r, doc_id, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    {_N.format('text', _class(rules.SYMBOLS))} AS n_symbols,
    coalesce(dups, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_failed_lines, 0) AS n_failed_lines,
    coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM words LEFT JOIN covered USING (r) LEFT JOIN by_doc USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  n_failed_lines, lost_chars,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
    AND 100 * lost_chars <= {rules.MAX_LOST_PERCENT} * word_chars AS kept
FROM counted
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), formatted AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length('<s>[INST][/INST]</s>')
      + length(regexp_replace(regexp_replace(role, '<(~*/?s)>', '<~\1>', 'g'), '\[(~*/?INST)\]', '[~\1]', 'g'))
      + length(regexp_replace(regexp_replace(text, '<(~*/?s)>', '<~\1>', 'g'), '\[(~*/?INST)\]', '[~\1]', 'g'))
    ) OVER w AS chars
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) FILTER (WHERE role = 'assistant' OR pos = n))::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id
"""

WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), stored AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS stored_id FROM payloads
), marked AS (
  SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM stored_id AS revisit FROM stored
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN revisit THEN stored_id END AS refers_to
FROM marked
"""

_TERM = _quote(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TERMS = f"regexp_extract_all(translate({{}}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_TERM})"

SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id::BIGINT AS doc_id, {_TERMS.format("coalesce(text, '')")} AS t FROM documents
), stats AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS docs_n, sum(len(t))::BIGINT AS terms_n FROM docs
), held AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, stats GROUP BY term, docs_n
), items AS (
  SELECT i, item_id, term, count(*) AS repeats
  FROM (SELECT i, item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term
    FROM (SELECT row_number() OVER () AS i, * FROM benchmark)) GROUP BY ALL
), scored AS (
  SELECT i, item_id, r, doc_id,
    sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs_n) // terms_n))))::BIGINT AS score
  FROM items JOIN held USING (term) JOIN weights USING (term), stats GROUP BY ALL
)
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

NEGATIVES = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id::BIGINT AS vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other_row, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r
), positives AS (
  SELECT r, other_id AS positive_id, other_row AS positive_row, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY r, positive_row ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (r)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE = {
    "op2_chat_format": CHAT,
    "op3_warc_index": WARC,
    "op6_quality_rules": QUALITY,
    "op12_ball_tree": SEARCH,
    "op13_hard_negatives": NEGATIVES,
}
