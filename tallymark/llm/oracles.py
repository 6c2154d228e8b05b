"""SQL for the queries that SQL can express; DuckDB runs it over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op1_lm_scoring"] = f"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), place AS (
    SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w FROM worded
), gram AS (
    SELECT doc_id, i, w, lag(w, 1) OVER near || ' ' || w AS w2, lag(w, 2) OVER near || ' ' || lag(w, 1) OVER near || ' ' || w AS w3
    FROM place WINDOW near AS (PARTITION BY doc_id ORDER BY i)
), counted AS (
    SELECT doc_id, i, count(*) OVER () AS total, least(i, 3) AS longest, count(*) OVER (PARTITION BY w) AS all1,
           count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY w, doc_id) AS n1,
           count(w2) OVER (PARTITION BY w2) - count(w2) OVER (PARTITION BY w2, doc_id) AS n2,
           count(w3) OVER (PARTITION BY w3) - count(w3) OVER (PARTITION BY w3, doc_id) AS n3
    FROM gram
), beside AS (
    SELECT *, lag(n1) OVER near AS m1, lag(n2) OVER near AS m2 FROM counted WINDOW near AS (PARTITION BY doc_id ORDER BY i)
), scored AS (
    SELECT doc_id, longest, CASE WHEN n3 >= 1 THEN 3 WHEN n2 >= 1 THEN 2 ELSE 1 END AS used,
           CASE WHEN n3 >= 1 THEN ln(n3) - ln(m2) WHEN n2 >= 1 THEN ln(n2) - ln(m1) ELSE ln(all1) - ln(total) END AS score
    FROM beside
), summed AS (
    SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE used < longest) AS n_backed_off,
           CAST(sum(CAST(round_even((score + (longest - used) * ln(0.4)) * 1e6, 0) AS BIGINT)) AS BIGINT)
               AS score_micronats
    FROM scored GROUP BY doc_id
)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_backed_off, 0) AS n_backed_off,
       coalesce(score_micronats, 0) AS score_micronats,
       CAST(score_micronats AS DOUBLE) / n_tokens / 1e6 AS mean_score
FROM worded LEFT JOIN summed USING (doc_id)
"""

ORACLES["op4_line_dedup"] = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM split
), keyed AS (
    SELECT *, translate(trim(line, {BLANKS}), {LOWER}) AS line_key FROM line
), shared AS (
    SELECT line_key, max(doc_id) AS last FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT keyed.*, coalesce(doc_id < last, false) AS dropped
    FROM keyed LEFT JOIN shared ON keyed.line_key = shared.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
           AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES["op8_mixing"] = f"""
WITH sized AS (
    SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size,
           md5('mix:' || CAST(doc_id AS VARCHAR)) AS order_key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
           3 * source_size AS cap, sum(source_size) OVER () AS total
    FROM sources
), rising AS (
    SELECT *, coalesce(sum(cap) OVER before, 0) AS caps_before, sum(weight) OVER after AS weights_from
    FROM weighted
    WINDOW before AS (ORDER BY 10 * cap / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           after AS (ORDER BY 10 * cap / weight, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), clamped AS (
    SELECT *, cap * weights_from <= weight * (total - caps_before) AS capped FROM rising
), planned AS (
    SELECT source, source_size,
           CASE WHEN capped THEN CAST(cap AS DOUBLE)
                ELSE CAST(weight * (total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)) AS DOUBLE)
                     / CAST(sum(weight) FILTER (WHERE NOT capped) OVER () AS DOUBLE) END AS target
    FROM clamped
), shares AS (
    SELECT *, CAST(round(target) AS BIGINT) AS words,
           CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) // source_size END AS whole
    FROM planned
), placed AS (
    SELECT sized.*, source_size, target, whole, words - whole * source_size AS rest,
           coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY order_key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized JOIN shares ON sized.source IS NOT DISTINCT FROM shares.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""

ORACLES["op3_quality"] = r"""
WITH worded AS (
    SELECT doc_id, lang, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), place AS (
    SELECT doc_id, unnest(range(1, len(words) - 1)) AS i,
           unnest(list_transform(range(1, len(words) - 1),
                  lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS triple
    FROM worded WHERE len(words) >= 3
), triple AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, triple) AS n FROM place
), covered AS (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS word FROM triple WHERE n >= 2
), repeated AS (
    SELECT doc_id, count(DISTINCT word) AS n_repeat_words FROM covered GROUP BY doc_id
), counted AS (
    SELECT worded.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(len(lines) AS BIGINT) AS n_word_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM worded LEFT JOIN repeated ON worded.doc_id = repeated.doc_id
), based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), rules AS (
    SELECT doc_id, lang, base_failed, unnest([
        {'rule': 'symbols', 'part': n_symbols, 'whole': word_chars, 'risk': 0.03::DOUBLE},
        {'rule': 'dup_lines', 'part': n_dup_lines, 'whole': n_word_lines, 'risk': 0.01::DOUBLE},
        {'rule': 'repeats', 'part': n_repeat_words, 'whole': n_words, 'risk': 0.01::DOUBLE}
    ], recursive := true) FROM based
), seen AS (
    SELECT rules.*, quality = 1 AS good
    FROM rules JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IS NOT NULL) l
        ON rules.doc_id = l.doc_id
    WHERE NOT base_failed
), totals AS (
    SELECT lang, rule, risk, count(*) FILTER (WHERE good) AS n, 0.05 / count(*) OVER () AS level
    FROM seen GROUP BY lang, rule, risk
), tail AS (
    SELECT lang, rule, k, level, sum(term) OVER (PARTITION BY lang, rule ORDER BY k) AS tail
    FROM (SELECT lang, rule, level, k,
                 exp(CASE WHEN n = 0 THEN 0 ELSE lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) END
                     + k * ln(risk) + (n - k) * ln(1 - risk)) AS term
          FROM (SELECT *, unnest(range(CAST(n AS BIGINT) + 1)) AS k FROM totals))
), bounds AS (
    SELECT lang, rule, max(k) AS most FROM tail WHERE tail <= level GROUP BY lang, rule
), steps AS (
    SELECT lang, rule, c, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad
    FROM (SELECT *, unnest(range(1, 51)) AS c FROM seen) WHERE 100 * part > c * whole
    GROUP BY lang, rule, c
), proven AS (
    SELECT steps.* FROM steps JOIN bounds
        ON steps.lang IS NOT DISTINCT FROM bounds.lang AND steps.rule = bounds.rule
    WHERE good <= most AND bad > good
), best AS (
    SELECT lang, rule, c FROM proven
    QUALIFY bad - good = max(bad - good) OVER (PARTITION BY lang, rule)
), cut AS (
    SELECT lang, rule, list_sort(list(c))[1 + (count(*) - 1) // 2] AS cutoff FROM best GROUP BY lang, rule
), rejected AS (
    SELECT DISTINCT rules.doc_id FROM rules JOIN cut
        ON rules.lang IS NOT DISTINCT FROM cut.lang AND rules.rule = cut.rule
    WHERE 100 * part > cutoff * whole
)
SELECT based.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected.doc_id IS NULL AS kept
FROM based LEFT JOIN rejected ON based.doc_id = rejected.doc_id
"""

ORACLES["op2_chat_windows"] = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), counted AS (
    SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
           23 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
              + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 1 AS chars
    FROM given
), placed AS (
    SELECT *, row_number() OVER w - 1 AS place, sum(tokens) OVER w - tokens AS before
    FROM counted
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tokens, md5(text)
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), headed AS (
    SELECT *, place = 0 AND role = 'system' AS is_system,
           coalesce(max(tokens) FILTER (WHERE place = 0 AND role = 'system')
                    OVER (PARTITION BY conv_id), 0) AS head
    FROM placed
), begun AS (
    SELECT *, CASE WHEN is_system THEN 0 ELSE before - head END AS begin, greatest(384 - head, 1) AS room
    FROM headed
), spanned AS (
    SELECT *, CASE WHEN is_system THEN 0
                   ELSE 2 * (begin // room) + CAST(begin // room <> (begin + tokens - 1) // room AS INT)
              END AS span
    FROM begun
), spans AS (
    SELECT conv_id, span, min(begin) FILTER (WHERE NOT is_system) AS opens, bool_or(is_system) AS has_system
    FROM spanned GROUP BY conv_id, span
), chars AS (
    SELECT conv_id, sum(chars) AS chars FROM (
        SELECT conv_id, chars FROM spanned
        UNION ALL SELECT s.conv_id, t.chars FROM spans s JOIN spanned t
            ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND t.is_system AND NOT s.has_system
        UNION ALL SELECT s.conv_id, t.chars FROM spans s JOIN spanned t
            ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND NOT t.is_system
               AND t.begin < s.opens AND t.begin >= s.opens - 128
    ) GROUP BY conv_id
)
SELECT p.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(any_value(chars.chars) AS BIGINT) AS formatted_chars
FROM placed p JOIN chars ON p.conv_id IS NOT DISTINCT FROM chars.conv_id
GROUP BY p.conv_id
"""

ORACLES["op11_phrases"] = f"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece
), place AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), counted AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS gram, count(*) AS f
    FROM place, (VALUES (1), (2), (3)) lengths(m) WHERE i + m - 1 <= len(w) GROUP BY ALL
), total AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang
), candidate AS (
    SELECT *, string_split(gram, ' ') AS w FROM counted WHERE m >= 2 AND f >= 10
), inside AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS gram, f FROM candidate WHERE m = 3
), longer AS (
    SELECT lang, gram, max(f) AS longer FROM inside GROUP BY ALL
), kept AS (
    SELECT candidate.* FROM candidate LEFT JOIN longer USING (lang, gram)
    WHERE longer IS NULL OR 100 * longer < 50 * f
), halves AS (
    SELECT *, array_to_string(w[1:k], ' ') AS begins, array_to_string(w[k + 1:], ' ') AS ends
    FROM kept, (VALUES (1), (2)) cuts(k) WHERE k < m
), scored AS (
    SELECT h.lang, h.gram AS phrase, h.f AS a, x.f AS l, y.f AS r, k,
           (1000000::HUGEINT * h.f * h.f) // (x.f::HUGEINT * y.f) AS score
    FROM halves h JOIN counted x ON x.lang = h.lang AND x.gram = begins
        JOIN counted y ON y.lang = h.lang AND y.gram = ends
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLES["op13_repeats"] = """
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), place AS (
    SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM worded WHERE len(w) >= 20
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM place
), firsts AS (
    SELECT words, min(doc_id::HUGEINT * 4294967296 + i) AS first FROM windows GROUP BY words
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i
    FROM windows JOIN firsts USING (words) WHERE doc_id::HUGEINT * 4294967296 + i > first
), word AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM worded
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
    FROM word ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""

ORACLES["op12_hard_negatives"] = """
WITH vector AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
           CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vector a JOIN vector b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negative AS (
    SELECT p.anchor_id, positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT alike
        AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 5
"""
