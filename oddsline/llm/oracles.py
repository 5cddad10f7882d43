"""DuckDB SQL for the queries that SQL can express."""

_INSULTS = "'clown','disgusting','idiot','idiots','loser','losers','moron','morons','pathetic','scum','stupid','trash','worthless'"
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}]"
_EDGES = "'.,;:!?\"()*#$%&|<>\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u00bf\u00a1' || chr(39)"
_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
g AS (SELECT doc_id, pos, word, lag(word) OVER o AS prev,
             CASE WHEN lead(word, 4) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o,
                  lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS gram
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
t AS (SELECT doc_id, pos, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
c AS (SELECT doc_id, max(twice::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS 4 PRECEDING) AS hit FROM t),
r AS (SELECT doc_id, sum(hit) AS n_repeat FROM c GROUP BY 1),
e AS (SELECT doc_id, count(*) FILTER (word = prev) AS n_echoes,
             count(*) FILTER (regexp_matches(word, '^[^a-z]*[A-Z][^a-z]*$') AND word = upper(word)) AS n_shouted,
             count(*) FILTER (word LIKE '%!!') AS n_marked,
             sum(length(regexp_replace(word, '{_UNSPACED}', '', 'g'))) FILTER (
                 length(regexp_replace(word, '{_UNSPACED}', '', 'g')) > 1000) AS n_endless,
             count(*) FILTER (trim(lower(word), '.,;:!?"''()*#$%&|<>') IN ({_INSULTS})) AS n_insults
      FROM g GROUP BY 1),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM
        (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE trim(line, {_WS}) <> '' GROUP BY 1),
lab AS (SELECT doc_id, max(toxic) = 1 AS toxic FROM labels
        WHERE doc_id IS NOT NULL AND toxic IS NOT NULL GROUP BY 1),
fw AS (SELECT doc_id, lang, pos, trim(word, {_EDGES}) AS word FROM
         (SELECT doc_id, lang, unnest(words) AS word, unnest(range(len(words))) AS pos FROM
            (SELECT doc_id, lang, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS words FROM documents))),
lw AS (SELECT DISTINCT doc_id, lang, toxic, word FROM fw JOIN lab USING (doc_id) WHERE word <> ''),
tot AS (SELECT lang, count(*) FILTER (toxic) AS toxics, count(*) FILTER (NOT toxic) AS cleans
        FROM documents JOIN lab USING (doc_id) GROUP BY 1),
lex AS (SELECT k.lang, k.word FROM
          (SELECT lang, word, count(*) FILTER (toxic) AS a, count(*) FILTER (NOT toxic) AS b FROM lw GROUP BY 1, 2) k
        JOIN tot ON k.lang IS NOT DISTINCT FROM tot.lang
        WHERE a >= 3 AND a >= 0.01::DOUBLE * toxics AND a * (cleans + 1) >= 20 * (b + 0.5::DOUBLE) * toxics),
y AS (SELECT doc_id, pos, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) < 50 AS close FROM fw
      WHERE word IN (SELECT word FROM lex WHERE fw.lang IS NULL OR lex.lang = fw.lang)),
x AS (SELECT doc_id, count(*) AS n_toxic, count(*) FILTER (close) AS n_close FROM y GROUP BY 1),
m AS (SELECT w.doc_id, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_shouted, 0) AS n_shouted, coalesce(n_marked, 0) AS n_marked,
             coalesce(n_insults, 0) AS n_insults, coalesce(n_endless, 0) AS n_endless,
             length(text) - length(regexp_replace(text, '{_UNSPACED}', '', 'g')) AS n_unspaced,
             coalesce(n_echoes, 0) AS n_echoes, coalesce(n_toxic, 0) AS n_toxic, coalesce(n_close, 0) AS n_close
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN x USING (doc_id)),
f AS (SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
        + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 16 * (word_chars < 2 * n_words OR word_chars - n_unspaced > 15 * n_words)::BIGINT
        + 32 * (100 * n_shouted > 50 * n_words)::BIGINT + 64 * (100 * n_marked > 30 * n_words)::BIGINT
        + 128 * (n_insults >= 2 AND 400 * n_insults >= n_words)::BIGINT + 256 * (10 * n_endless > word_chars)::BIGINT
        + 512 * (100 * n_echoes > 25 * n_words)::BIGINT
        + 1024 * (n_toxic >= 3 OR n_close >= 1)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

NEAR_DEDUP_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 3, 2)),
         lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * common >= 85 * (x.n + y.n - common)),
r(id, other) AS (SELECT a, b FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other),
m AS (SELECT id, min(other) AS least_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(least_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.id = d.doc_id
"""

DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
k AS (SELECT item_id, words, least(len(words), 10) AS width FROM i WHERE len(words) > 0),
v AS (SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(words) - width + 2),
         lambda p: array_to_string(words[p:p + width - 1], ' '))) AS win FROM k),
widths AS (SELECT DISTINCT width FROM k),
g AS (SELECT doc_id, width, unnest(range(1, len(words) - width + 2)) AS pos,
         unnest(list_transform(range(1, len(words) - width + 2),
         lambda p: array_to_string(words[p:p + width - 1], ' '))) AS win FROM d, widths WHERE len(words) >= width),
h AS (SELECT doc_id, pos, width, item_id FROM g JOIN v USING (width, win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
        (SELECT doc_id, unnest(range(pos, pos + width)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY 1)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
