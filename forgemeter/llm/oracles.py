"""DuckDB SQL for the corpus queries that SQL can express."""

OP2 = """
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           coalesce(length(text) - length(translate(text, '#*$%&|<>', '')), 0) AS symbols
    FROM documents
), keyed AS (
    SELECT doc_id, source, size,
           -ln((CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
               / 4503599627370496::DOUBLE)
           / (1.0::DOUBLE / (1.0::DOUBLE + 10.0::DOUBLE * symbols / greatest(size, 1))) AS key
    FROM sized
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM keyed GROUP BY source
), weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(place - 1) % 3 + 1] AS weight FROM sources
), filled AS (
    SELECT *, 2 * source_size / weight AS fill FROM weighed
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum(2 * source_size) OVER (ORDER BY fill, place
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY fill, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM filled
), common AS (
    SELECT arg_min(level, (fill, place)) AS common FROM levels WHERE fill > level
), targets AS (
    SELECT source, source_size,
           CASE WHEN common IS NULL OR fill <= common THEN CAST(2 * source_size AS DOUBLE)
                ELSE weight * common END AS target
    FROM levels CROSS JOIN common
), ordered AS (
    SELECT k.doc_id, k.size, t.source_size, t.target,
           CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
           coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
            + greatest(0, least(size, budget
                - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before)) AS BIGINT)
           AS taken
FROM ordered
"""

# Spans as "start-stop" joined by commas.
OP7 = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
           row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) AS from_end
    FROM conversations
), before_last AS (
    SELECT conv_id, text FROM turns WHERE role = 'assistant' AND from_end = 2
), sides AS (
    SELECT t.conv_id, t.k, t.role, t.text AS chosen,
           CASE WHEN t.role = 'assistant' AND t.from_end = 1 THEN coalesce(b.text, '') ELSE t.text END AS rejected
    FROM turns t LEFT JOIN before_last b ON t.conv_id IS NOT DISTINCT FROM b.conv_id
), shared AS (
    SELECT conv_id, coalesce(min(k) FILTER (chosen <> rejected) - 1, count(*)) AS prompt_turns
    FROM sides GROUP BY conv_id
), rendered AS (
    SELECT s.conv_id, s.k, s.role, p.prompt_turns,
           '<|' || role || '|>' || chr(10) || chosen || '<|end|>' || chr(10) AS c,
           '<|' || role || '|>' || chr(10) || rejected || '<|end|>' || chr(10) AS r
    FROM sides s JOIN shared p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
    SELECT *, sum(length(c)) OVER w AS c_stop, sum(length(r)) OVER w AS r_stop
    FROM rendered WINDOW w AS (PARTITION BY conv_id ORDER BY k)
)
SELECT conv_id, CAST(any_value(prompt_turns) AS BIGINT) AS prompt_turns,
       coalesce(string_agg(c, '' ORDER BY k) FILTER (k <= prompt_turns), '') AS prompt,
       coalesce(string_agg(c, '' ORDER BY k) FILTER (k > prompt_turns), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY k) FILTER (k > prompt_turns), '') AS rejected,
       coalesce(string_agg(CAST(c_stop - length(c) + 14 AS BIGINT) || '-' || CAST(c_stop AS BIGINT), ',' ORDER BY k)
                FILTER (k > prompt_turns AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(CAST(r_stop - length(r) + 14 AS BIGINT) || '-' || CAST(r_stop AS BIGINT), ',' ORDER BY k)
                FILTER (k > prompt_turns AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY conv_id
"""

# All runs of 50 words, those that stand at an earlier place too, and the texts word by word without them.
OP6 = """
WITH words AS (
    SELECT doc_id, text, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS spaced
    FROM documents
), bare AS (
    SELECT doc_id, list_transform(spaced, lambda w: regexp_replace(w, '^[\\x20\\x09-\\x0D]+', '')) AS own FROM words
), windows AS (
    SELECT doc_id, i, md5(array_to_string(own[i:i + 49], ' ')) AS run
    FROM (SELECT doc_id, own, unnest(range(1, len(own) - 48)) AS i FROM bare)
), repeated AS (
    SELECT doc_id, i
    FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS place FROM windows)
    WHERE place > 1
), one_by_one AS (
    SELECT doc_id, len(spaced) AS n, generate_subscripts(spaced, 1) AS i, unnest(spaced) AS word,
           regexp_extract(text, '[\\x20\\x09-\\x0D]*$') AS ending
    FROM words
), marked AS (
    SELECT w.doc_id, w.i, CASE WHEN w.i = n THEN word || ending ELSE word END AS word,
           max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END)
               OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM one_by_one w LEFT JOIN repeated r ON w.doc_id = r.doc_id AND w.i = r.i
), trimmed AS (
    SELECT doc_id, i, gone, CASE WHEN lag(gone) OVER (PARTITION BY doc_id ORDER BY i) = 1
                                 THEN regexp_replace(word, '^[\\x20\\x09\\x0B-\\x0D]+\\n', chr(10)) ELSE word END AS word
    FROM marked
), kept AS (
    SELECT doc_id, string_agg(word, '' ORDER BY i) FILTER (gone = 0) AS text, max(gone) FILTER (i = 1) AS begins_gone
    FROM trimmed GROUP BY doc_id
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL WHEN k.doc_id IS NULL THEN d.text
            WHEN begins_gone = 1 THEN regexp_replace(coalesce(k.text, ''), '^[\\x20\\x09-\\x0D]+', '')
            ELSE k.text END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# Every phrase of up to five words with its occurrences, then cuts, containment and ranks.
OP12 = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM listed
), spans AS (
    SELECT lang, words, i, unnest(range(1, 6)) AS size FROM starts
), counted AS (
    SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, any_value(size) AS size, count(*) AS a
    FROM spans WHERE i + size - 1 <= len(words)
    GROUP BY lang, array_to_string(words[i:i + size - 1], ' ')
), totals AS (
    SELECT lang, sum(a) AS n FROM counted WHERE size = 1 GROUP BY lang
), frequent AS (
    SELECT lang, phrase, size, a, string_split(phrase, ' ') AS words FROM counted WHERE a >= 100
), cuts AS (
    SELECT lang, phrase, size, a, words, unnest(range(1, size)) AS k FROM frequent WHERE size > 1
), weighed AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.k, f.a AS l, s.a AS r, t.n,
           (1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * s.a) AS score
    FROM cuts c
    JOIN frequent f ON f.lang = c.lang AND f.phrase = array_to_string(c.words[1:c.k], ' ')
    JOIN frequent s ON s.lang = c.lang AND s.phrase = array_to_string(c.words[c.k + 1:c.size], ' ')
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM weighed
), candidates AS (
    SELECT * FROM lowest WHERE place = 1
), kept AS (
    SELECT c.* FROM candidates c
    WHERE NOT EXISTS (
        SELECT 1 FROM candidates b
        WHERE b.lang = c.lang AND b.size > c.size AND b.a >= c.a
              AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
    )
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE = {
    "op2_mix_sources": OP2,
    "op6_line_dedup": OP6,
    "op7_preference_chat": OP7,
    "op12_collocations": OP12,
}
