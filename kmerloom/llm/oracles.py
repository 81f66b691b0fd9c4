"""DuckDB SQL for the rows of queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

EMBEDDINGS = """WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 links AS MATERIALIZED (SELECT a.r AS u, b.r AS w FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
 reach AS (SELECT r, r AS s FROM v UNION SELECT reach.r, links.w FROM reach JOIN links ON reach.s = links.u),
 roots AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
 degrees AS (SELECT u AS r, count(*) AS n FROM links GROUP BY u)
 SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN roots USING (r) LEFT JOIN degrees USING (r)"""

SUFFIXES = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
 windows AS (SELECT doc_id, s, b[s:s + 99] AS w FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS s FROM d)),
 later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
 marks AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS step FROM later),
 spans AS (SELECT doc_id, min(s) AS s, max(s) + 100 AS e FROM (SELECT *, count(*) FILTER (step IS NULL OR step > 100) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marks) GROUP BY doc_id, span),
 cuts AS (SELECT doc_id, e AS s, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS e FROM (SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, 0, 1 FROM d)),
 kept AS (SELECT d.doc_id, string_agg(hex(b[cuts.s:coalesce(cuts.e, octet_length(b) + 1) - 1]), '' ORDER BY cuts.s) AS h FROM d JOIN cuts USING (doc_id) GROUP BY d.doc_id),
 lost AS (SELECT doc_id, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
 SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(h)) AS kept_sha256
 FROM d JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

QUALITY_COUNTS = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
 windows AS (SELECT doc_id, i, words[i:i + 4] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
 twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
 often AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
 lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
 counts AS (SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(often.n, 0) AS n_repeat_words
 FROM d LEFT JOIN often USING (doc_id) LEFT JOIN lines USING (doc_id))
 SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts"""

MIXING_TARGETS = rf"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
 sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
 ranked AS (SELECT *, (sum(n) OVER ()) - 3 * coalesce(sum(n) OVER before, 0) AS words_left, (sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0) AS weight_left,
 row_number() OVER (ORDER BY n / weight, source) AS no FROM sources WINDOW before AS (ORDER BY n / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 level AS (SELECT words_left / weight_left AS share FROM ranked WHERE words_left * weight / weight_left <= 3 * n ORDER BY no LIMIT 1)
 SELECT d.doc_id, d.size, n AS source_size, round(CASE WHEN share * weight > 3 * n THEN 3.0 * n ELSE share * weight END, 6) AS target
 FROM d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source, level"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
 SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
 FROM d WINDOW w AS (PARTITION BY t)"""

NEGATIVES = """WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scores AS MATERIALIZED (SELECT a.row_no AS anchor, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row_no <> b.row_no AND len(a.e) = len(b.e)),
 positives AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS slot FROM scores WHERE same QUALIFY slot <= 5)
 SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.slot ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
 FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3"""

PHRASES = rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents),
 pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
 grams AS (SELECT lang, size, phrase, count(*) AS f FROM (
 SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
 UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
 UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM pieces) GROUP BY ALL),
 totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
 often AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= 10),
 cuts AS (SELECT lang, size, phrase, f AS a, k, array_to_string(w[:k], ' ') AS left_part, array_to_string(w[k + 1:], ' ') AS right_part FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1)),
 scored AS (SELECT cuts.lang, cuts.size, cuts.phrase, a, k, p.f AS l, q.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
 FROM cuts JOIN often p ON p.lang = cuts.lang AND p.phrase = left_part JOIN often q ON q.lang = cuts.lang AND q.phrase = right_part),
 best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
 inside AS (SELECT lang, phrase, max(f) AS m FROM (SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM often WHERE size = 3) GROUP BY ALL),
 ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM best LEFT JOIN inside USING (lang, phrase) WHERE m IS NULL OR size = 3 OR 100 * m < 50 * a)
 SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
