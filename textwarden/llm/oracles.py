"""Results of operators as SQL for DuckDB, where SQL expresses them."""

from __future__ import annotations

# Sets of four-word shingles, pairs that share one, and what can be reached over links.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
reached AS (
    SELECT a, b FROM links
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
lowest AS (SELECT a AS doc_id, min(b) AS low FROM reached GROUP BY a)
SELECT doc_id, coalesce(CAST(n AS BIGINT), 0) AS n_shingles,
    least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every item against every document that has one of its terms.
LEXICAL_SEARCH = rf"""
WITH texts AS (SELECT doc_id AS id, text FROM documents),
doc_terms AS (
    SELECT id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM texts),
postings AS (SELECT id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
lengths AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term, docs),
asked AS (
    SELECT item_id, term, count(*) AS c FROM (
        SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL),
scores AS (
    SELECT item_id, id AS doc_id, CAST(sum(c * w * (
        (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (id), corpus
    GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# All runs of one to three words, their cuts, and the longer runs around them.
COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
runs AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM words, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)
    GROUP BY ALL HAVING count(*) >= 10),
parts AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM runs WHERE k > 1),
cuts AS (
    SELECT lang, phrase, f, cut, array_to_string(w[:cut], ' ') AS one, array_to_string(w[cut + 1:], ' ') AS two
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM parts)),
scored AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, cut,
        CAST((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN runs x ON c.lang = x.lang AND c.one = x.phrase
    JOIN runs y ON c.lang = y.lang AND c.two = y.phrase),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
    SELECT lang, inner_phrase AS phrase, max(f) AS longer FROM (
        SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase
        FROM parts WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) LEFT JOIN around USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 50 * a QUALIFY rank <= 2000
"""
