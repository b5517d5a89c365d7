"""The same results as SQL, for the text queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES = f"""
WITH pieces AS (
    SELECT lang, unnest(string_split_regex(body, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("text")} AS body FROM documents WHERE text IS NOT NULL)
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
windows AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest(range(1, 5)) AS size)
    WHERE i + size - 1 <= len(w)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
phrases AS (SELECT lang, size, phrase, count(*) AS f FROM windows GROUP BY lang, size, phrase HAVING count(*) >= 30),
cuts AS (
    SELECT lang, size, phrase, f, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:size], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1), (SELECT unnest(range(1, 4)) AS k)
    WHERE k < size
),
scores AS (
    SELECT c.lang, c.size, c.phrase, c.f AS a, p.f AS l, q.f AS r,
        ((2000000::HUGEINT * c.f) // (p.f::HUGEINT + q.f))::BIGINT AS score,
        row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.f) // (p.f::HUGEINT + q.f), c.k) AS place
    FROM cuts c JOIN phrases p ON p.lang = c.lang AND p.phrase = c.first_part
    JOIN phrases q ON q.lang = c.lang AND q.phrase = c.rest
),
candidates AS (SELECT * FROM scores WHERE place = 1),
inner_phrases AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f
    FROM (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE size > 2),
        (SELECT unnest(range(2, 4)) AS m), (SELECT unnest(range(1, 4)) AS i)
    WHERE m < size AND i + m - 1 <= size
),
around AS (SELECT lang, phrase, max(f) AS longer FROM inner_phrases GROUP BY lang, phrase),
ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, encode(c.phrase)) AS rank
    FROM candidates c LEFT JOIN around o ON o.lang = c.lang AND o.phrase = c.phrase
    WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(LOWER.format("text"))

SEARCH = f"""
WITH bodies AS (SELECT doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
filled AS (SELECT doc_id, terms, len(terms)::BIGINT AS size FROM bodies WHERE len(terms) > 0),
facts AS (SELECT count(*)::BIGINT AS docs, sum(size)::BIGINT AS total FROM filled),
counts AS (
    SELECT doc_id, size, term, count(*)::BIGINT AS tf
    FROM (SELECT doc_id, size, unnest(terms) AS term FROM filled) GROUP BY doc_id, size, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term), facts
),
impacts AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * size * docs) // total)) AS impact
    FROM counts, facts
),
asked AS (
    SELECT item_id, term, count(*)::BIGINT AS times
    FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY item_id, term
),
scores AS (
    SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
