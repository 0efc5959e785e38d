"""The queries of this package in DuckDB SQL, where SQL can express them at this size."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

MIXING = rf"""
WITH RECURSIVE rows AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST([1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight
    FROM rows GROUP BY source
), filling(round, source, source_size, weight, stopped, level) AS (
    SELECT 0, source, source_size, weight, false, sum(source_size) OVER () / sum(weight) OVER () FROM sources
    UNION ALL
    SELECT round + 1, source, source_size, weight, now,
        (sum(source_size) OVER () - sum(CASE WHEN now THEN 3 * source_size ELSE 0 END) OVER ())
            / sum(CASE WHEN now THEN 0 ELSE weight END) OVER ()
    FROM (
        SELECT *, stopped OR level * weight > 3 * source_size AS now,
            bool_or(NOT stopped AND level * weight > 3 * source_size) OVER () AS again
        FROM filling
    ) WHERE again
), targets AS (
    SELECT source, source_size,
        CASE WHEN stopped THEN CAST(3 * source_size AS DOUBLE) ELSE weight * level END AS target,
        CAST(CAST('0x' || substr(md5('0/' || coalesce('=' || source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS start
    FROM filling WHERE round = (SELECT max(round) FROM filling)
), ranked AS (
    SELECT doc_id, source, size, row_number() OVER (
        PARTITION BY source
        ORDER BY length(bin(size)), substr(bin(size), 1, 4), substr(hash, 1, 2), size, hash, doc_id
    ) AS place
    FROM (SELECT *, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash FROM rows)
), taken AS (
    SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate, start, place
    FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
    size * least(CAST(floor(start + place * rate) - floor(start + (place - 1) * rate) AS BIGINT), 3) AS taken
FROM taken
"""


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Links as they are defined, and the smallest document that each one reaches.
NEAR_COPIES = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), {_WORDS}) AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM texts, unnest(range(1, greatest(2, len(w)))) AS places(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), linked AS (
    SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 80 * (m.n + n.n - c)
), links AS (
    SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

TOP_K = f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings WHERE {_USABLE}
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 20
"""

VECTORS = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS size
    FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
          FROM embeddings WHERE label IS NOT NULL AND {_USABLE})
    WHERE list_inner_product(v, v) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE len(x.v) = len(y.v) AND list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.98
), reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reached.vec_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""


#: crc32 by its table (the reversed polynomial 0xEDB88320), a byte of UTF-8 at a time.
VARIANTS = rf"""
WITH RECURSIVE divided(i, step, c) AS (
    SELECT i, 0, i FROM unnest(range(256)) AS bytes(i)
    UNION ALL
    SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM divided WHERE step < 8
), by_byte AS (
    SELECT list(c ORDER BY i) AS crc FROM divided WHERE step = 8
), runs AS (
    SELECT translate(run, '{_CAPITALS}', '{_CAPITALS.lower()}') AS run, coalesce(CAST(doc_id AS VARCHAR), '') AS id
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7
), hashed AS (
    SELECT run, xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END))),
        lambda state, b: xor(state >> 8, crc[(xor(state, b) & 255) + 1])), 4294967295) AS h
    FROM runs, by_byte
), words AS (
    SELECT word, count(*) AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
    ) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), cut AS (
    SELECT word, n, left(word, CAST(i - 1 AS INTEGER)) AS front, substr(word, i + 1) AS back FROM words, unnest(range(1, length(word) + 1)) AS places(i)
), near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.front = b.front AND a.back = b.back AND a.word <> b.word
    UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = front || back
    UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = front || back
), best AS (
    SELECT near.word, other, words.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY words.n DESC, other) AS place
    FROM near JOIN words ON words.word = other
), forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * words.n THEN other END AS form,
        CASE WHEN other_n >= 10 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word AND place = 1
), steps(word, now, next) AS (
    SELECT word, word, form FROM forms
    UNION ALL
    SELECT steps.word, steps.next, forms.form FROM steps JOIN forms ON forms.word = steps.next
)
SELECT word, n, n_near, form, form_n, now AS root FROM forms JOIN steps USING (word) WHERE next IS NULL
"""

_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

LEXICAL = rf"""
WITH texts AS (
    SELECT doc_id, row_number() OVER () AS row, list_transform(regexp_extract_all(coalesce(text, ''), {_TERMS}),
        lambda t: translate(t, '{_CAPITALS}', '{_CAPITALS.lower()}')) AS terms FROM documents
), sizes AS (
    SELECT doc_id, row, CAST(len(terms) AS BIGINT) AS n, sum(len(terms)) OVER () AS whole, count(*) OVER () AS docs FROM texts WHERE len(terms) > 0
), asked AS (
    SELECT item_id, translate(t, '{_CAPITALS}', '{_CAPITALS.lower()}') AS term, count(*) AS repeats
    FROM (SELECT item_id, unnest(regexp_extract_all(text, {_TERMS})) AS t FROM benchmark) GROUP BY ALL
), counted AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM texts) GROUP BY ALL
), held AS (
    SELECT term, count(*) AS df FROM counted GROUP BY term
), scored AS (
    SELECT item_id, row, sum(CAST(repeats * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * CAST(25 + (75 * n * docs) // whole AS BIGINT))) AS BIGINT)) AS score, any_value(doc_id) AS doc_id
    FROM asked JOIN counted USING (term) JOIN held USING (term) JOIN sizes USING (row) GROUP BY item_id, row
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE place <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_shingles": NEAR_COPIES,
        "op4_mixing": MIXING,
        "op7_topk": TOP_K,
        "op10_vectors": VECTORS,
        "op11_variants": VARIANTS,
        "op12_lexical": LEXICAL,
    }
