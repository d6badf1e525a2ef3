"""DuckDB SQL of the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

#: Cosine of all pairs, then reachability.
OP1 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e
  FROM embeddings
), good AS (
  SELECT r, vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS id
  FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(r, via) AS (
  SELECT r, r FROM v
  UNION
  SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.via
), least AS (
  SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.via GROUP BY reach.r
), degree AS (
  SELECT a AS r, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN degree USING (r)
"""

#: Every string of 200 bytes by its digest; the text as hexadecimal digits, two for a byte.
OP4 = """
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT r, unnest(range(0, len(h) // 2 - 199)) AS i, h FROM t WHERE len(h) >= 400
), named AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM starts
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM named) WHERE n > 1
), marked AS (
  SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 200, true) AS new FROM twice
), grouped AS (
  SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM marked
), spans AS (
  SELECT r, g, min(i) AS a, max(i) + 200 AS z FROM grouped GROUP BY r, g
), pieces AS (
  SELECT t.r, s.g, substr(t.h, 2 * s.z + 1, 2 * (coalesce(lead(s.a) OVER (PARTITION BY t.r ORDER BY s.g), len(t.h) // 2) - s.z)) AS behind,
         s.z - s.a AS n, CASE WHEN s.g = 1 THEN substr(t.h, 1, 2 * s.a) ELSE '' END AS ahead
  FROM t JOIN spans s USING (r)
), kept AS (
  SELECT r, string_agg(ahead || behind, '' ORDER BY g) AS h, sum(n) AS gone, count(*) AS spans FROM pieces GROUP BY r
)
SELECT t.doc_id, (len(t.h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN kept USING (r)
"""

#: Distinct shingles, intersections by counting, then reachability.
OP8 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM w
), n AS (
  SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id
), shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r
), link AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM shared JOIN n x ON x.r = shared.a JOIN n y ON y.r = shared.b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(id, via) AS (
  SELECT DISTINCT doc_id, doc_id FROM w
  UNION
  SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.via
), least AS (
  SELECT id, min(via) AS component_id FROM reach GROUP BY id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM w LEFT JOIN n USING (r) LEFT JOIN least ON least.id = w.doc_id
"""

#: All sequences of 1 to 5 words, counted; 1000 a n in 128 bits.
OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
), f AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang
), cand AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 100
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS part
  FROM (SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i FROM cand, (SELECT unnest(range(2, 5)) AS k) WHERE k < m)
), gone AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_parts p ON p.lang = c.lang AND p.part = c.phrase WHERE 100 * p.a >= 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, w, unnest(range(1, m)) AS k FROM cand ANTI JOIN gone USING (lang, phrase)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN total USING (lang)
  JOIN f x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.m = len(w) - k AND y.phrase = array_to_string(w[k + 1:], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

#: All anchors against all rows.
OP13 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, b.r AS o,
         list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT r, anchor_id, o, other_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.*, n.other_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.o ORDER BY n.score DESC, n.other_id)::INT AS rank
  FROM positive p JOIN pair n ON n.r = p.r AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
