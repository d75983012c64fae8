"""DuckDB SQL of the queries that SQL can express, for tables that a quadratic join can still take."""

from __future__ import annotations

# The word patterns and the base32 alphabet.
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _words(pattern: str) -> str:
    folded = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({folded}, '{pattern}')"


# What follows `links(a, b)`, both directions there, to the end of each row's component.
_REACH = "reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"
_LEAST = "(SELECT a, min(b) AS low FROM reach GROUP BY a)"

OP3 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
g AS (SELECT * FROM v WHERE list_inner_product(e, e) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.vec_id <> y.vec_id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
{_REACH}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = vec_id LEFT JOIN {_LEAST} r ON r.a = vec_id
"""

OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_SPACED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle
           WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN {_LEAST} r ON r.a = d.doc_id
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_words(_PLAIN)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(_PLAIN)} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
       FROM (SELECT item, w, least(10, len(w)) AS k, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
             FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items t ON t.doc_id = d.doc_id
"""

# Five hexadecimal digits of the digest are four of base32.
OP10 = f"""
SELECT page_id, bytes AS payload_bytes,
       array_to_string([substr('{_BASE32}', CAST((CAST('0x' || substr(digest, i // 4 * 5 + 1, 5) AS BIGINT)
                                                   >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS bytes, sha1(coalesce(html, '')) AS digest,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS chosen FROM pages)
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
occurring AS (
  SELECT lang, unnest(w) AS phrase, 1 AS size FROM split
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]), 2 FROM split
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]), 3 FROM split),
counts AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM occurring GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
long_ AS (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:size], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM long_)),
lowest AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, c.k
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS outer_a
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM long_ WHERE size = 3) GROUP BY ALL)
SELECT p.lang, rank, phrase, a, l, r, n, score
FROM (SELECT v.*, row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, v.phrase) AS rank
      FROM lowest v LEFT JOIN inside i ON i.lang = v.lang AND i.phrase = v.phrase
      WHERE coalesce(100 * i.outer_a < 50 * v.a, true)) p
JOIN totals t ON t.lang = p.lang
WHERE rank <= 2000
"""

ORACLE = {"op3_embedding_dedup": OP3, "op8_minhash_dedup": OP8, "op9_decontaminate": OP9, "op10_warc": OP10, "op11_collocations": OP11}
