"""The text queries in DuckDB's SQL, where SQL can express them."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate(%s, '{_UPPER}', '{_UPPER.lower()}')"
_WORDS = (
    "list_filter(regexp_split_to_array("
    + _LOWER % "coalesce(text, '')"
    + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), limits AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
              (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
         source_size * 2.0::DOUBLE AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS everything
  FROM sources
), levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS turn,
         (everything - coalesce(sum(cap) OVER (
            ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits
), goals AS (
  SELECT source, source_size,
         least(cap, coalesce(w * (SELECT arg_min(level, turn) FROM levels WHERE level * w < cap),
                             cap)) AS target
  FROM levels
), wanted AS (
  SELECT *, floor(target / nullif(source_size, 0))::BIGINT AS copies,
         greatest(0.0, target - floor(target / nullif(source_size, 0)) * source_size) AS rest
  FROM goals
), cells AS (
  SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL
), ks AS (
  SELECT c.source, c.size,
         (rest - coalesce(sum(n * size) OVER (
            PARTITION BY c.source ORDER BY size DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(n * size * size) OVER (PARTITION BY c.source ORDER BY size DESC
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS k
  FROM cells c JOIN wanted g ON c.source IS NOT DISTINCT FROM g.source
), chosen AS (
  SELECT source, max(size) AS top, arg_max(k, size) AS k FROM ks WHERE k * size < 1 GROUP BY source
), drawn AS (
  SELECT d.*, g.source_size, g.target, g.copies, g.rest,
         coalesce(g.rest > 0 AND d.size > c.top, false) AS certain, c.k * d.size AS chance,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT
           + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM d JOIN wanted g ON d.source IS NOT DISTINCT FROM g.source
         LEFT JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source
), ranked AS (
  SELECT *, CASE WHEN chance > 0 AND NOT certain
                 THEN u / (1 - u) * (1 - chance) / nullif(chance, 0) END AS q
  FROM drawn
), summed AS (
  SELECT *, sum(CASE WHEN certain THEN size ELSE 0 END) OVER (PARTITION BY source)
            + sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (
                PARTITION BY source ORDER BY q NULLS FIRST, doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM ranked
), counted AS (
  SELECT *, CASE WHEN size > 0 THEN copies
            + CASE WHEN certain OR (q IS NOT NULL AND upto - size / 2 <= rest) THEN 1 ELSE 0 END
            ELSE 0 END AS c
  FROM summed
)
SELECT doc_id, size, source_size, target, (c * size)::BIGINT AS taken, c::BIGINT AS copies, source
FROM counted
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
         array_to_string(list_slice(ws, s + 1, s + 10), ' ') AS gram
  FROM (SELECT *, unnest(range(0, greatest(len(ws) - 9, 1))) AS s FROM b WHERE len(ws) > 0)
), grams AS (
  SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM windows))
), found AS (
  SELECT doc_id, item_id, g.n, s FROM grams g JOIN windows w ON g.gram = w.gram AND g.n = w.n
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM found GROUP BY doc_id
), postings AS (
  SELECT doc_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM d
), counts AS (
  SELECT term, count(*) AS c FROM postings GROUP BY term
), parts AS (
  SELECT gram, n, unnest(string_split(gram, ' ')) AS term,
         generate_subscripts(string_split(gram, ' '), 1) AS place
  FROM (SELECT DISTINCT gram, n FROM windows)
), rare AS (
  SELECT gram, term, row_number() OVER (PARTITION BY gram ORDER BY c, place) AS rank
  FROM parts JOIN counts USING (term)
  QUALIFY count(*) OVER (PARTITION BY gram) = n
), together AS (
  SELECT DISTINCT a.doc_id, r.gram
  FROM rare r JOIN postings a ON r.rank = 1 AND a.term = r.term
  LEFT JOIN rare r2 ON r2.gram = r.gram AND r2.rank = 2
  LEFT JOIN postings b ON b.doc_id = a.doc_id AND b.term = r2.term AND abs(b.pos - a.pos) <= 9
  LEFT JOIN rare r3 ON r3.gram = r.gram AND r3.rank = 3
  LEFT JOIN postings c ON c.doc_id = a.doc_id AND c.term = r3.term AND abs(c.pos - a.pos) <= 9
  WHERE (r2.term IS NULL OR b.pos IS NOT NULL) AND (r3.term IS NULL OR c.pos IS NOT NULL)
), nears AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near
  FROM together JOIN windows USING (gram) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN nears USING (doc_id)
"""

URL_FILTER = r"""
WITH rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parsed AS (
  SELECT page_id, %s AS host,
         regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS best
  FROM parsed LEFT JOIN rules
       ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits WHERE best = 1
""" % (_LOWER % "regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1)")

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""

_FIELD = "CASE WHEN %s IS NULL THEN '-' ELSE octet_length(encode(%s::VARCHAR)) || ':' || %s::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.replace("%s", c) for c in ("doc_id", "source", "lang", "n_chars")) + " || "
# CRC-32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::UBIGINT for i in range(8)]),
    lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_LEAF + _FIELD.replace("%s", "text")}) AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_LEAF + _FIELD.replace("%s", "(" + _LOWER % "text" + ")")}) END AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), tree AS (
  SELECT source, 0 AS level, place, n, leaf AS digest FROM placed
  UNION ALL
  SELECT source, any_value(level) + 1, place // 16, (any_value(n) + 15) // 16,
         sha256(string_agg(digest, '' ORDER BY place))
  FROM tree WHERE n > 1 GROUP BY source, place // 16
), sources AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
         count(*) OVER () AS n
  FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, place, n, subroot AS digest FROM sources
  UNION ALL
  SELECT any_value(level) + 1, place // 16, (any_value(n) + 15) // 16,
         sha256(string_agg(digest, '' ORDER BY place))
  FROM top WHERE n > 1 GROUP BY place // 16
), runs AS (
  SELECT source, level, place // 16 AS run, list(digest ORDER BY place) AS slots
  FROM tree WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, place // 16 AS run, list(digest ORDER BY place) AS slots
  FROM top WHERE n > 1 GROUP BY ALL
), folded AS (
  SELECT doc_id, source, leaf, place AS leaf_place, 0 AS level, place, coalesce(tampered, leaf) AS node, '' AS proof
  FROM placed
  UNION ALL
  SELECT doc_id, f.source, leaf, leaf_place, f.level + 1, place // 16,
         sha256(array_to_string(list_slice(slots, 1, place % 16) || [node] || list_slice(slots, place % 16 + 2, 16), '')),
         proof || array_to_string(list_slice(slots, 1, place % 16) || list_slice(slots, place % 16 + 2, 16), '')
  FROM folded f JOIN runs r
    ON f.source IS NOT DISTINCT FROM r.source AND f.level = r.level AND f.place // 16 = r.run
), in_source AS (
  SELECT * FROM folded
  QUALIFY row_number() OVER (PARTITION BY source, leaf_place ORDER BY level DESC) = 1
), whole AS (
  SELECT f.doc_id, f.source, f.leaf, f.leaf_place, s.subroot, 0 AS level, s.place, f.node, f.proof
  FROM in_source f JOIN sources s ON f.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT doc_id, source, leaf, leaf_place, subroot, w.level + 1, place // 16,
         sha256(array_to_string(list_slice(slots, 1, place % 16) || [node] || list_slice(slots, place % 16 + 2, 16), '')),
         proof || array_to_string(list_slice(slots, 1, place % 16) || list_slice(slots, place % 16 + 2, 16), '')
  FROM whole w JOIN top_runs r ON w.level = r.level AND w.place // 16 = r.run
), ends AS (
  SELECT * FROM whole
  QUALIFY row_number() OVER (PARTITION BY source, leaf_place ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = digest AS verified
FROM ends, (SELECT digest FROM top WHERE n = 1)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(%s, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), parts AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), totals AS (
  SELECT lang, sum(len(ws))::HUGEINT AS n FROM parts GROUP BY lang
), counted AS (
  SELECT lang, k, array_to_string(list_slice(ws, s, s + k - 1), ' ') AS phrase, count(*)::HUGEINT AS f
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS s FROM parts, range(1, 6) t(k))
  GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM counted WHERE k > 1
), within AS (
  SELECT lang, array_to_string(list_slice(ws, s, s + j - 1), ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS s FROM candidates, range(2, 5) t(j) WHERE j < k)
  GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.f, n, i, a.f AS l, b.f AS r, (1000 * c.f * n) // (a.f * b.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates) c JOIN totals t ON c.lang = t.lang
  JOIN counted a ON a.lang = c.lang AND a.phrase = array_to_string(list_slice(ws, 1, i), ' ')
  JOIN counted b ON b.lang = c.lang AND b.phrase = array_to_string(list_slice(ws, i + 1, c.k), ' ')
  LEFT JOIN within w ON w.lang = c.lang AND w.phrase = c.phrase
  WHERE longer IS NULL OR 100 * longer < 100 * c.f
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
""" % (_LOWER % "coalesce(text, '')")

SUFFIX_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, row_number() OVER () AS doc FROM documents
), starts AS (
  SELECT doc, i, md5(substr(x, 2 * i + 1, 400)) AS h
  FROM (SELECT doc, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d)
), again AS (
  SELECT doc, i FROM starts QUALIFY count(*) OVER (PARTITION BY h) > 1
), opened AS (
  SELECT doc, i, coalesce(i > 200 + lag(i) OVER (PARTITION BY doc ORDER BY i), true)::INT AS opens FROM again
), spans AS (
  SELECT doc, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT doc, i, sum(opens) OVER (PARTITION BY doc ORDER BY i) AS span FROM opened)
  GROUP BY doc, span
), kept AS (
  SELECT doc, sum(b - a) AS n_removed, count(*) AS n_spans,
         list(a ORDER BY a) AS a, list(b ORDER BY a) AS b
  FROM spans GROUP BY doc
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(0, coalesce(len(a), 0) + 1), lambda i:
         substr(x, 2 * CASE WHEN i = 0 THEN 0 ELSE b[i] END + 1,
                2 * (CASE WHEN i = coalesce(len(a), 0) THEN len(x) // 2 ELSE a[i + 1] END
                     - CASE WHEN i = 0 THEN 0 ELSE b[i] END))), ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc)
"""
