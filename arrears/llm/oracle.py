"""DuckDB statements for the queries that SQL can express.

They state the contracts plainly (all windows, all pairs that share a shingle)
and are meant for small tables.  The aligned, approximate, tokenised and
learned queries have none; they are tested against brute force, an exact round
trip or held-out labels.
"""

from .mixing import MAX_REPEATS, STEPS, WEIGHTS
from .secrets import ACCESS, ASSIGN, ASSIGN_VALUE, HEX, KINDS, MAX_OWNERS, OPAQUE


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


WORD = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {}

SQL["op1_mixing"] = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), {WORD})) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, COUNT(*) AS n FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS weight FROM s),
-- Sources that reach their cap first come first; each sees what those before it have left.
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source) AS k FROM w),
c AS (SELECT *,
             SUM(source_size) OVER () - {MAX_REPEATS} * COALESCE(SUM(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
             SUM(weight) OVER () - COALESCE(SUM(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS units
      FROM o),
f AS (SELECT MIN(k) AS k FROM c WHERE CAST({MAX_REPEATS} AS HUGEINT) * source_size * units > CAST(weight AS HUGEINT) * words),
t AS (SELECT c.source, c.source_size, c.n,
             CASE WHEN f.k IS NULL OR c.k < f.k THEN CAST({MAX_REPEATS} * c.source_size AS DOUBLE)
                  ELSE c.weight * CAST(x.words AS DOUBLE) / CAST(x.units AS DOUBLE) END AS target,
             CASE WHEN c.source_size = 0 THEN 0.0 WHEN f.k IS NULL OR c.k < f.k THEN {float(MAX_REPEATS)}
                  ELSE (c.weight * CAST(x.words AS DOUBLE) / CAST(x.units AS DOUBLE)) / c.source_size END AS ratio,
             CAST(('0x' || substr(sha256('17:' || COALESCE('s' || c.source, '-')), 1, 5)) AS INTEGER) / CAST({STEPS} AS DOUBLE) AS shift
      FROM c CROSS JOIN f LEFT JOIN c x ON x.k = f.k),
r AS (SELECT d.*, t.source_size, t.target, t.ratio, t.shift, t.n,
             ROW_NUMBER() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS j
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
z AS (SELECT *, CASE WHEN j % 2 = 0 THEN j // 2 ELSE n - 1 - (j - 1) // 2 END AS k FROM r),
e AS (SELECT *, CAST(LEAST(floor((k + 1) * ratio + shift) - floor(k * ratio + shift), {MAX_REPEATS}) AS BIGINT) AS copies FROM z)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM e"""


def _groups(share: int) -> str:
    """Components of documents whose sets of 4-word shingles have a similarity of ``share`` percent or more."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS words
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS g FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, COUNT(*) AS o
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i WHERE 100 * o >= {share} * (na + nb - o)),
link AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, MIN(b) AS least FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, LEAST(s.doc_id, COALESCE(c.least, s.doc_id)) AS component_id
FROM s LEFT JOIN c ON s.doc_id = c.a"""


SQL["op3_ngram_join"] = _groups(85)

SQL["op4_secrets"] = f"""
WITH k AS (SELECT * FROM (VALUES (0, {_text(ASSIGN)}), (1, {_text(ACCESS)}), (2, {_text(HEX)}), (3, {_text(OPAQUE)})) AS v(kind, pattern)),
t AS (SELECT doc_id, COALESCE(text, '') AS text, COALESCE('s' || source, '-') AS owner FROM documents),
m AS (SELECT doc_id, owner, kind, unnest(regexp_extract_all(text, pattern)) AS m, unnest(string_split_regex(text, pattern)[1:-2]) AS gap,
             unnest(range(len(regexp_extract_all(text, pattern)))) AS i
      FROM t, k WHERE regexp_matches(text, pattern)),
p AS (SELECT *, SUM(length(gap)) OVER w + SUM(length(m)) OVER w - length(m) AS s, SUM(length(gap)) OVER w + SUM(length(m)) OVER w AS e,
             CASE WHEN kind = 0 THEN regexp_extract(m, {_text(ASSIGN_VALUE)}, 1) ELSE m END AS val
      FROM m WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i ROWS UNBOUNDED PRECEDING)),
base AS (SELECT * FROM p WHERE kind = 0 AND length(val) >= 6 OR kind IN (1, 2)),
opaque AS (SELECT * FROM p WHERE kind = 3 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')
           AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = p.doc_id AND b.s < p.e AND p.s < b.e)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
rare AS (SELECT val FROM found GROUP BY val HAVING COUNT(DISTINCT owner) <= {MAX_OWNERS}),
x AS (SELECT *, val IN (SELECT val FROM rare) AS live, [{', '.join(map(_text, KINDS))}][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS span FROM found),
g AS (SELECT doc_id, COUNT(*) FILTER (WHERE kind = 0) AS a, COUNT(*) FILTER (WHERE kind = 1) AS b, COUNT(*) FILTER (WHERE kind = 2) AS c,
             string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS based,
             string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < 3 OR live) AS spans, COUNT(*) FILTER (WHERE live) AS n
      FROM x GROUP BY doc_id)
SELECT t.doc_id, CAST(COALESCE(a, 0) AS BIGINT) AS n_assign, CAST(COALESCE(b, 0) AS BIGINT) AS n_access, CAST(COALESCE(c, 0) AS BIGINT) AS n_hex,
       sha256(COALESCE(based, '')) AS base_sha256, COALESCE(spans, '') AS spans, CAST(COALESCE(n, 0) AS BIGINT) AS n_live
FROM t LEFT JOIN g USING (doc_id)"""

SQL["op5_warc"] = """
WITH p AS (SELECT page_id, strlen(COALESCE(html, '')) AS n, sha256(COALESCE(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN MIN(page_id) OVER (PARTITION BY digest) ELSE page_id END AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM f"""

SQL["op6_substring_words"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {WORD}) AS words FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
f AS (SELECT g, MIN(doc_id) AS least FROM v GROUP BY g),
r AS (SELECT DISTINCT doc_id, i + j AS pos FROM v JOIN f USING (g), range(50) AS x(j) WHERE least < doc_id),
c AS (SELECT doc_id, list(pos) AS gone FROM r GROUP BY doc_id),
k AS (SELECT w.doc_id, words, COALESCE(gone, []) AS gone FROM w LEFT JOIN c USING (doc_id)),
u AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
b AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM u ANTI JOIN r ON u.doc_id = r.doc_id AND u.pos = r.pos GROUP BY u.doc_id)
SELECT k.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM k LEFT JOIN b USING (doc_id)"""

SQL["op7_substring_bytes"] = """
WITH t AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h, strlen(COALESCE(text, '')) AS n FROM documents),
v AS (SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS g FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM t WHERE n >= 100)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, ROW_NUMBER() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM v) WHERE k > 1),
o AS (SELECT *, LAG(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r),
s AS (SELECT *, SUM(CASE WHEN before IS NULL OR i - before > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
x AS (SELECT doc_id, run, MIN(i) AS lo, MAX(i) + 100 AS hi FROM s GROUP BY 1, 2),
c AS (SELECT doc_id, SUM(hi - lo) AS gone, COUNT(*) AS spans FROM x GROUP BY 1),
stretch AS (SELECT x.doc_id, COALESCE(LAG(hi) OVER w, 0) AS a, lo AS b FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY lo)
            UNION ALL SELECT doc_id, MAX(hi), NULL FROM x GROUP BY doc_id),
kept AS (SELECT t.doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (COALESCE(b, n) - a) AS BIGINT)), '' ORDER BY a) AS h
         FROM stretch JOIN t USING (doc_id) GROUP BY t.doc_id)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(COALESCE(gone, 0) AS BIGINT) AS n_removed, CAST(COALESCE(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(COALESCE(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)"""


SQL["op11_lexical_search"] = """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, COUNT(*) AS tf FROM t GROUP BY 1, 2),
c AS (SELECT COUNT(DISTINCT doc_id) AS docs, COUNT(*) AS words FROM t),
m AS (SELECT doc_id, 100 - 90 + ((90 * COUNT(*) * any_value(docs)) // any_value(words)) AS m FROM t CROSS JOIN c GROUP BY doc_id),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f CROSS JOIN c GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""

# DuckDB has no crc32: its table and the steps over a word's bytes are written out, once for each distinct word.
SQL["op12_importance_resampling"] = """
WITH tab AS (SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) AS x(i)),
d AS (SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
      UNION ALL
      SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM d)),
y AS (SELECT word, list_transform(range(CAST(length(h) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS bytes FROM v),
b AS (SELECT word, xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM y CROSS JOIN tab),
e AS (SELECT side, doc_id, bucket FROM d JOIN b USING (word)),
k AS (SELECT bucket, COUNT(*) FILTER (WHERE side = 0) AS s, COUNT(*) FILTER (WHERE side = 1) AS t FROM e GROUP BY bucket),
a AS (SELECT SUM(s) AS s_all, SUM(t) AS t_all FROM k),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM k CROSS JOIN a),
w AS (SELECT doc_id, COUNT(*) AS n, CAST(SUM(gain) AS BIGINT) AS total FROM e JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
x AS (SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_features,
             COALESCE(total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END, 0) AS weight,
             CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
      FROM documents LEFT JOIN w USING (doc_id)),
z AS (SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM x),
o AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS rank, COUNT(*) OVER () AS able FROM z WHERE n_features >= 20)
SELECT z.doc_id, n_features, weight, score, CAST(CASE WHEN rank <= 10 * able // 100 THEN rank END AS BIGINT) AS rank
FROM z LEFT JOIN o ON z.doc_id = o.doc_id"""

SQL["op13_minhash"] = f"SELECT *, doc_id = component_id AS kept FROM ({_groups(80)}) AS g"
