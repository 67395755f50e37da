"""DuckDB SQL for those queries that SQL can express.

The others (suffix-array verdict, quantised language model, hashes that DuckDB
lacks, tokenizers, places in shards and sequences) are tested against
brute-force versions in ``tests/llm``.
"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS s, min(page_id) OVER (PARTITION BY sha1(h)) AS o FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       translate(array_to_string(list_transform(range(8),
           lambda i: lpad(to_base(('0x' || substr(s, 1 + 5 * i::INT, 5))::BIGINT, 32), 4, '0')), ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id > o THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > o THEN o END AS refers_to
FROM q
"""

_INDEX = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(13, len(w)) AS l FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM bw)),
lens AS (SELECT DISTINCT l FROM win),
dw AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens WHERE len(w) >= l)),
hit AS MATERIALIZED (SELECT doc_id, i, l, item_id FROM dw JOIN win USING (l, g)),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(g) AS g, sha1(g) AS g2 FROM (
    SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.g2 = b.g2 AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
sym AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, sym.y FROM reach JOIN sym ON reach.r = sym.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m USING (doc_id)
"""



#: crc32 of the decimal id: each byte is XORed in, then eight shifts; places are words from 0.
#: Equal stretches of 16 words q apart find every run, as three periods and 24 words hold such a pair.
_RUNS = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w0,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                 lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT) AS h
  FROM documents),
t AS (SELECT *, len(w0)::BIGINT AS n, h // 10 AS g FROM d),
m AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM t),
mp AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM m),
x AS MATERIALIZED (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w0 ELSE
           list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
  FROM mp),
gram AS MATERIALIZED (
  SELECT rid, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS s FROM (SELECT rid, w, unnest(range(n - 15)) AS i FROM x WHERE n >= 24)),
pairs AS (SELECT y.rid, y.i, z.i - y.i AS q FROM gram y JOIN gram z ON y.rid = z.rid AND y.s = z.s AND y.i < z.i),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS part FROM pairs),
same AS (SELECT rid, q, min(i) AS a, max(i) + 16 + q AS e FROM numbered GROUP BY rid, q, part),
runs AS MATERIALIZED (
  SELECT rid, a AS start, e - a AS length, min(q) AS period FROM same WHERE e - a >= greatest(24, 3 * q) GROUP BY rid, a, e),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
listed AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s
  FROM runs GROUP BY rid),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length / period DESC, start, period) AS k FROM runs) WHERE k = 1),
left_ AS (
  SELECT k.rid, string_agg(word, ' ' ORDER BY k.i) AS s
  FROM (SELECT rid, unnest(w) AS word, unnest(range(n)) AS i FROM x) k ANTI JOIN gone ON gone.rid = k.rid AND gone.i = k.i GROUP BY k.rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(listed.s, '')) AS runs_sha256,
       sha256(coalesce(left_.s, '')) AS collapsed_sha256, n AS n_words
FROM x LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN left_ USING (rid)
"""


_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.uid, a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_inner_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.uid <> v.uid),
p AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS nth FROM s WHERE same QUALIFY nth <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.uid, p.nth ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.uid = p.uid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


def _mix(passes: int = 3) -> str:
    """Rows ranked and filled in as many passes as the operator's."""
    rounds, state = [], "r"
    for n in range(passes):
        end = "cum - size / 2" if n == passes - 1 else "cum"
        rounds.append(f"""
g{n} AS (SELECT source, max(rest) - sum(size * more) AS gap FROM {state} GROUP BY source),
f{n} AS MATERIALIZED (
  SELECT x.*, gap, v IS NOT NULL AND more = 0 AND size <= gap AS fits FROM {state} x JOIN g{n} g ON x.source IS NOT DISTINCT FROM g.source),
c{n} AS (SELECT *, sum(size) OVER (PARTITION BY source, fits ORDER BY v, key, rid ROWS UNBOUNDED PRECEDING) AS cum FROM f{n}),
s{n} AS MATERIALIZED (SELECT * EXCLUDE (more, gap, fits, cum), CASE WHEN fits AND {end} <= gap THEN 1 ELSE more END AS more FROM c{n})""")
        state = f"s{n}"
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
w AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
               ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
aim AS MATERIALIZED (SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM l),
k AS (SELECT source, length(bin(size)) AS liked, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL),
kl AS (
  SELECT k.*, target, (target - 3 * coalesce(sum(words) OVER (
               PARTITION BY k.source ORDER BY liked DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(words * liked) OVER (PARTITION BY k.source ORDER BY liked DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM k JOIN aim ON k.source IS NOT DISTINCT FROM aim.source),
kc AS (SELECT *, least(3.0::DOUBLE, max(level) OVER (PARTITION BY source) * liked) AS copies FROM kl),
kp AS (SELECT *, floor(copies + 1e-9::DOUBLE)::BIGINT AS sure FROM kc),
p AS MATERIALIZED (
  SELECT source, liked, sure, CASE WHEN copies - sure > 1e-9::DOUBLE THEN copies - sure ELSE 0 END AS p,
         target - sum(sure * words) OVER (PARTITION BY source) AS rest FROM kp),
u AS (
  SELECT d.*, coalesce(sure, 0) AS sure, p, rest, md5(concat_ws('|', doc_id::VARCHAR, size::VARCHAR)) AS key,
         (('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, size::VARCHAR)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d LEFT JOIN p ON d.source IS NOT DISTINCT FROM p.source AND size > 0 AND length(bin(size)) = liked),
o AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM u),
r AS MATERIALIZED (SELECT rid, doc_id, source, size, sure, rest, key, odds / (1 + odds) AS v, 0 AS more FROM o),
{",".join(rounds)}
SELECT doc_id, x.source, size, source_size, target, (sure + more)::BIGINT AS copies, (size * (sure + more))::BIGINT AS taken
FROM {state} x JOIN aim ON x.source IS NOT DISTINCT FROM aim.source
"""


ORACLE: dict[str, str] = {
    "op2_warc_revisits": _WARC,
    "op3_positional_index": _INDEX,
    "op6_ngram_join": _JACCARD,
    "op11_pareto_mix": _mix(),
    "op12_periodic_runs": _RUNS,
    "op13_hard_negatives": _NEGATIVES,
}
