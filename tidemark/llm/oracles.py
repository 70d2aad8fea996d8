"""DuckDB SQL of the operators that SQL can express, for tables named as in the test data."""

#: op1: targets by one water level, slots of the golden-ratio rotation ranked per source, documents laid end to end in hash order.
MIXING = r"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size, md5(coalesce(doc_id::VARCHAR, 'null' || coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w, 3 * source_size AS stop FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
       coalesce(sum(stop) OVER (ORDER BY stop / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_, coalesce(sum(w) OVER (ORDER BY stop / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_w FROM w),
l AS (SELECT max(CASE WHEN (total::DOUBLE - full_) / (all_w - full_w) <= stop::DOUBLE / w THEN (total::DOUBLE - full_) / (all_w - full_w) END) AS level FROM o),
t AS (SELECT source, source_size, least(stop::DOUBLE, level * w) AS target, least(round(least(stop::DOUBLE, level * w))::BIGINT, stop) AS need, row_number() OVER (ORDER BY source IS NULL, source) AS s FROM o, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN need // source_size ELSE 0 END AS epochs, CASE WHEN source_size > 0 THEN need % source_size ELSE 0 END AS rest, (source_size + 1023) // 1024 AS blocks FROM t),
q AS (SELECT *, epochs * blocks + (rest + 1023) // 1024 AS slots, sum(need) OVER (ORDER BY s) AS hi, sum(need) OVER (ORDER BY s) - need AS lo FROM e),
n AS (SELECT sum(slots)::BIGINT AS n_slots, greatest(sum(need), 1)::DOUBLE / 2147483648 AS scale FROM q),
points AS (SELECT range AS slot, (range % 2147483648 * 1327217885 % 2147483648) * scale AS place FROM n, range((SELECT n_slots FROM n))),
given AS (SELECT slot, s, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS rank FROM points JOIN q ON place >= lo AND place < hi AND need > 0),
have AS (SELECT q.s, slots, count(given.slot) AS have FROM q LEFT JOIN given USING (s) WHERE need > 0 GROUP BY ALL),
late AS (SELECT s, unnest(range(have, slots)) AS rank FROM have WHERE have < slots),
used AS (SELECT slot, s, rank FROM given UNION ALL SELECT n_slots + row_number() OVER (ORDER BY rank, s) - 1, s, rank FROM late, n),
taking AS (SELECT slot, s, rank % blocks AS block, CASE WHEN rank // blocks < epochs THEN 1024 ELSE least(1024, rest - rank % blocks * 1024) END AS take FROM used JOIN q USING (s) WHERE rank < slots),
p AS (SELECT d.*, q.s, q.source_size, q.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
x AS (SELECT p.s, p.start, slot, least(start + size, block * 1024 + take) - greatest(start, block * 1024) AS words FROM p JOIN taking ON taking.s = p.s AND size > 0 AND block BETWEEN start // 1024 AND (start + size - 1) // 1024),
g AS (SELECT s, start, sum(words)::BIGINT AS taken, min(slot) AS first_slot, max(slot) AS last_slot, count(*) AS n_slots FROM x WHERE words > 0 GROUP BY ALL)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot, last_slot, coalesce(n_slots, 0)::BIGINT AS n_slots FROM p LEFT JOIN g ON g.s = p.s AND g.start = p.start AND size > 0
"""

#: op2: every item window compared with every document window of its length.
DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM iw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: op6: every 50-word window grouped by its words.
SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM x GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM x JOIN f USING (h) WHERE first < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

#: op7: every 400-byte string grouped; each letter stands for a byte, in hexadecimal.
SUFFIXES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT r, i, md5(substr(x, 2 * i + 1, 800)) AS h FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 399)) AS i FROM d WHERE len(x) >= 800)),
twice AS (SELECT r, i FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
edges AS (SELECT r, i, i > lag(i) OVER w + 400 OR lag(i) OVER w IS NULL AS fresh FROM twice WINDOW w AS (PARTITION BY r ORDER BY i)),
spans AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM edges) GROUP BY r, k),
gaps AS (SELECT r, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY r ORDER BY a) UNION ALL SELECT r, max(b), 1099511627776 FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(substr(x, 2 * a + 1, 2 * (least(b, len(x) // 2) - a)), '' ORDER BY a) AS x FROM gaps JOIN d USING (r) WHERE least(b, len(x) // 2) > a GROUP BY r),
sums AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(CASE WHEN n_spans IS NULL THEN d.x ELSE coalesce(kept.x, '') END)) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""

#: op11: all pairs of documents that share a shingle, and what their links reach.
NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, md5(array_to_string(w[i : i + 2], ' ')) AS h FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS hits FROM s x JOIN s y USING (h) WHERE x.r <> y.r GROUP BY ALL) JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * hits >= 90 * (na.n + nb.n - hits)),
reach AS (SELECT r, r AS other FROM w UNION SELECT reach.r, b FROM reach JOIN links ON a = other)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM w LEFT JOIN n USING (r) JOIN (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN w ON w.r = other GROUP BY reach.r) USING (r)
"""


#: op12: plain rounds; squared distances as |c|^2 - 2 x.c (+ |x|^2 for errors), exact in doubles at this size.
def _codes() -> str:
    rounds = []
    for k in range(5):
        rounds.append(f"""
a{k} AS (SELECT r, p, x, arg_min(e, (d, e)) AS e FROM (SELECT parts.r, parts.p, x, e, list_inner_product(c, c) - 2 * list_inner_product(x, c) AS d FROM parts JOIN b{k} USING (p)) GROUP BY ALL)""")
        rounds.append(f"""
b{k + 1} AS (SELECT p, e, coalesce(m, c) AS c FROM b{k} LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS m FROM
  (SELECT p, e, i, floor(sum(v) / count(*)) AS m FROM (SELECT p, e, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY ALL) GROUP BY ALL) USING (p, e))""")
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 256),{','.join(f"{x.replace(' AS (', ' AS MATERIALIZED (', 1)}" for x in rounds[:-1])},
coded AS (SELECT r, string_agg(printf('%02x', a4.e), '' ORDER BY p) AS code, sum(list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c))::BIGINT AS error FROM a4 JOIN b4 USING (p, e) GROUP BY r),
hashed AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), hashed
"""


#: op13: trees by recursion level by level, then every leaf folded up; crc32 by its table of 256 entries, made by the rule.
MERKLE = r"""
WITH RECURSIVE field AS (SELECT row_number() OVER () AS r, *, concat(
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
         coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head FROM documents),
bits AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS tab FROM range(256) t(i)),
crc AS (SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM field, bits WHERE doc_id IS NOT NULL),
leaves AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(own) || ':' || own, '-')) AS given
         FROM (SELECT field.*, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS own FROM field LEFT JOIN crc USING (r))),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree AS (SELECT source, 0 AS lvl, idx, leaf AS d, n FROM placed
         UNION ALL SELECT source, lvl + 1, idx // 3, sha256(string_agg(d, '' ORDER BY idx)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY source, lvl, idx // 3, n),
sub AS (SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
over AS (SELECT 0 AS lvl, place AS idx, subroot AS d, n FROM sub
         UNION ALL SELECT lvl + 1, idx // 3, sha256(string_agg(d, '' ORDER BY idx)), (n + 2) // 3 FROM over WHERE n > 1 GROUP BY lvl, idx // 3, n),
runs AS (SELECT source, lvl, idx // 3 AS run, list(d ORDER BY idx) AS ds FROM tree WHERE n > 1 GROUP BY ALL),
over_runs AS (SELECT lvl, idx // 3 AS run, list(d ORDER BY idx) AS ds FROM over WHERE n > 1 GROUP BY ALL),
inner_fold AS (SELECT r, source, 0 AS lvl, idx, n, given AS d, '' AS seen FROM placed
         UNION ALL SELECT r, f.source, f.lvl + 1, idx // 3, (n + 2) // 3, sha256(array_to_string(ds[1 : idx % 3] || [d] || ds[idx % 3 + 2 :], '')),
         seen || array_to_string(ds[1 : idx % 3] || ds[idx % 3 + 2 :], '')
         FROM inner_fold f JOIN runs ON runs.source IS NOT DISTINCT FROM f.source AND runs.lvl = f.lvl AND run = idx // 3 WHERE n > 1),
outer_fold AS (SELECT r, 0 AS lvl, place AS idx, sub.n, d, seen FROM inner_fold f JOIN sub ON sub.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
         UNION ALL SELECT r, f.lvl + 1, idx // 3, (n + 2) // 3, sha256(array_to_string(ds[1 : idx % 3] || [d] || ds[idx % 3 + 2 :], '')),
         seen || array_to_string(ds[1 : idx % 3] || ds[idx % 3 + 2 :], '')
         FROM outer_fold f JOIN over_runs ON over_runs.lvl = f.lvl AND run = idx // 3 WHERE n > 1)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
FROM placed JOIN sub ON sub.source IS NOT DISTINCT FROM placed.source JOIN (SELECT r, d, seen FROM outer_fold WHERE n = 1) f USING (r), (SELECT d AS root FROM over WHERE n = 1)
"""

SQL: dict[str, str] = {"op1_mixing": MIXING, "op2_decontaminate": DECONTAMINATE, "op6_substring_dedup": SUBSTRINGS, "op7_suffix_dedup": SUFFIXES, "op11_ngram_join": NGRAM_JOIN, "op12_vector_codes": _codes(), "op13_merkle_manifest": MERKLE}
