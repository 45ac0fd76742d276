"""The corpus queries that SQL can express, as DuckDB statements over the same tables, written without the operators' methods."""

from __future__ import annotations

#: Checksum of each byte value (the rule of CRC-32, its polynomial 3988292384).
_TABLE = r"""
bit AS (SELECT b, b::BIGINT AS c, 0 AS k FROM range(256) AS r(b)
    UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
tab AS (SELECT b, c FROM bit WHERE k = 8),
"""
#: far(d, b): what byte b adds to a checksum if d bytes follow it; b = -1 stands for the start value before d bytes. Needs long(n).
_FAR = r"""far AS (SELECT 0 AS d, b, c FROM tab UNION ALL SELECT 0, -1, 4294967295
    UNION ALL SELECT d + 1, far.b, xor(far.c >> 8, tab.c) FROM far JOIN tab ON tab.b = far.c & 255 WHERE d < (SELECT max(n) FROM long)),
"""

ORACLE: dict[str, str] = {
    "op10_mixture": r"""
WITH d AS (
    SELECT doc_id, source, md5(doc_id::VARCHAR) AS turn_key,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE "BINARY" NULLS LAST) AS n
    FROM d GROUP BY source
),
w AS (
    SELECT *, (w0 + w1) / 2 AS weight, 2 * source_size AS most
    FROM (SELECT *, CASE n % 3 WHEN 1 THEN 4.0::DOUBLE ELSE 1.0 END AS w0, CASE n % 3 WHEN 1 THEN 2.0::DOUBLE WHEN 2 THEN 1.0 ELSE 3.0 END AS w1 FROM s)
),
l AS (
    SELECT *, ((sum(source_size) OVER ()) * 3 / 2.0::DOUBLE
        - coalesce(sum(most) OVER (ORDER BY most / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM w
),
t AS (
    SELECT source, source_size, w0, w1, CASE WHEN level * weight > most THEN most::DOUBLE
        ELSE weight * max(CASE WHEN level * weight <= most THEN level END) OVER () END AS target
    FROM l
),
r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.w0, t.w1, round(t.target)::BIGINT AS demand,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY turn_key, doc_id, size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS supply
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
q AS (
    SELECT *, (CASE WHEN source_size = 0 THEN 0 ELSE (demand // source_size) * size
        + greatest(0, least(size, demand % source_size - supply)) END)::BIGINT AS taken, supply / target * ((w0 + w1) / 2) AS need
    FROM r
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN least(1.0::DOUBLE,
    CASE WHEN need > 0 THEN need * 2 / (w0 + sqrt(greatest(w0 * w0 + need * (2 * (w1 - w0)), 0.0::DOUBLE))) ELSE 0.0::DOUBLE END) END AS position
FROM q
""",
    "op5_anchors": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
first AS (SELECT k, min(doc_id) AS doc FROM win GROUP BY k),
dup AS (SELECT win.doc_id, i FROM win JOIN first USING (k) WHERE first.doc < win.doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM dup, unnest(range(0, 50)) AS t(j)),
word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
    SELECT word.doc_id, count(gone.p) AS n, string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS rest
    FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY word.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op7_repeats": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM d, unnest(range(0, n - 99)) AS t(i)),
first AS (SELECT k, min(doc_id * 4294967296 + i) AS place FROM win GROUP BY k HAVING count(*) > 1),
dup AS (SELECT win.doc_id, i FROM win JOIN first USING (k) WHERE place < doc_id * 4294967296 + i),
edge AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true)::INT AS starts FROM dup),
island AS (SELECT doc_id, i, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM edge),
span AS (SELECT doc_id, g, min(i) AS s, max(i) + 100 AS e FROM island GROUP BY doc_id, g),
gap AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM span),
cut AS (
    SELECT doc_id, count(*) AS spans, sum(e - s) AS removed, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head, max(e) AS tail
    FROM gap JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE head || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
""",
    "op8_minhash": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM d, unnest(range(1, len(w) - 1)) AS t(i)
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2
),
n AS (SELECT doc_id, count(*)::BIGINT AS size FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 85 * (p.size + q.size - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a, min(b) AS component FROM r GROUP BY a)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component AS component_id, doc_id = component AS kept
FROM d JOIN k ON k.a = doc_id LEFT JOIN n USING (doc_id)
""",
    "op11_periods": r"""
WITH RECURSIVE"""
    + _TABLE
    + r"""
long AS (SELECT 20 AS n),
"""
    + _FAR
    + r"""
num AS (SELECT doc_id, doc_id::VARCHAR AS s, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
crc AS (
    SELECT doc_id, xor(bit_xor(far.c), 4294967295) AS h
    FROM (SELECT doc_id, len(s) - 1 - i AS d, ascii(substr(s, i + 1, 1)) AS b FROM num, unnest(range(0, len(s))) AS t(i)
        UNION ALL SELECT doc_id, len(s), -1 FROM num) AS part
    JOIN far USING (d, b) GROUP BY doc_id
),
plan AS (SELECT doc_id, w, len(w) AS n, h, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM num JOIN crc USING (doc_id)),
d AS (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN w[1:a] || [w[a + (i - a) % (1 + (n - a) // parts) + 1] FOR i IN range(a, n)] ELSE w END AS w
    FROM plan
),
gram AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 5], ' ')) AS g FROM d, unnest(range(1, len(w) - 4)) AS t(i)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
step AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair),
stretch AS (SELECT doc_id, q, min(i) - 1 AS s, count(*) + 5 + q AS n FROM step GROUP BY doc_id, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12),
run AS (
    SELECT * FROM stretch a WHERE NOT EXISTS (
        FROM stretch b WHERE a.doc_id = b.doc_id AND b.q < a.q AND b.s <= a.s AND b.s + b.n >= a.s + a.n)
),
gone AS (SELECT DISTINCT doc_id, p FROM run, unnest(range(s + q, s + n)) AS t(p)),
word AS (SELECT doc_id, p - 1 AS p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
    SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS rest FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY word.doc_id
),
top AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
        first(struct_pack(s, n, q) ORDER BY n DESC, s, q) AS best
    FROM run GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.n::BIGINT AS length, best.q::BIGINT AS period,
    (1000 * best.n // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op12_resampling": r"""
WITH RECURSIVE"""
    + _TABLE
    + r"""
txt AS (
    SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark)
),
feat AS (
    SELECT kind, id, array_to_string(w[i:i + k], ' ') AS x FROM txt, unnest(range(1, len(w) + 1)) AS t(i), range(3) AS r(k) WHERE i + k <= len(w)
),
one AS (SELECT x, row_number() OVER () AS f, octet_length(encode(x)) AS n, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM feat)),
long AS (SELECT max(n) AS n FROM one),
"""
    + _FAR
    + r"""
crc AS (
    SELECT f, bit_xor(far.c) AS c
    FROM (SELECT f, n - 1 - i AS d, ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT AS b FROM one, unnest(range(0, n)) AS t(i)
        UNION ALL SELECT f, n, -1 FROM one) AS part
    JOIN far USING (d, b) GROUP BY f
),
bucket AS (SELECT x, xor(c, 4294967295) % 10000 AS k FROM crc JOIN one USING (f)),
hit AS (SELECT kind, id, k, count(*)::DOUBLE AS n FROM feat JOIN bucket USING (x) GROUP BY ALL),
total AS (SELECT coalesce(sum(n) FILTER (WHERE kind = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS t FROM hit),
per AS (SELECT k, coalesce(sum(n) FILTER (WHERE kind = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS t FROM hit GROUP BY k),
gain AS (SELECT k, floor(1000 * ln((per.t + 1) * (total.s + 10000) / ((per.s + 1) * (total.t + 10000)))) AS g FROM per, total),
doc AS (SELECT id, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS weight FROM hit JOIN gain USING (k) WHERE kind = 0 GROUP BY id),
scored AS (
    SELECT id AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM txt LEFT JOIN doc USING (id) WHERE kind = 0
),
best AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE words >= 20
    QUALIFY rank <= 5 * count(*) OVER () // 100
)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN best USING (doc_id)
""",
}
