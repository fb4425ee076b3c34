"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

JACCARD = rf"""
WITH RECURSIVE cut AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT r, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM cut WHERE len(w) > 0)
), size AS (
    SELECT r, count(*) AS n FROM shingle GROUP BY r
), link AS (
    SELECT a, b
    FROM (SELECT x.r AS a, y.r AS b, count(*) AS shared
          FROM shingle x JOIN shingle y ON x.s = y.s AND x.r <> y.r GROUP BY ALL)
    JOIN size p ON p.r = a JOIN size q ON q.r = b
    WHERE 100 * shared >= 90 * (p.n + q.n - shared)
), reach AS (
    SELECT r, r AS other FROM cut
    UNION
    SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT c.doc_id, coalesce(any_value(size.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN cut c ON c.r = reach.r JOIN cut o ON o.r = reach.other LEFT JOIN size ON size.r = c.r
GROUP BY c.r, c.doc_id
"""

REPEATS = """
WITH raw AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), start AS (
    SELECT r, p, md5(substr(h, 2 * p + 1, 800)) AS s
    FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS p FROM raw WHERE len(h) >= 800)
), again AS (
    SELECT r, p FROM start SEMI JOIN (SELECT s FROM start GROUP BY s HAVING count(*) > 1) t USING (s)
), run AS (
    SELECT r, min(p) AS a, max(p) + 400 AS z
    FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS k
          FROM (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400
                             THEN 0 ELSE 1 END AS fresh FROM again))
    GROUP BY r, k
), gap AS (
    SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t FROM run
    UNION ALL
    SELECT r, max(z), NULL FROM run GROUP BY r
), rest AS (
    SELECT r, string_agg(substr(h, 2 * f + 1, 2 * (coalesce(t, len(h) // 2) - f)), '' ORDER BY f) AS h
    FROM gap JOIN raw USING (r) GROUP BY r
), runs AS (
    SELECT r, count(*) AS n FROM run GROUP BY r
)
SELECT doc_id, (len(raw.h) // 2)::BIGINT AS n_bytes,
       (len(raw.h) // 2 - len(coalesce(rest.h, raw.h)) // 2)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest.h, raw.h))) AS kept_sha256
FROM raw LEFT JOIN rest USING (r) LEFT JOIN runs USING (r)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = rf"""
WITH cut AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents
), item AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark
), known AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM item WHERE len(w) > 0)
), found AS (
    SELECT r, i, p.n, item
    FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
                FROM cut CROSS JOIN (SELECT DISTINCT n FROM known) WHERE len(w) >= n)) p
    JOIN known USING (gram)
), hit AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r
), items AS (
    SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS listed
    FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

WINDOWS = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM cut WHERE len(w) >= 20)
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win)
    WHERE k > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again
), word AS (
    SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM cut
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(v, ' ' ORDER BY p) AS t
    FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT cut.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""

# The crc32 of bytes, from a table made by its rule: eight steps for each of 256 bytes.
VARIANTS = rf"""
WITH RECURSIVE step AS (
    SELECT b, b::BIGINT AS c, 0 AS k FROM range(256) t(b)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8
), run AS (
    SELECT doc_id, w, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS w FROM documents)
    GROUP BY ALL
), hashed AS (
    SELECT w, n, xor(list_reduce(
        list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
    FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM run), crc
), word AS (
    SELECT w, sum(n)::BIGINT AS n
    FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2)
                 ELSE w END AS w, n FROM hashed)
    WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3
), less AS (
    SELECT w, n, p, substr(w, 1, p) || substr(w, p + 2) AS rest
    FROM (SELECT w, n, unnest(range(length(w))) AS p FROM word)
), pair AS (
    SELECT x.w AS a, y.w AS b, y.n AS m FROM less x JOIN less y ON x.rest = y.rest AND x.p = y.p AND x.w <> y.w
    UNION
    SELECT less.w, word.w, word.n FROM less JOIN word ON less.rest = word.w
    UNION
    SELECT word.w, less.w, less.n FROM less JOIN word ON less.rest = word.w
), best AS (
    SELECT a, count(*) AS near, min((-m, b)) AS t FROM pair GROUP BY a
), formed AS (
    SELECT w, n, coalesce(near, 0) AS n_near, CASE WHEN -t[1] >= 2 * n THEN t[2] END AS form,
           CASE WHEN -t[1] >= 2 * n THEN -t[1] END AS form_n
    FROM word LEFT JOIN best ON a = w
), walk AS (
    SELECT w, w AS word, 0 AS k FROM formed
    UNION ALL
    SELECT walk.w, f.form, k + 1 FROM walk JOIN formed f ON f.w = walk.word WHERE f.form IS NOT NULL
)
SELECT formed.w AS word, any_value(n)::BIGINT AS n, any_value(n_near)::BIGINT AS n_near, any_value(form) AS form,
       any_value(form_n)::BIGINT AS form_n, arg_max(walk.word, k) AS root
FROM formed JOIN walk ON walk.w = formed.w GROUP BY formed.w
"""

MIDDLE = """
WITH raw AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x
    FROM documents
), drawn AS (
    SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS c2,
           ('0x' || substr(x, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS h4
    FROM raw
), formed AS (
    SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT *, '<P>' || substr(t, 1, a) AS p, '<M>' || substr(t, a + 1, b - a) AS m, '<S>' || substr(t, b + 1) AS s
    FROM formed
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_jaccard_join": JACCARD,
        "op2_repeated_strings": REPEATS,
        "op8_decontaminate": DECONTAMINATE,
        "op11_repeated_windows": WINDOWS,
        "op12_spelling_variants": VARIANTS,
        "op13_fill_in_middle": MIDDLE,
    }
