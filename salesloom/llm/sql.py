"""DuckDB checks of the operators that SQL can express, over the views documents and benchmark."""

from __future__ import annotations

import string

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text', _PLAIN)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _PLAIN)} AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM (SELECT item, w, least(len(w), 13) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN win ON dw.k = win.k AND dw.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
          FROM (SELECT DISTINCT doc_id, item FROM occ WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words('text', _BLANK)} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
t AS (SELECT g.doc_id, n, g FROM g JOIN size ON g.doc_id = size.doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o
          FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
edges AS (SELECT a, b FROM pairs WHERE 100 * o >= 85 * (na + nb - o) UNION ALL SELECT b, a FROM pairs WHERE 100 * o >= 85 * (na + nb - o)),
reach AS (SELECT doc_id AS node, doc_id AS least FROM w UNION SELECT e.b, r.least FROM reach r JOIN edges e ON r.node = e.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM w LEFT JOIN size ON w.doc_id = size.doc_id JOIN (SELECT node, min(least) AS component_id FROM reach GROUP BY node) c ON w.doc_id = c.node"""

#: The crc32 of each distinct word is folded over its bytes with a table made by rule.
IMPORTANCE = f"""
WITH d AS (SELECT doc_id, {_words('text', _PLAIN)} AS w FROM documents),
tgt AS (SELECT {_words('text', _PLAIN)} AS w FROM benchmark),
steps AS (SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
vocabulary AS (SELECT DISTINCT unnest(w) AS f FROM (SELECT w FROM d UNION ALL SELECT w FROM tgt)),
bytes AS (SELECT f, list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS b FROM vocabulary),
bucket AS (SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k FROM bytes, steps),
corpus AS (SELECT k, count(*) AS n FROM (SELECT unnest(w) AS f FROM d) JOIN bucket USING (f) GROUP BY k),
target AS (SELECT k, count(*) AS n FROM (SELECT unnest(w) AS f FROM tgt) JOIN bucket USING (f) GROUP BY k),
totals AS (SELECT coalesce((SELECT sum(n) FROM corpus), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM target), 0)::DOUBLE AS t),
gain AS (SELECT k, floor(1000 * ln((coalesce(target.n, 0)::DOUBLE + 1) * (totals.s + 10000) / ((corpus.n::DOUBLE + 1) * (totals.t + 10000)))) AS g
         FROM corpus LEFT JOIN target USING (k), totals),
weighed AS (SELECT doc_id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(w) AS f FROM d) JOIN bucket USING (f) JOIN gain USING (k) GROUP BY doc_id),
scored AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
           FROM d LEFT JOIN weighed ON d.doc_id = weighed.doc_id),
may AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored s LEFT JOIN may ON s.doc_id = may.doc_id"""


def _product_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds are unrolled: a table of entries and one of assignments for each."""
    ctes = [f"""v AS MATERIALIZED (SELECT vec_id, label, e, len(e) // {parts} AS w, row_number() OVER (ORDER BY vec_id) AS rn FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS e
        FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
            """x AS MATERIALIZED (SELECT rn, (i - 1) // w AS part, (i - 1) % w AS pos, e[i] AS c FROM (SELECT rn, e, w, unnest(range(1, len(e) + 1)) AS i FROM v))""",
            f"c0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, pos, c FROM x WHERE rn <= {entries})"]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT rn, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
            SELECT rn, x.part, entry, sum((x.c - c{k}.c) * (x.c - c{k}.c))::HUGEINT AS d FROM x JOIN c{k} ON x.part = c{k}.part AND x.pos = c{k}.pos GROUP BY rn, x.part, entry)
            GROUP BY rn, part)""")
        if k < rounds:
            ctes.append(f"""c{k + 1} AS MATERIALIZED (SELECT c{k}.part, c{k}.entry, c{k}.pos, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
                SELECT x.part, entry, pos, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM x JOIN a{k} ON x.rn = a{k}.rn AND x.part = a{k}.part GROUP BY x.part, entry, pos) m
                ON m.part = c{k}.part AND m.entry = c{k}.entry AND m.pos = c{k}.pos)""")
    last = f"a{rounds}"
    return f"""WITH {', '.join(ctes)},
        r AS (SELECT rn, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY rn),
        books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS digest FROM c{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM v JOIN r ON v.rn = r.rn, books"""


PRODUCT_CODES = _product_codes()

SQL: dict[str, str] = {
    "op2_fm_index_decontamination": DECONTAMINATION,
    "op4_ngram_jaccard_join": JACCARD,
    "op11_importance_resampling": IMPORTANCE,
    "op13_pivot_product_codes": PRODUCT_CODES,
}
