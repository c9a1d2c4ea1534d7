"""DuckDB statements for the operators that SQL expresses on whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS MATERIALIZED (
  SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (win, n)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id),
uses AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
wins AS (SELECT DISTINCT win, string_split(win, ' ') AS t FROM bw),
anchors AS (
  SELECT win, min({{'n': n, 'off': off, 'term': term}}) AS a
  FROM (SELECT win, unnest(t) AS term, unnest(range(0, len(t))) AS off FROM wins) JOIN uses USING (term)
  GROUP BY win),
near AS (
  SELECT doc_id, count(DISTINCT win) AS n_near
  FROM (SELECT doc_id, w, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM d)
  JOIN anchors ON term = a.term JOIN wins USING (win)
  WHERE len(list_intersect(w[greatest(p - 9, 1):p + 9], t)) >= len(list_distinct(t)) * 0.8
    AND (doc_id, win) NOT IN (SELECT doc_id, win FROM dw JOIN bw USING (win, n))
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""

FIM = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (
  SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (
  SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, abs(a - b)) AS m,
         substr(t, greatest(a, b) + 1) AS s FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""


def _ball_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """K-means per part by full comparison, one pair of steps for each round."""
    kept = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS place
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT rid, place, part, x[part * (len(x) // {parts}) + 1:(part + 1) * (len(x) // {parts})] AS x
  FROM v, range({parts}) r(part)),
b0 AS (SELECT part, place AS entry, x AS c FROM p WHERE place < {entries})"""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
d{t} AS (
  SELECT rid, part, min({{'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))),
                          'e': entry}}) AS best
  FROM p JOIN b{t} USING (part) GROUP BY rid, part)""")
        if t < rounds:
            steps.append(f"""
s{t} AS (
  SELECT part, entry, i, CAST(sum(xi) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT part, best.e AS entry, unnest(x) AS xi, unnest(range(1, len(x) + 1)) AS i
        FROM p JOIN d{t} USING (rid, part))
  GROUP BY part, entry, i),
m{t} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{t} GROUP BY part, entry),
b{t + 1} AS (
  SELECT part, entry, coalesce(m{t}.c, b{t}.c) AS c FROM b{t} LEFT JOIN m{t} USING (part, entry))""")
    return kept + "," + ",".join(steps) + f""",
coded AS (
  SELECT rid, string_agg(lpad(to_hex(best.e), 2, '0'), '' ORDER BY part) AS code,
         CAST(sum(best.d) AS BIGINT) AS error FROM d{rounds} GROUP BY rid)
SELECT vec_id, lower(code) AS code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{rounds})
         AS codebooks_sha256
FROM coded JOIN v USING (rid)
"""


ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION,
    "op5_exact_dedup": EXACT_DEDUP,
    "op11_fim": FIM,
    "op13_ball_codes": _ball_codes(),
}
