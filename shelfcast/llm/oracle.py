"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLD = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

ORACLE: dict[str, str] = {}

ORACLE["op1_decontamination"] = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), pattern AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS gram
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), gram AS (
  SELECT r, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
  FROM doc, (SELECT DISTINCT m FROM pattern) AS lengths, unnest(range(1, len(w) - m + 2)) AS u(i) WHERE len(w) >= m
), hit AS (
  SELECT r, i, m, item_id FROM gram JOIN pattern USING (m, gram)
), word AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + m)) AS u(p) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN items USING (r)
"""

ORACLE["op2_warc_revisits"] = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digit AS (
  SELECT hex, j, sum(((strpos('0123456789abcdef', substr(hex, CAST(1 + (5 * j + b) // 4 AS BIGINT), 1)) - 1)
                      // CAST(pow(2, 3 - (5 * j + b) % 4) AS BIGINT)) % 2 * CAST(pow(2, 4 - b) AS BIGINT)) AS v
  FROM (SELECT DISTINCT hex FROM page), range(0, 32) AS js(j), range(0, 5) AS bs(b) GROUP BY hex, j
), coded AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + v AS BIGINT), 1), '' ORDER BY j) AS payload_digest
  FROM digit GROUP BY hex
), first AS (SELECT hex, min(page_id) AS first_id FROM page GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM page JOIN first USING (hex) JOIN coded USING (hex)
"""

ORACLE["op6_suffix_dedup"] = """
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM doc, unnest(range(0, CAST(length(h) // 2 - 199 AS BIGINT))) AS u(i)
), again AS (
  SELECT k FROM win GROUP BY k HAVING count(*) > 1
), hit AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM win JOIN again USING (k)
), numbered AS (
  SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM hit
), runs AS (
  SELECT r, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, run
), gaps AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS gap FROM runs
), kept AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_end,
         string_agg(substr(h, 2 * gap + 1, 2 * (a - gap)), '' ORDER BY a) AS head
  FROM gaps JOIN doc USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, 2 * last_end + 1) END)) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

ORACLE["op13_filter_audit"] = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), label AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), smallest AS (SELECT t, min(doc_id) AS least FROM doc GROUP BY t),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc.doc_id > least, false)} AS f
  FROM doc JOIN smallest USING (t) LEFT JOIN label ON doc.doc_id = label.doc_id
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), grouped AS (
  SELECT part, good, toxic, f.A::INT AS fa, f.B::INT AS fb, f.C::INT AS fc, f.D::INT AS fd, f.E::INT AS fe, count(*) AS n
  FROM failing GROUP BY ALL
), ranked AS (
  SELECT *, least(CASE WHEN fa = 1 THEN strpos(filter_order, 'A') ELSE 9 END, CASE WHEN fb = 1 THEN strpos(filter_order, 'B') ELSE 9 END,
    CASE WHEN fc = 1 THEN strpos(filter_order, 'C') ELSE 9 END, CASE WHEN fd = 1 THEN strpos(filter_order, 'D') ELSE 9 END,
    CASE WHEN fe = 1 THEN strpos(filter_order, 'E') ELSE 9 END) AS gone FROM grouped, orders
), stepped AS (
  SELECT *, CAST(i AS INTEGER) AS step, substr(filter_order, CAST(i AS INTEGER), 1) AS letter FROM ranked, unnest(range(1, 6)) AS u(i)
), cell AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone < step AND CASE letter WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END = 1
        THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fa + fb + fc + fd + fe = 1 AND CASE letter WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END = 1
        THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = step AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM stepped GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM cell
"""
