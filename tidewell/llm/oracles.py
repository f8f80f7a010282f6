"""Plain SQL of the corpus queries that SQL can express."""

_P2 = """WITH rec AS (
  SELECT c.source, s.content_id, s.final_score AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY scored_ts DESC NULLS LAST, score_id DESC) AS k FROM score_result
    WHERE final_score IS NOT NULL AND NOT isnan(final_score) AND final_score BETWEEN 0 AND 1) s
  JOIN fetched_content c ON c.content_id = s.content_id WHERE s.k = 1 AND c.source IS NOT NULL),
ranked AS (SELECT r.*, t.keep_percent, count(*) OVER (PARTITION BY r.source) AS n,
  count(*) OVER (PARTITION BY r.source ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above
  FROM rec r JOIN keep_target t ON t.source = r.source),
cut AS (SELECT source, keep_percent, n, max(score) AS cutoff FROM ranked WHERE above * 100 >= keep_percent * n GROUP BY ALL)
"""
_LINE = r"lower(trim(regexp_replace(line, '\s+', ' ', 'g')))"
_P4 = rf"""WITH lines AS (
  SELECT content_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM fetched_content WHERE source IS NOT NULL),
n AS (SELECT content_id, source, line, line_no, {_LINE} AS norm FROM lines),
size AS (SELECT source, count(*) AS n_source FROM fetched_content WHERE source IS NOT NULL GROUP BY source),
named AS (SELECT n.source, norm, count(DISTINCT content_id) AS n_rows FROM n JOIN size ON size.source = n.source WHERE norm <> ''
  GROUP BY n.source, norm, n_source HAVING count(DISTINCT content_id) >= 5 AND count(DISTINCT content_id) * 20 >= n_source)
"""
_P8 = r"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS t FROM documents), i AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS t FROM benchmark),
dw AS (SELECT doc_id, substr(t, k, 80) AS w FROM d, LATERAL (SELECT unnest(range(1, length(t) - 78)) AS k)), iw AS (SELECT DISTINCT item_id, substr(t, k, 80) AS w FROM i, LATERAL (SELECT unnest(range(1, length(t) - 78)) AS k))
"""
_P10 = """WITH w AS (SELECT DISTINCT doc_id, md5(substr(text, k, 300)) AS w FROM documents, LATERAL (SELECT unnest(range(1, length(text) - 298)) AS k)),
many AS (SELECT w FROM w GROUP BY w HAVING count(*) > 1), s AS (SELECT w.* FROM w SEMI JOIN many ON many.w = w.w)
"""

ORACLE: dict[str, str] = {
    "p8_found": _P8 + "SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (w)",
    "p10_found": _P10 + "SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM s a JOIN s b ON a.w = b.w AND a.doc_id < b.doc_id",
    "p8_report": _P8.replace("dw AS (SELECT doc_id, substr", "dw AS (SELECT doc_id, k, substr").replace("SELECT DISTINCT item_id, substr", "SELECT item_id, k, substr")
    + """, m AS (SELECT doc_id, item_id, iw.k - dw.k AS diagonal, dw.k AS k FROM dw JOIN iw USING (w)),
g AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k) AS run FROM m),
r AS (SELECT doc_id, item_id, count(*) + 79 AS n FROM g GROUP BY doc_id, item_id, diagonal, run)
SELECT b.item_id, count(DISTINCT doc_id) AS n_docs, CAST(coalesce(max(n), 0) AS BIGINT) AS longest FROM benchmark b LEFT JOIN r USING (item_id) GROUP BY 1""",
    "p10_report": """WITH w AS (SELECT doc_id, k, md5(substr(text, k, 300)) AS w FROM documents, LATERAL (SELECT unnest(range(1, length(text) - 298)) AS k)),
many AS (SELECT w FROM w GROUP BY w HAVING min(doc_id) < max(doc_id)), s AS (SELECT doc_id, k, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS gap FROM w SEMI JOIN many ON many.w = w.w),
c AS (SELECT doc_id, CAST(sum(least(coalesce(gap, 300), 300)) AS BIGINT) AS shared_chars, count(*) FILTER (WHERE gap IS NULL OR gap > 300) AS n_spans FROM s GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(length(d.text), 0) AS BIGINT) AS n_chars, coalesce(c.shared_chars, 0) AS shared_chars, CASE WHEN length(d.text) > 0 THEN coalesce(c.shared_chars, 0) / length(d.text) ELSE 0.0 END AS shared_share,
  coalesce(c.n_spans, 0) AS n_spans FROM documents d LEFT JOIN c USING (doc_id)""",
    "p2_found": _P2 + "SELECT content_id FROM rec JOIN cut USING (source) WHERE score >= cutoff",
    "p2_cutoffs": _P2 + "SELECT source, keep_percent, n AS n_records, (SELECT count(*) FROM rec WHERE rec.source = cut.source AND score >= cutoff) AS n_kept, cutoff FROM cut",
    "p4_found": _P4 + "SELECT content_id, CAST(line_no AS INT) AS line_no FROM n JOIN named USING (source, norm)",
    "p4_lines": _P4 + "SELECT source, norm AS line, n_rows FROM named",
    "p4_excess": _P4
    + """, every AS (SELECT source, norm, count(DISTINCT content_id) AS n FROM n WHERE norm <> '' GROUP BY ALL), total AS (SELECT norm, sum(n) AS n_total FROM every GROUP BY 1),
c AS (SELECT named.source, norm AS line, n_rows, CAST(n_total - n_rows AS BIGINT) AS n_outside, CAST(n_rows AS DOUBLE) AS a, CAST(n_source AS DOUBLE) AS n, CAST(n_total - n_rows AS DOUBLE) AS b,
  CAST((SELECT sum(n_source) FROM size) - n_source AS DOUBLE) AS m FROM named JOIN size USING (source) JOIN total USING (norm)),
g AS (SELECT *, CASE WHEN a / n <= b / m THEN 0.0 ELSE 2 * (a * ln(a / n / ((a + b) / (n + m))) + CASE WHEN n > a THEN (n - a) * ln((n - a) / n / ((n + m - a - b) / (n + m))) ELSE 0 END
  + CASE WHEN b > 0 THEN b * ln(b / m / ((a + b) / (n + m))) ELSE 0 END + (m - b) * ln((m - b) / m / ((n + m - a - b) / (n + m)))) END AS g2 FROM c)
SELECT source, line, n_rows, n_outside, round(g2, 4) AS llr_outside, CASE WHEN g2 > 1 THEN exp(-g2 / 2) / sqrt(2 * pi() * g2) < 0.05 ELSE false END AS only_here FROM g""",
    "p4_texts": _P4
    + """SELECT f.content_id, CASE WHEN f.source IS NULL OR f.text IS NULL THEN f.text ELSE coalesce(k.text, '') END AS text FROM fetched_content f LEFT JOIN (
  SELECT content_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM n LEFT JOIN named USING (source, norm) WHERE named.norm IS NULL GROUP BY content_id) k ON k.content_id = f.content_id""",
}
