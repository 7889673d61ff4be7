"""Queries p2 and p3 over the whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import intervals, orphans
from quire.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.page_periods(table(spark, d, "sections"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    sections, reports = table(spark, d, "sections"), table(spark, d, "validation_reports")
    kids = orphans.wiki_references(reports, sections)
    return orphans.orphan_references(kids, orphans.wiki_targets(table(spark, d, "notes"), table(spark, d, "image_map"), sections))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select(F.col("kind").alias("ref_kind"), "record_id", F.col("pos").cast("int").alias("pos"), "state")


def p3_by_month(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans_by_period(_orphans(spark, d), "month").withColumnsRenamed({"kind": "ref_kind", "period": "month"})


P2 = """
WITH r AS (SELECT source_id, pdf_page_start a, pdf_page_end b FROM sections WHERE pdf_page_end >= pdf_page_start),
m AS (SELECT *, max(b) OVER (PARTITION BY source_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) mx FROM r),
g AS (SELECT *, sum(CASE WHEN mx IS NULL OR a > mx + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) k FROM m),
p AS (SELECT source_id, k, min(a) a, max(b) b FROM g GROUP BY ALL),
n AS (SELECT *, lead(a) OVER (PARTITION BY source_id ORDER BY a) nx FROM p)
SELECT source_id, 'period' AS kind, a AS page_from, b AS page_to FROM p
UNION ALL SELECT source_id, 'gap', b + 1, nx - 1 FROM n WHERE nx IS NOT NULL
"""

# a path is resolved by folding its parts; DuckDB's list_reduce carries the stack as one string
_RESOLVE = """
list_reduce(list_prepend('', list_filter(string_split(CASE WHEN {t} LIKE '/%' THEN {t} ELSE regexp_replace({f}, '[^/]*$', '') || {t} END, '/'), lambda x: x NOT IN ('', '.'))),
            lambda acc, x: CASE WHEN x = '..' THEN regexp_replace(acc, '/?[^/]*$', '') WHEN acc = '' THEN x ELSE acc || '/' || x END)
"""
_P3 = f"""
WITH l AS (SELECT report_id, run_at, unnest(broken_links) x, generate_subscripts(broken_links, 1) - 1 pos FROM validation_reports),
i AS (SELECT report_id, run_at, unnest(broken_images) x, generate_subscripts(broken_images, 1) - 1 pos FROM validation_reports),
kids AS (
  SELECT 'link' kind, report_id record_id, pos, {_RESOLVE.format(t="x.target", f="x.file")} key, run_at ts FROM l WHERE x.target <> ''
  UNION ALL SELECT 'image', report_id, pos, {_RESOLVE.format(t="x.path", f="x.file")}, run_at FROM i WHERE x.path <> ''
  UNION ALL SELECT 'parent', section_row, 0, parent_id, loaded_at FROM sections WHERE parent_id <> ''),
folk AS (
  SELECT 'link' kind, path key, created_at s, deleted_at e FROM notes
  UNION ALL SELECT 'image', path, created_at, deleted_at FROM image_map
  UNION ALL SELECT 'parent', section_id, loaded_at, removed_at FROM sections),
j AS (SELECT k.kind, k.record_id, k.pos, k.ts, count(f.key) n, coalesce(bool_or(f.s <= k.ts), false) began,
             coalesce(bool_or(f.s <= k.ts AND (f.e IS NULL OR f.e > k.ts)), false) alive
      FROM kids k LEFT JOIN folk f ON k.kind = f.kind AND k.key = f.key GROUP BY ALL),
o AS (SELECT kind, record_id, pos, ts, CASE WHEN n = 0 THEN 'missing' WHEN began THEN 'deleted' ELSE 'late' END AS state FROM j WHERE NOT alive)
"""
P3 = _P3 + "SELECT kind AS ref_kind, record_id, CAST(pos AS INTEGER) AS pos, state FROM o"
P3_MONTH = _P3 + "SELECT kind AS ref_kind, CAST(date_trunc('month', ts) AS DATE) AS month, state, count(*) AS n_refs FROM o GROUP BY ALL"

QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_by_month": p3_by_month}
SQL = {"p2_found": P2, "p3_found": P3, "p3_by_month": P3_MONTH}
