"""Outline and page queries over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import paths, text
from quire.operators import outline
from quire.session import table


def _toc(spark: SparkSession, d: str) -> DataFrame:
    t = outline.one_delivery(table(spark, d, "toc_entries"))
    return t.withColumn("slug", text.slug_ascii(F.col("title")))


def toc_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "toc_entries").select("entry_id", "source_id", "ord", "level", text.collapse(F.col("title")).alias("title"), F.when(F.col("pdf_page").isNotNull(), F.greatest("pdf_page", F.lit(0))).alias("pdf_page"))


def section_tree(spark: SparkSession, d: str) -> DataFrame:
    return outline.section_tree(_toc(spark, d)).select("source_id", "ord", "depth", "parent_id", "section_id", "is_root")


def section_page_ranges(spark: SparkSession, d: str) -> DataFrame:
    toc = outline.one_delivery(table(spark, d, "toc_entries")).where("pdf_page is not null")
    books = table(spark, d, "pdf_sources").select("source_id", "page_count")
    return outline.page_ranges(toc.join(books, "source_id")).select("source_id", "ord", F.col("pdf_page").alias("page_from"), F.col("page_end").alias("page_to"))


def note_paths(spark: SparkSession, d: str) -> DataFrame:
    return outline.note_paths(outline.section_tree(_toc(spark, d)))


def parent_clipping(spark: SparkSession, d: str) -> DataFrame:
    return outline.clip_to_children(table(spark, d, "sections")).select("section_row", "text_page_end")


def overlapping_siblings(spark: SparkSession, d: str) -> DataFrame:
    return outline.overlapping_siblings(table(spark, d, "sections")).select("section_row")


def section_page_filter(spark: SparkSession, d: str) -> DataFrame:
    return outline.page_filter(table(spark, d, "sections"), 10, 20).select("section_row")


def section_pattern_filter(spark: SparkSession, d: str) -> DataFrame:
    return outline.pattern_filter(table(spark, d, "sections"), ["lantern", "iron-gate", "tower"]).select("section_row", "section_id")


def single_root_unwrap(spark: SparkSession, d: str) -> DataFrame:
    """Every outline put below a root named like its book, and unwrapped again."""
    t = _toc(spark, d).select("source_id", (F.col("ord") + 1).alias("ord"), (F.col("level") + 1).alias("level"), "slug")
    roots = t.select("source_id").distinct().select("source_id", F.lit(0).alias("ord"), F.lit(1).alias("level"), F.col("source_id").alias("slug"))
    tree = outline.section_tree(t.unionByName(roots))
    return outline.unwrap_single_root(tree).select("source_id", "ord", "level", "parent_id", "section_id", "is_root")


def _page_refs(spark: SparkSession, d: str):
    """Every bookmarked page, and for each book one that it may not have."""
    refs = table(spark, d, "toc_entries").where("pdf_page is not null").select("source_id", F.col("pdf_page").alias("page")).distinct()
    return refs.unionByName(table(spark, d, "pdf_sources").select("source_id", (F.col("page_count") * 2).alias("page"))).unionByName(table(spark, d, "pdf_sources").select("source_id", F.lit(1 << 30).alias("page"))).distinct()


def page_ref_resolve(spark: SparkSession, d: str) -> DataFrame:
    return outline.resolve_pages(_page_refs(spark, d), table(spark, d, "sections")).where("section_id is not null")


def unresolved_refs(spark: SparkSession, d: str) -> DataFrame:
    return outline.resolve_pages(_page_refs(spark, d), table(spark, d, "sections")).where("section_id is null").select("source_id", "page")


def page_fill_asof(spark: SparkSession, d: str) -> DataFrame:
    """The last known page at or before each bookmark, 0 before the first."""
    from pyspark.sql import Window

    w = Window.partitionBy("source_id").orderBy("ord", "entry_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, d, "toc_entries").select("entry_id", F.coalesce(F.last("pdf_page", ignorenulls=True).over(w), F.lit(0)).alias("page"))


def slug_unicode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").select("section_row", text.slug(F.col("title")).alias("slug"))


def relative_links(spark: SparkSession, d: str) -> DataFrame:
    """The shortest relative link for every link listed in a report."""
    x = table(spark, d, "validation_reports").select("report_id", F.posexplode("broken_links").alias("pos", "x")).where("x.target != ''")
    target = paths.resolve(F.col("x.file"), F.col("x.target"))
    return x.select("report_id", "pos", F.col("x.file").alias("file"), target.alias("target"), paths.relative(F.col("x.file"), target).alias("link"))


def roman_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pdf_sources").select("source_id", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("n"))
    return p.select("source_id", "n", text.page_label(F.lit(""), F.lit("/r"), F.col("n")).alias("label"))


def alpha_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pdf_sources").select("source_id", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("n"))
    return p.select("source_id", "n", text.page_label(F.lit("App-"), F.lit("/a"), F.col("n")).alias("label"))


def printed_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").select("section_row", text.page_number(F.col("printed_page_start")).alias("page"))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    """Ten pages of front matter in Roman numerals, then the body."""
    books = table(spark, d, "pdf_sources")
    rows = F.expr("array(named_struct('start', 0, 'prefix', '', 'style', '/r', 'first', 1), named_struct('start', 10, 'prefix', 'A-', 'style', '/D', 'first', 1))")
    return outline.page_labels(books.select("source_id", F.inline(rows)), books)


def label_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d)


def section_labels(spark: SparkSession, d: str) -> DataFrame:
    return outline.label_sections(table(spark, d, "sections"), _labels(spark, d)).select("section_row", "label_start", "label_end")


def label_cascade(spark: SparkSession, d: str) -> DataFrame:
    """The printed pages of a book's sections where it has any, else its label ranges, else numbers."""
    s = table(spark, d, "sections").where("printed_page_start is not null and pdf_page_start is not null")
    printed = s.groupBy("source_id", F.col("pdf_page_start").alias("page")).agg(F.min("printed_page_start").alias("label"))
    return outline.cascade([printed, _labels(spark, d)], table(spark, d, "pdf_sources"))


def slug_disambiguate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").where("title is not null").select("section_row", outline.distinct_slug(F.lit("the-rules"), F.col("title")).alias("slug"))


_DEDUP = "t AS (SELECT source_id, ord, min_by(level, entry_id) AS level, min_by(title, entry_id) AS title, min_by(pdf_page, entry_id) AS pdf_page FROM toc_entries GROUP BY ALL)"
_SLUG = r"""coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(title, '[()\[\]{}]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled')"""
_BL = r"[ \t\n\r\f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# the stack itself, as a fold over each book's outline: every element is level and path
_TREE = f"""
WITH RECURSIVE {_DEDUP},
n AS (SELECT source_id, ord, level, {_SLUG} AS slug, row_number() OVER (PARTITION BY source_id ORDER BY ord) AS n FROM t),
r AS (
  SELECT source_id, ord, level, slug, n, CAST(NULL AS VARCHAR) AS up, [slug] AS stack FROM n WHERE n = 1
  UNION ALL
  SELECT n.source_id, n.ord, n.level, n.slug, n.n,
         CASE WHEN n.level >= 2 AND len(r.stack) >= n.level - 1 THEN r.stack[n.level - 1] END,
         list_append(r.stack[1:n.level - 1], CASE WHEN n.level >= 2 AND len(r.stack) >= n.level - 1 THEN r.stack[n.level - 1] || '/' || n.slug ELSE n.slug END)
  FROM r JOIN n ON n.source_id = r.source_id AND n.n = r.n + 1),
o AS (SELECT source_id, ord, CAST(len(stack) AS INTEGER) AS depth, CASE WHEN up IS NOT NULL THEN source_id || '/' || up END AS parent_id, source_id || '/' || stack[-1] AS section_id, level = 1 AS is_root FROM r)
"""
_NUM = "TRY_CAST(CASE WHEN regexp_matches(trim(string_split({c}, '-')[1]), '^[0-9]{{1,9}}$') THEN trim(string_split({c}, '-')[1]) END AS INTEGER)"
_LEAF = f"""
WITH s AS (SELECT s.*, {_NUM.format(c="printed_page_start")} AS p1, {_NUM.format(c="coalesce(printed_page_end, printed_page_start)")} AS p2,
             CASE WHEN EXISTS (SELECT 1 FROM sections c WHERE c.source_id = s.source_id AND c.parent_id = s.section_id) THEN 1 ELSE 0 END AS inner_ FROM sections s),
v AS (SELECT source_id, section_id, inner_, ord, section_row, 0 AS rank, CASE WHEN printed_page_start IS NULL THEN pdf_page_start ELSE p1 END AS a, CASE WHEN printed_page_start IS NULL THEN pdf_page_end ELSE p2 END AS b FROM s
      UNION ALL SELECT source_id, section_id, inner_, ord, section_row, 1, pdf_page_start, pdf_page_end FROM s),
r AS (SELECT source_id, pdf_page AS page FROM toc_entries WHERE pdf_page IS NOT NULL UNION SELECT source_id, page_count * 2 FROM pdf_sources UNION SELECT source_id, 1073741824 FROM pdf_sources),
o AS (SELECT r.source_id, r.page, v.section_id, CASE rank WHEN 0 THEN 'printed' ELSE 'file' END AS tier, row_number() OVER (PARTITION BY r.source_id, r.page ORDER BY rank, inner_, ord, section_row) AS k
      FROM r JOIN v ON v.source_id = r.source_id AND r.page BETWEEN v.a AND v.b),
m AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.source_id = r.source_id AND o.page = r.page)),
x AS (SELECT m.source_id, m.page, v.section_id, row_number() OVER (PARTITION BY m.source_id, m.page ORDER BY v.source_id, rank, inner_, ord, section_row) AS k FROM m LEFT JOIN v ON m.page BETWEEN v.a AND v.b),
j AS (SELECT source_id, page, section_id, tier FROM o WHERE k = 1 UNION ALL SELECT source_id, page, section_id, 'other' FROM x WHERE k = 1)
"""
_ROMAN = "lower(repeat('M', n // 1000) || ['','C','CC','CCC','CD','D','DC','DCC','DCCC','CM'][n // 100 % 10 + 1] || ['','X','XX','XXX','XL','L','LX','LXX','LXXX','XC'][n // 10 % 10 + 1] || ['','I','II','III','IV','V','VI','VII','VIII','IX'][n % 10 + 1])"
SQL = {
    "toc_clean": f"SELECT entry_id, source_id, ord, level, trim(regexp_replace(title, '{_BL}+', ' ', 'g')) AS title, CASE WHEN pdf_page < 0 THEN 0 ELSE pdf_page END AS pdf_page FROM toc_entries",
    "section_tree": _TREE + "SELECT * FROM o",
    "note_paths": _TREE + ", d AS (SELECT DISTINCT source_id, section_id FROM o) SELECT source_id, section_id, 'books/' || section_id || CASE WHEN section_id IN (SELECT parent_id FROM o WHERE parent_id IS NOT NULL) THEN '/index.md' ELSE '.md' END AS path FROM d",
    "section_page_ranges": f"""WITH {_DEDUP}, p AS (SELECT t.*, page_count FROM t JOIN pdf_sources USING (source_id) WHERE pdf_page IS NOT NULL)
        , q AS (SELECT source_id, ord, pdf_page, page_count, (SELECT min_by(q.pdf_page, q.ord) FROM p q WHERE q.source_id = p.source_id AND q.ord > p.ord AND q.level <= p.level) AS nxt FROM p)
        SELECT source_id, ord, pdf_page AS page_from, CASE WHEN nxt IS NULL THEN page_count - 1 ELSE greatest(pdf_page, nxt - 1) END AS page_to FROM q""",
    "parent_clipping": """WITH f AS (SELECT source_id, parent_id, min(pdf_page_start) m FROM sections WHERE parent_id IS NOT NULL GROUP BY ALL)
        SELECT section_row, CASE WHEN m IS NULL THEN pdf_page_end ELSE least(pdf_page_end, greatest(m - 1, pdf_page_start)) END AS text_page_end
        FROM sections s LEFT JOIN f ON f.source_id = s.source_id AND f.parent_id = s.section_id""",
    "overlapping_siblings": """WITH s AS (SELECT section_row, source_id, parent_id, pdf_page_start AS a, row_number() OVER (PARTITION BY source_id, parent_id ORDER BY ord, section_row) AS k FROM sections)
        SELECT DISTINCT unnest([x.section_row, y.section_row]) AS section_row FROM s x JOIN s y ON x.source_id = y.source_id AND x.parent_id IS NOT DISTINCT FROM y.parent_id AND y.k = x.k + 1 AND x.a = y.a""",
    "section_page_filter": "SELECT section_row FROM sections WHERE pdf_page_end >= 10 AND pdf_page_start <= 20",
    "section_pattern_filter": "SELECT DISTINCT section_row, section_id FROM sections, (VALUES ('lantern'), ('iron-gate'), ('tower')) v(p) WHERE section_id = p OR slug = p OR section_id LIKE '%/' || p OR contains(lower(title), p)",
    "page_ref_resolve": _LEAF + "SELECT source_id, page, section_id, tier FROM j WHERE section_id IS NOT NULL",
    "unresolved_refs": _LEAF + "SELECT source_id, page FROM j WHERE section_id IS NULL",
    "page_fill_asof": "SELECT entry_id, coalesce(last_value(pdf_page IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY ord, entry_id ROWS UNBOUNDED PRECEDING), 0) AS page FROM toc_entries",
    "roman_labels": f"WITH p AS (SELECT source_id, unnest(generate_series(1, page_count)) AS n FROM pdf_sources) SELECT source_id, CAST(n AS INTEGER) AS n, {_ROMAN} AS label FROM p",
    "alpha_labels": """WITH p AS (SELECT source_id, unnest(generate_series(1, page_count)) AS n FROM pdf_sources)
        SELECT source_id, CAST(n AS INTEGER) AS n, 'App-' || CASE WHEN n > 702 THEN chr(CAST(97 + ((n - 1) // 26 - 1) // 26 - 1 AS INTEGER)) ELSE '' END || CASE WHEN n > 26 THEN chr(CAST(97 + ((n - 1) // 26 - 1) % 26 AS INTEGER)) ELSE '' END || chr(CAST(97 + (n - 1) % 26 AS INTEGER)) AS label FROM p""",
    "printed_pages": "SELECT section_row, TRY_CAST(CASE WHEN regexp_matches(trim(string_split(printed_page_start, '-')[1]), '^[0-9]{1,9}$') THEN trim(string_split(printed_page_start, '-')[1]) END AS INTEGER) AS page FROM sections",
}
_RANGES = f"l AS (SELECT source_id, CAST(page AS INTEGER) AS page, CASE WHEN page < 10 THEN {_ROMAN.replace('n //', '(page + 1) //').replace('n %', '(page + 1) %')} ELSE 'A-' || (page - 9) END AS label FROM (SELECT source_id, unnest(generate_series(0, page_count - 1)) AS page FROM pdf_sources))"
SQL["label_ranges"] = f"WITH {_RANGES} SELECT * FROM l"
SQL["section_labels"] = f"WITH {_RANGES} SELECT section_row, a.label AS label_start, b.label AS label_end FROM sections s LEFT JOIN l a ON a.source_id = s.source_id AND a.page = pdf_page_start LEFT JOIN l b ON b.source_id = s.source_id AND b.page = pdf_page_end"
SQL["label_cascade"] = f"""WITH {_RANGES}, p AS (SELECT source_id, pdf_page_start AS page, min(printed_page_start) AS label FROM sections WHERE printed_page_start IS NOT NULL AND pdf_page_start IS NOT NULL GROUP BY ALL)
    SELECT l.source_id, l.page, coalesce(CASE WHEN l.source_id IN (SELECT source_id FROM p) THEN p.label ELSE l.label END, CAST(l.page + 1 AS VARCHAR)) AS label FROM l LEFT JOIN p ON p.source_id = l.source_id AND p.page = l.page"""
SQL["slug_disambiguate"] = r"SELECT section_row, 'the-rules-' || coalesce(list_filter(regexp_split_to_array(lower(title), '\s+'), lambda w: length(w) > 2 AND NOT contains('the-rules', w))[1], 'rules') AS slug FROM sections WHERE title IS NOT NULL"
QUERIES = {f.__name__: f for f in (label_ranges, section_labels, label_cascade, slug_disambiguate, toc_clean, section_tree, section_page_ranges, note_paths, parent_clipping, overlapping_siblings, section_page_filter, section_pattern_filter, single_root_unwrap, page_ref_resolve, unresolved_refs, page_fill_asof, slug_unicode, relative_links, roman_labels, alpha_labels, printed_pages)}
