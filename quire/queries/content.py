"""Text, table, glossary, diagnostics and catalogue queries over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import paths, repair, text
from quire.operators import catalog, diagnostics, links, markdown, splitting, tables
from quire.session import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def title_normalize(spark, d):
    return table(spark, d, "sections").select("section_row", text.title_key(F.col("title")).alias("key"))


def affix_strip(spark, d):
    return table(spark, d, "sections").select("section_row", text.strip_affixes(text.title_key(F.col("title"))).alias("key"))


def entity_slug(spark, d):
    return table(spark, d, "glossary").select("glossary_id", text.entity_slug(F.col("term")).alias("slug"))


def source_id_slug(spark, d):
    stem = F.regexp_replace(paths.basename(F.col("path")), r"\.[^.]*$", "")
    return table(spark, d, "pdf_sources").select("source_id", text.source_slug(stem).alias("slug"))


def bullet_normalize(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(text.bullets(F.col("text"))).alias("h"))


def whitespace_normalize(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(text.tidy(F.col("text"))).alias("h"))


def running_header_strip(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(text.drop_running_headers(F.col("text"))).alias("h"))


def br_in_tables(spark, d):
    return table(spark, d, "pipe_tables").select("table_id", text.breaks_in_tables(F.col("raw_text")).alias("text"))


def page_ref_annotate(spark, d):
    return table(spark, d, "glossary").select("glossary_id", text.annotate_pages(F.concat(F.coalesce("definition", F.lit("")), F.lit(" See page "), F.coalesce(F.col("page").cast("string"), F.lit("x")), F.lit(" and pp. 3-5."))).alias("text"))


def heading_scan(spark, d):
    return markdown.headings(_docs(spark, d), "doc_id", "text")


def heading_ranges(spark, d):
    return markdown.heading_ranges(markdown.headings(_docs(spark, d), "doc_id", "text"), "doc_id").select("doc_id", "line", "line_end")


def heading_match_exact(spark, d):
    heads = markdown.headings(_docs(spark, d), "doc_id", "text").join(_docs(spark, d).select("doc_id", F.col("source").alias("source_id")), "doc_id")
    return markdown.match_headings(heads, table(spark, d, "sections")).select("source_id", "section_id", "doc_id", "line")


def heading_dedupe(spark, d):
    s = table(spark, d, "sections").groupBy("section_id").agg(F.min_by("title", "section_row").alias("title"))
    return _docs(spark, d).where("text is not null").join(s, "section_id").select("doc_id", markdown.drop_title_heading(F.col("text"), F.col("title")).alias("text"))


def page_text_clean(spark, d):
    return _docs(spark, d).select("doc_id", markdown.clean_page_text(F.col("text")).alias("text"))


def broken_doc_links(spark, d):
    """Links in section texts whose note is not there; the note of a section lies where its id says."""
    docs = _docs(spark, d).where("section_id is not null").select("doc_id", "text", F.concat(F.lit("books/"), "section_id", F.lit(".md")).alias("file"))
    x = markdown.links(docs, "doc_id", "text").join(docs.select("doc_id", "file"), "doc_id")
    x = x.select("doc_id", "n", paths.resolve(F.col("file"), F.col("target")).alias("path"))
    return x.join(table(spark, d, "notes").select("path").distinct(), "path", "left_anti").select("doc_id", "n", "path")


def _tables(spark, d):
    return tables.parse_tables(table(spark, d, "pipe_tables"), "table_id", "raw_text")


def pipe_table_parse(spark, d):
    return tables.table_cells(_tables(spark, d), "table_id")


def pipe_table_filter(spark, d):
    return tables.filter_tables(_tables(spark, d), 4, 3).select("table_id")


def table_summary(spark, d):
    t = _tables(spark, d).join(table(spark, d, "pipe_tables").select("table_id", "source_id", "section_id"), "table_id")
    return t.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_tables"), F.count_distinct("section_id").alias("n_sections"), F.sum(F.size("body")).alias("n_rows"))


def table_markdown(spark, d):
    return tables.render(_tables(spark, d), "table_id")


def table_csv(spark, d):
    return tables.to_csv(_tables(spark, d), "table_id")


def glossary_scan(spark, d):
    """Entries written into a text in the three shapes and read back."""
    g = table(spark, d, "glossary").where("definition is not null")
    shape = F.col("glossary_id") % 3
    line = F.when(shape == 0, F.concat(F.lit("**"), "term", F.lit(" —** "), "definition")).when(shape == 1, F.concat(F.lit("**"), "term", F.lit("**: "), "definition")).otherwise(F.concat(F.lit("**"), "term", F.lit("** — "), "definition"))
    found = markdown.definitions(g.select("glossary_id", line.alias("text")), "glossary_id", "text")
    return found.where(markdown.is_term(F.col("term"), F.col("definition")))


def glossary_dedupe(spark, d):
    return markdown.first_entries(table(spark, d, "glossary"))


def glossary_letters(spark, d):
    g = table(spark, d, "glossary").where(F.length("term") > 0).groupBy("source_id").agg(F.array_join(F.sort_array(F.collect_set(F.upper(F.substring(F.ltrim("term"), 1, 1)))), ",").alias("letters"))
    return g


def glossary_sections(spark, d):
    s = table(spark, d, "sections").groupBy("source_id", "section_id").agg(F.min_by("title", "section_row").alias("section_title"))
    return table(spark, d, "glossary").select("glossary_id", "source_id", "section_id").join(s, ["source_id", "section_id"], "left").select("glossary_id", "section_title")


def see_also_terms(spark, d):
    g = table(spark, d, "glossary").where("term is not null")
    return links.see_also(g, g.where("definition is not null"))


def entity_links(spark, d):
    """Definitions with links to the terms of their book."""
    g = table(spark, d, "glossary").where("definition is not null")
    texts = g.select("source_id", F.col("glossary_id").alias("key"), F.concat(F.lit("books/"), "source_id", F.lit("/terms/"), F.col("glossary_id").cast("string"), F.lit(".md")).alias("path"), F.col("definition").alias("text"))
    return links.link_terms(texts, table(spark, d, "glossary").where("term is not null")).withColumnRenamed("key", "glossary_id")


def heading_jaccard(spark, d):
    """Section titles and bookmark titles of one book that share at least half their words, but are not the same."""
    key = lambda t: table(spark, d, t).where("title is not null").select("source_id", text.title_key(F.col("title")).alias("key"))
    return splitting.similar_titles(key("sections"), key("toc_entries"), 0.5).where("a != b").withColumn("score", F.round("score", 6))


def section_split(spark, d):
    """Every section's text out of the whole Markdown of its book: by heading, else by page anchors."""
    s = table(spark, d, "sections").groupBy("source_id", "section_id").agg(F.min_by(F.struct("ord", "title", F.col("pdf_page_start").alias("page"), F.col("pdf_page_end").alias("page_end")), "section_row").alias("s")).select("source_id", "section_id", "s.*")
    docs = _docs(spark, d).select(F.col("source").alias("source_id"), F.col("doc_id").alias("doc"), "text")
    return splitting.split_by_headings(docs, s).select("source_id", "section_id", "tier", "h", F.md5("text").alias("text"))


def merge_same_headings(spark, d):
    docs = _docs(spark, d).select(F.col("source").alias("source_id"), F.col("doc_id").alias("doc"), "text")
    return splitting.headings(splitting.lines(docs)).select("source_id", "h", F.col("doc").alias("doc_id"), "line", "level", "key")


def repair_text(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(repair.repair(F.col("text"))).alias("h"))


def anchor_strip(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(repair.clean_anchors(F.col("text"))).alias("h"))


def glossary_extract(spark, d):
    docs = _docs(spark, d).select(F.col("source").alias("source_id"), F.col("doc_id").alias("doc"), "section_id", "text")
    return markdown.extract_glossary(docs)


def structured_fields(spark, d):
    return markdown.field_values(_docs(spark, d), "doc_id", "text")


def lexicon_sections(spark, d):
    return _docs(spark, d).where("text is not null").where(markdown.is_lexicon(F.col("section_id"), F.col("text"))).select("doc_id")


def list_sources(spark, d):
    return table(spark, d, "pdf_sources").select("source_id", "path", "sha256", "page_count").orderBy("source_id")


def book_last_page(spark, d):
    s = table(spark, d, "sections").groupBy("source_id").agg(F.max("pdf_page_end").alias("page"))
    return table(spark, d, "pdf_sources").select("source_id").join(s, "source_id", "left").select("source_id", F.coalesce("page", F.lit(0)).alias("page"))


def glossary_letter_breaks(spark, d):
    """The entries of each book by term, and where a new letter begins."""
    w = Window.partitionBy("source_id").orderBy(F.lower("term"), "glossary_id")
    g = table(spark, d, "glossary").where(F.length(F.trim("term")) > 0).withColumn("letter", F.upper(F.left(F.trim("term"), F.lit(1))))
    return g.select("glossary_id", "letter", (~F.lag("letter").over(w).eqNullSafe(F.col("letter"))).alias("new_letter"))


def toc_dedupe(spark, d):
    """Bookmarks without those that repeat level and title of the one before."""
    w = Window.partitionBy("source_id").orderBy("ord", "entry_id")
    same = F.lag("level").over(w).eqNullSafe(F.col("level")) & F.lag("title").over(w).eqNullSafe(F.col("title"))
    return table(spark, d, "toc_entries").withColumn("same", same).where("not same").select("entry_id")


def toc_level_sets(spark, d):
    """The levels of each book's outline, and whether it lacks the upper ones and would be promoted."""
    t = table(spark, d, "toc_entries").groupBy("source_id").agg(F.sort_array(F.collect_set("level")).alias("l"))
    return t.select("source_id", F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("levels"), (F.array_min("l") > 1).alias("promote"))


def roman_to_int(spark, d):
    p = table(spark, d, "pdf_sources").select("source_id", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("n"))
    r = p.withColumn("label", F.lower(text.roman(F.col("n"))))
    return r.select("source_id", "label", text.roman_value(F.col("label")).alias("value"), text.is_roman(F.col("label")).alias("front"))


def empty_columns(spark, d):
    """Columns of tables of which no cell has more than two characters."""
    c = tables.table_cells(_tables(spark, d), "table_id")
    return c.groupBy("table_id", "col").agg(F.bool_and(F.length(F.trim("value")) <= 2).alias("empty")).where("empty").select("table_id", "col")


def expected_files(spark, d):
    s = table(spark, d, "sections").select(F.col("markdown_output_path").alias("path")).where("path is not null")
    return s.union(table(spark, d, "notes").where("kind != 'section'").select("path")).distinct()


def _spans(spark, d):
    return table(spark, d, "events").select(F.lit("events").alias("source_id"), F.col("event_id").alias("span_id"), F.dayofmonth("ts").alias("page"), F.col("event_type").alias("font"), F.round(F.col("value") / 50).alias("size"), (F.col("event_id") % 32).cast("int").alias("flags"), F.col("props").alias("text"), (F.col("user_id") % 700).cast("double").alias("y"))


def font_stats(spark, d):
    return diagnostics.font_stats(_spans(spark, d))


def font_sizes_topk(spark, d):
    return diagnostics.top_sizes(_spans(spark, d))


def body_font_mode(spark, d):
    return diagnostics.body_size(_spans(spark, d), ["page"])


def header_footer_lines(spark, d):
    return diagnostics.running_lines(_spans(spark, d))


def suspicious_chars(spark, d):
    return diagnostics.suspicious(_docs(spark, d), "doc_id", "text")


def char_freq_topk(spark, d):
    return diagnostics.char_frequency(table(spark, d, "sections"), "level", "title", 20).select("level", F.hex(F.encode("char", "UTF-8")).alias("char"), "count", "rank")


def step_latest_status(spark, d):
    e = table(spark, d, "events").select(F.col("user_id"), F.col("event_type").alias("step"), "ts", "event_id", F.when(F.col("value") > 100, "completed").otherwise("failed").alias("status"))
    return catalog.latest(e, ["user_id", "step"], "ts", "event_id").select("user_id", "step", "status", "event_id")


def pending_steps(spark, d):
    return catalog.pending(table(spark, d, "events").select("user_id", F.col("event_type").alias("step")).distinct(), step_latest_status(spark, d), ["user_id", "step"])


def source_upsert(spark, d):
    s = table(spark, d, "pdf_sources").select("source_id", "sha256", "page_count")
    new = s.where("page_count % 2 = 0").withColumn("page_count", F.col("page_count") + 1)
    return catalog.upsert(s, new, ["source_id"])


def content_key(spark, d):
    return table(spark, d, "pdf_sources").select("source_id", F.coalesce(F.when(F.col("page_count") % 3 > 0, F.col("sha256")), "source_id").alias("key"), F.concat(paths.basename(F.col("path")), F.lit(" (sha256:"), F.left("sha256", F.lit(16)), F.lit(")")).alias("ref"))


def orphan_files(spark, d):
    wanted = table(spark, d, "sections").select(F.col("markdown_output_path").alias("path"))
    return catalog.missing_files(table(spark, d, "notes").where("kind = 'section'"), wanted.where("path is not null"))


def stale_files(spark, d):
    n = table(spark, d, "notes")
    return catalog.missing_files(n.where("deleted_at is not null"), n.where("deleted_at is null"))


def image_ref_resolve(spark, d):
    refs = table(spark, d, "image_map").select("source_id", F.when(F.col("image_id") % 3 == 0, F.concat(F.lit("_"), "ref_name")).when(F.col("image_id") % 3 == 1, F.regexp_replace("ref_name", r"[0-9]+(\.\w+)$", "99$1")).otherwise(F.col("ref_name")).alias("ref")).distinct()
    return catalog.image_paths(refs, table(spark, d, "image_map"))


def validation_summary(spark, d):
    return catalog.report_summary(table(spark, d, "validation_reports"))


def extraction_summary(spark, d):
    return _docs(spark, d).groupBy("source").agg(F.count_if(F.coalesce(F.length(F.trim("text")) > 0, F.lit(False))).alias("n_filled"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))


def book_index(spark, d):
    """The chapters of each book; one row a book of its level-1 sections only."""
    s = table(spark, d, "sections").where("level = 1").groupBy("source_id", "section_id").agg(F.min("ord").alias("ord"), F.min_by("title", "section_row").alias("title"))
    return s.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_chapters"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "section_id", "title"))), lambda x: F.concat(F.lit("- "), x["title"])), "\n")).alias("h"))


def global_index(spark, d):
    books = table(spark, d, "pdf_sources").select("source_id", "page_count")
    roots = table(spark, d, "sections").where("level = 1").groupBy("source_id").agg(F.count_distinct("section_id").alias("n"))
    j = books.join(roots, "source_id", "left")
    return j.select("source_id", F.concat("source_id", F.lit(": "), F.col("page_count").cast("string"), F.lit(" pages, "), F.coalesce("n", F.lit(0)).cast("string"), F.when(F.coalesce("n", F.lit(0)) == 1, " chapter").otherwise(" chapters")).alias("line"))


_B = "•◦▪►‣▸▹●○◎"
_BL = r"[ \t\n\r\f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_KEY = rf"regexp_replace(lower(trim(regexp_replace(regexp_replace(title, '[*_`\[\]():\x{{ad}}]', '', 'g'), '{_BL}+', ' ', 'g'))), '[.,;:!?]+$', '')"
_AFF = rf"trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace({{k}}, '{_BL}+', ' ', 'g')), '^(?:(?:the|a|an|chapter|ch|section|part|book|appendix) )+(\S)', '\1'), '(?:(?:^| )(?:contd|continued|cont))+$', ''), '^[0-9]+\.?', ''))"
_SEP = r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$"
_CELLS = r"list_transform(string_split(regexp_replace(regexp_replace(trim({x}), '^\|', ''), '\|$', ''), '|'), lambda q: trim(q))"
_PARSE = rf"""
WITH l AS (SELECT table_id, source_id, section_id, string_split(regexp_replace(regexp_replace(raw_text, '^\s+', ''), '\s+$', ''), chr(10)) AS x FROM pipe_tables),
s AS (SELECT *, list_position(list_transform(x, lambda y: contains(y, '-') AND contains(y, '|') AND regexp_matches(y, '{_SEP}')), true) AS at_ FROM l WHERE len(x) >= 3),
h AS (SELECT table_id, source_id, section_id, {_CELLS.format(x="x[at_ - 1]")} AS raw, list_filter(x[at_ + 1:], lambda y: trim(y) <> '') AS rest FROM s WHERE at_ >= 2),
c AS (SELECT *, list_transform(raw, lambda q, i: CASE WHEN q = '' THEN 'col_' || i ELSE q END) AS named, coalesce(list_position(list_transform(rest, lambda y: contains(y, '|')), false), len(rest) + 1) AS stop_ FROM h),
b AS (SELECT table_id, source_id, section_id, list_transform(named, lambda q, i: q || CASE WHEN len(list_filter(named[1:i - 1], lambda z: z = q)) > 0 THEN '_' || len(list_filter(named[1:i - 1], lambda z: z = q)) ELSE '' END) AS headers,
             list_filter(rest[1:stop_ - 1], lambda y: NOT (contains(y, '-') AND regexp_matches(y, '{_SEP}'))) AS body FROM c),
t AS (SELECT * FROM b WHERE len(body) > 0)
"""
_NORM = r"trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_STATUS = "s AS (SELECT user_id, event_type AS step, max_by(CASE WHEN value > 100 THEN 'completed' ELSE 'failed' END, (ts, event_id)) AS status, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL)"
_SPANS = "v AS (SELECT event_id AS span_id, day(ts) AS page, event_type AS font, round(value / 50) AS size, event_id % 32 AS flags, props AS text, CAST(user_id % 700 AS DOUBLE) AS y FROM events)"
SQL = {
    "title_normalize": f"SELECT section_row, {_KEY} AS key FROM sections",
    "affix_strip": f"SELECT section_row, {_AFF.replace('{k}', _KEY)} AS key FROM sections",
    "entity_slug": f"SELECT glossary_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(term, '{_BL}+', ' ', 'g'))), '\\s+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown') AS slug FROM glossary",
    "source_id_slug": r"SELECT source_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', ''), '[()\[\]{}]', '', 'g')), '[ _]', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unnamed-source') AS slug FROM pdf_sources",
    "bullet_normalize": rf"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '(?m)^([ \t]*)[{_B}]([{_B}]+)[ \t]*', '\1- \2 ', 'g'), '(?m)^([ \t]*)[{_B}][ \t]*', '\1- ', 'g')) AS h FROM documents",
    "whitespace_normalize": r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[ \t\r\f\x0b]+(\n)', '\1', 'g'), '[ \t\r\f\x0b]+$', ''), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') || chr(10)) AS h FROM documents",
    "running_header_strip": r"SELECT doc_id, md5(regexp_replace(text, '(?m)^[ \t]*>>[ \t]+[^\n]+?[ \t]+<<[ \t]*$', '', 'g')) AS h FROM documents",
    "br_in_tables": r"SELECT table_id, array_to_string(list_transform(string_split(raw_text, chr(10)), lambda x: CASE WHEN contains(x, '|') THEN regexp_replace(x, '(?i)<br[ \t]*/?>', ' / ', 'g') ELSE x END), chr(10)) AS text FROM pipe_tables",
    "heading_scan": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE contains(text, '#')),
        h AS (SELECT doc_id, line, regexp_replace(s, '[ \t\r]+$', '') AS s FROM l WHERE regexp_matches(s, '^#{1,6}[ \t]+\S'))
        SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(length(regexp_extract(s, '^(#+)', 1)) AS INTEGER) AS level, regexp_extract(s, '^#{1,6}[ \t]+(.+)$', 1) AS title FROM h""",
    "pipe_table_parse": _PARSE + f", r AS (SELECT table_id, headers, unnest(body) AS line, generate_subscripts(body, 1) - 1 AS row FROM t), k AS (SELECT table_id, row, headers, {_CELLS.format(x='line')} AS v FROM r), u AS (SELECT table_id, row, v, unnest(headers) AS header, generate_subscripts(headers, 1) AS col FROM k) SELECT table_id, CAST(row AS INTEGER) AS row, CAST(col - 1 AS INTEGER) AS col, header, coalesce(v[col], '') AS value FROM u",
    "pipe_table_filter": _PARSE + "SELECT table_id FROM t WHERE len(body) >= 4 AND len(headers) >= 3",
    "table_summary": _PARSE + "SELECT source_id, count(*) AS n_tables, count(DISTINCT section_id) AS n_sections, CAST(sum(len(body)) AS BIGINT) AS n_rows FROM t GROUP BY ALL",
    "glossary_dedupe": "SELECT source_id, lower(term) AS key, max_by(glossary_id, CASE WHEN source_type = 'lexicon' THEN 1e12 + glossary_id ELSE -glossary_id END) AS glossary_id, count(*) AS n FROM glossary GROUP BY ALL",
    "glossary_letters": "WITH g AS (SELECT source_id, list_sort(list(DISTINCT upper(left(ltrim(term), 1)))) AS l FROM glossary WHERE length(term) > 0 GROUP BY ALL) SELECT source_id, array_to_string(l, ',') AS letters FROM g",
    "glossary_sections": "WITH s AS (SELECT source_id, section_id, min_by(title, section_row) AS section_title FROM sections GROUP BY ALL) SELECT glossary_id, section_title FROM glossary g LEFT JOIN s ON s.source_id = g.source_id AND s.section_id = g.section_id",
    "see_also_terms": f"""WITH t AS (SELECT DISTINCT source_id, lower(term) AS term, {_NORM.format(c='term')} AS plain FROM glossary WHERE length(term) > 2),
        d AS (SELECT source_id, glossary_id, lower(term) AS own, ' ' || {_NORM.format(c='definition')} || ' ' AS text FROM glossary WHERE definition IS NOT NULL AND term IS NOT NULL),
        h AS (SELECT d.source_id, glossary_id, t.term FROM d JOIN t ON t.source_id = d.source_id AND plain <> '' AND t.term <> own AND contains(text, ' ' || plain || ' ')),
        f AS (SELECT *, row_number() OVER (PARTITION BY source_id, glossary_id ORDER BY length(term) DESC, term) - 1 AS pos FROM h WHERE NOT EXISTS (SELECT 1 FROM h y WHERE y.source_id = h.source_id AND y.glossary_id = h.glossary_id AND y.term <> h.term AND contains(y.term, h.term)))
        SELECT source_id, glossary_id, term, CAST(pos AS INTEGER) AS pos FROM f WHERE pos < 8""",
    "list_sources": "SELECT source_id, path, sha256, page_count FROM pdf_sources",
    "book_last_page": "SELECT p.source_id, coalesce(max(pdf_page_end), 0) AS page FROM pdf_sources p LEFT JOIN sections s ON s.source_id = p.source_id GROUP BY ALL",
    "glossary_letter_breaks": "WITH g AS (SELECT *, upper(left(trim(term), 1)) AS letter FROM glossary WHERE length(trim(term)) > 0) SELECT glossary_id, letter, lag(letter) OVER (PARTITION BY source_id ORDER BY lower(term), glossary_id) IS DISTINCT FROM letter AS new_letter FROM g",
    "toc_dedupe": "WITH t AS (SELECT *, lag(entry_id) OVER w IS NOT NULL AND lag(level) OVER w IS NOT DISTINCT FROM level AND lag(title) OVER w IS NOT DISTINCT FROM title AS same FROM toc_entries WINDOW w AS (PARTITION BY source_id ORDER BY ord, entry_id)) SELECT entry_id FROM t WHERE NOT same",
    "toc_level_sets": "SELECT source_id, array_to_string(list_sort(list(DISTINCT level)), ',') AS levels, min(level) > 1 AS promote FROM toc_entries GROUP BY ALL",
    "roman_to_int": "WITH p AS (SELECT source_id, unnest(generate_series(1, page_count)) AS n FROM pdf_sources) SELECT source_id, " + "lower(repeat('M', n // 1000) || ['','C','CC','CCC','CD','D','DC','DCC','DCCC','CM'][n // 100 % 10 + 1] || ['','X','XX','XXX','XL','L','LX','LXX','LXXX','XC'][n // 10 % 10 + 1] || ['','I','II','III','IV','V','VI','VII','VIII','IX'][n % 10 + 1]) AS label, CAST(n AS INTEGER) AS value, n <= 20 OR n % 10 NOT IN (0, 5) AS front FROM p",
    "empty_columns": _PARSE + f", r AS (SELECT table_id, headers, unnest(body) AS line FROM t), k AS (SELECT table_id, headers, {_CELLS.format(x='line')} AS v FROM r), u AS (SELECT table_id, v, generate_subscripts(headers, 1) AS col FROM k) SELECT table_id, CAST(col - 1 AS INTEGER) AS col FROM u GROUP BY ALL HAVING bool_and(length(coalesce(v[col], '')) <= 2)",
    "expected_files": "SELECT markdown_output_path AS path FROM sections WHERE markdown_output_path IS NOT NULL UNION SELECT path FROM notes WHERE kind <> 'section'",
    "lexicon_sections": r"SELECT doc_id FROM documents WHERE text IS NOT NULL AND (contains(lower(coalesce(section_id, '')), 'lexicon') OR contains(lower(coalesce(section_id, '')), 'glossary') OR regexp_matches(lower(left(text, 200)), '^#+\s*(lexicon|glossary)\b') OR len(regexp_extract_all(text, '\*\*[^*]+\s*[—–]+\s*\*\*')) >= 5)",
    "anchor_strip": r"SELECT doc_id, md5(array_to_string(list_transform(string_split(regexp_replace(regexp_replace(text, '<span\s+id=\"page-[0-9]+-[0-9]+\"\s*>\s*</span>', '', 'g'), '<span\s*>\s*</span>', '', 'g'), chr(10)), lambda x: CASE WHEN contains(x, '|') THEN regexp_replace(x, '(?i)<br[ \t]*/?>', ' / ', 'g') ELSE x END), chr(10))) AS h FROM documents",
    "heading_jaccard": f"""WITH k AS (SELECT 's' AS t, source_id, {_KEY} AS key FROM sections WHERE title IS NOT NULL UNION SELECT 't', source_id, {_KEY} FROM toc_entries WHERE title IS NOT NULL),
        w AS (SELECT *, list_distinct(list_filter(string_split(key, ' '), lambda x: x <> '')) AS w1, list_distinct(list_filter(string_split({_AFF.replace('{k}', 'key')}, ' '), lambda x: x <> '')) AS w2 FROM k),
        j AS (SELECT a.source_id, a.key AS a, b.key AS b, len(list_intersect(a.w1, b.w1)) / nullif(len(list_distinct(list_concat(a.w1, b.w1))), 0) AS j1, len(list_intersect(a.w2, b.w2)) / nullif(len(list_distinct(list_concat(a.w2, b.w2))), 0) AS j2 FROM w a JOIN w b ON a.source_id = b.source_id AND a.t = 's' AND b.t = 't' AND a.key <> b.key)
        SELECT source_id, a, b, round(greatest(coalesce(j1, 0), coalesce(j2, 0)), 6) AS score FROM j WHERE greatest(coalesce(j1, 0), coalesce(j2, 0)) >= 0.5""",
    "font_stats": f"WITH {_SPANS} SELECT font, CAST(sum(length(text)) AS BIGINT) AS n_chars, count(*) AS n_spans, count(DISTINCT page) AS n_pages, bool_or(flags & 16 <> 0) AS bold, bool_or(flags & 2 <> 0) AS italic, bool_or(regexp_matches(font, '(?i)ding|symbol|zapf|wing|math|fantasy')) AS symbol FROM v GROUP BY ALL",
    "font_sizes_topk": f"WITH {_SPANS}, n AS (SELECT font, round(size, 1) AS size, count(*) AS count FROM v GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY font ORDER BY count DESC, size) AS INTEGER) AS rank FROM n) SELECT * FROM r WHERE rank <= 5",
    "body_font_mode": f"WITH {_SPANS}, n AS (SELECT page, size, count(*) AS n, min(span_id) AS f FROM v WHERE NOT regexp_matches(text, '^[\\s0-9]*$') GROUP BY ALL) SELECT CAST(page AS INTEGER) AS page, arg_max(size, (n, -f)) AS body_size FROM n GROUP BY ALL",
    "suspicious_chars": r"WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{80}-\x{9F}\x{E000}-\x{F8FF}\x{FFFD}]')) AS c FROM documents) SELECT doc_id, printf('%04X', unicode(c)) AS char, count(*) AS n FROM c GROUP BY ALL",
    "step_latest_status": f"WITH {_STATUS} SELECT user_id, step, status, event_id FROM s",
    "pending_steps": f"WITH {_STATUS} SELECT user_id, step FROM s WHERE status <> 'completed'",
    "source_upsert": "SELECT source_id, sha256, CASE WHEN page_count % 2 = 0 THEN page_count + 1 ELSE page_count END AS page_count FROM pdf_sources",
    "content_key": "SELECT source_id, CASE WHEN page_count % 3 > 0 THEN coalesce(sha256, source_id) ELSE source_id END AS key, string_split(path, '/')[-1] || ' (sha256:' || left(sha256, 16) || ')' AS ref FROM pdf_sources",
    "orphan_files": "SELECT DISTINCT path FROM notes WHERE kind = 'section' AND path NOT IN (SELECT markdown_output_path FROM sections WHERE markdown_output_path IS NOT NULL)",
    "stale_files": "SELECT DISTINCT path FROM notes WHERE deleted_at IS NOT NULL EXCEPT SELECT path FROM notes WHERE deleted_at IS NULL",
    "image_ref_resolve": r"""WITH r AS (SELECT DISTINCT source_id, CASE image_id % 3 WHEN 0 THEN '_' || ref_name WHEN 1 THEN regexp_replace(ref_name, '[0-9]+(\.\w+)$', '99\1') ELSE ref_name END AS ref FROM image_map),
        n AS (SELECT source_id, ref_name, min_by(path, image_id) AS path FROM image_map GROUP BY ALL), p AS (SELECT source_id, regexp_extract(ref_name, '^(_page_[0-9]+_)', 1) AS page, min_by(path, image_id) AS path FROM image_map WHERE regexp_matches(ref_name, '^_page_[0-9]+_') GROUP BY ALL)
        SELECT r.source_id, r.ref, coalesce(a.path, b.path, p.path) AS path, CASE WHEN a.path IS NOT NULL THEN 1 WHEN b.path IS NOT NULL THEN 2 WHEN p.path IS NOT NULL THEN 3 ELSE 0 END AS tier
        FROM r LEFT JOIN n a ON a.source_id = r.source_id AND a.ref_name = r.ref LEFT JOIN n b ON b.source_id = r.source_id AND b.ref_name = regexp_replace(r.ref, '^_', '') LEFT JOIN p ON p.source_id = r.source_id AND p.page = regexp_extract(r.ref, '(_page_[0-9]+_)', 1)""",
    "validation_summary": "WITH s AS (SELECT report_id, source_id, CAST(coalesce(len(broken_links), 0) AS INTEGER) AS n_links, CAST(coalesce(len(broken_images), 0) AS INTEGER) AS n_images, CAST(coalesce(len(orphan_files), 0) AS INTEGER) AS n_orphans, CAST(coalesce(len(unresolved_page_refs), 0) AS INTEGER) AS n_refs, CAST(coalesce(len(warnings), 0) AS INTEGER) AS n_warnings FROM validation_reports) SELECT *, n_links + n_images + n_orphans + n_refs = 0 AS is_clean FROM s",
    "extraction_summary": "SELECT source, count(*) FILTER (WHERE length(trim(text)) > 0) AS n_filled, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars FROM documents GROUP BY ALL",
    "book_index": "WITH s AS (SELECT source_id, section_id, min(ord) AS ord, min_by(title, section_row) AS title FROM sections WHERE level = 1 GROUP BY ALL) SELECT source_id, count(*) AS n_chapters, md5(string_agg('- ' || title, chr(10) ORDER BY ord, section_id, title)) AS h FROM s GROUP BY ALL",
    "global_index": "WITH r AS (SELECT source_id, count(DISTINCT section_id) AS n FROM sections WHERE level = 1 GROUP BY ALL) SELECT source_id, source_id || ': ' || page_count || ' pages, ' || coalesce(n, 0) || CASE WHEN coalesce(n, 0) = 1 THEN ' chapter' ELSE ' chapters' END AS line FROM pdf_sources LEFT JOIN r USING (source_id)",
}
_PADDED = "list_transform(generate_series(1, len(headers)), lambda i: coalesce(v[i], ''))"
_QUOTED = """list_transform({x}, lambda c: CASE WHEN regexp_matches(c, '[",\\r\\n]') THEN '"' || replace(c, '"', '""') || '"' ELSE c END)"""
_BODY = _PARSE + f", k AS (SELECT table_id, headers, list_transform(body, lambda y: {_CELLS.format(x='y')}) AS cells FROM t)"
SQL["table_markdown"] = _BODY + f" SELECT table_id, '| ' || array_to_string(headers, ' | ') || ' |' || chr(10) || '|' || array_to_string(list_transform(headers, lambda h: ' --- '), '|') || '|' || chr(10) || array_to_string(list_transform(cells, lambda v: '| ' || array_to_string({_PADDED}, ' | ') || ' |'), chr(10)) AS markdown FROM k"
SQL["table_csv"] = _BODY + f" SELECT table_id, array_to_string({_QUOTED.format(x='headers')}, ',') || chr(13) || chr(10) || array_to_string(list_transform(cells, lambda v: array_to_string({_QUOTED.format(x=_PADDED)}, ',')), chr(13) || chr(10)) || chr(13) || chr(10) AS csv FROM k"
SQL["char_freq_topk"] = "WITH c AS (SELECT level, unnest(regexp_extract_all(title, '(?s).')) AS ch FROM sections), n AS (SELECT level, hex(encode(ch)) AS char, count(*) AS count FROM c GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY level ORDER BY count DESC, char) AS INTEGER) AS rank FROM n) SELECT * FROM r WHERE rank <= 20"
SQL["heading_ranges"] = "WITH x AS (" + SQL["heading_scan"] + ") SELECT doc_id, line, CAST(lead(line) OVER (PARTITION BY doc_id ORDER BY line) - 1 AS INTEGER) AS line_end FROM x"
SQL["heading_match_exact"] = (
    "WITH x AS (" + SQL["heading_scan"] + f"), h AS (SELECT source AS source_id, x.doc_id, line, {_KEY} AS key FROM x JOIN documents d ON d.doc_id = x.doc_id), "
    f"s AS (SELECT DISTINCT source_id, section_id, {_KEY} AS key FROM sections), "
    "j AS (SELECT s.source_id, section_id, doc_id, line, row_number() OVER (PARTITION BY s.source_id, section_id ORDER BY doc_id, line) AS k FROM s JOIN h ON h.source_id = s.source_id AND h.key = s.key AND s.key <> '') "
    "SELECT source_id, section_id, doc_id, line FROM j WHERE k = 1"
)
_NAMES = (
    title_normalize, affix_strip, entity_slug, source_id_slug, bullet_normalize, whitespace_normalize, running_header_strip, br_in_tables, page_ref_annotate, heading_scan, heading_ranges, heading_match_exact, heading_dedupe, page_text_clean, broken_doc_links,
    pipe_table_parse, pipe_table_filter, table_summary, table_markdown, table_csv, glossary_scan, glossary_dedupe, glossary_letters, glossary_sections, see_also_terms, heading_jaccard, font_stats,
    font_sizes_topk, body_font_mode, header_footer_lines, suspicious_chars, char_freq_topk, step_latest_status, pending_steps, source_upsert, content_key, orphan_files, stale_files, image_ref_resolve,
    validation_summary, extraction_summary, book_index, global_index, entity_links, section_split, merge_same_headings, repair_text, anchor_strip, glossary_extract, structured_fields, lexicon_sections,
    list_sources, book_last_page, glossary_letter_breaks, toc_dedupe, toc_level_sets, roman_to_int, empty_columns, expected_files,
)
QUERIES = {f.__name__: f for f in _NAMES}
