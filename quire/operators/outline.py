"""Section trees out of flat outlines, by window functions over (source, order); no book is collected anywhere.

A reader of an outline keeps a stack of open sections. Its depth after entry n is min(level, depth before + 1), which
is n + min(0, min over the entries so far of (level - n)): a running minimum. The open section at depth k is the last entry
of depth k, so parents and paths are ``last`` windows. An entry that jumps over a level has no parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import page_label, page_number

#: No outline is deeper; a level beyond it is refused rather than cut.
MOST_LEVELS = 64


def levels_of(toc: DataFrame) -> int:
    """The deepest level of an outline, from the data."""
    deepest = toc.agg(F.max("level")).first()[0] or 1
    if deepest > MOST_LEVELS:
        raise ValueError(f"an outline of level {deepest}; at most {MOST_LEVELS} are read")
    return max(2, deepest)


def one_delivery(toc: DataFrame) -> DataFrame:
    """One row per (source_id, ord): the first delivered."""
    return toc.groupBy("source_id", "ord").agg(F.min_by(F.struct("entry_id", "level", "title", "pdf_page"), "entry_id").alias("e")).select("source_id", "ord", "e.*")


def section_tree(toc: DataFrame, slug: str = "slug", max_level: int | None = None) -> DataFrame:
    """Adds depth, parent_id, section_id and is_root to an outline (source_id, ord, level, slug, ...) of any depth."""
    max_level = max_level or levels_of(toc)
    book = Window.partitionBy("source_id").orderBy("ord")
    upto, before = book.rowsBetween(Window.unboundedPreceding, Window.currentRow), book.rowsBetween(Window.unboundedPreceding, -1)
    t = toc.withColumn("n", F.row_number().over(book))
    t = t.withColumn("depth", (F.col("n") + F.least(F.lit(0), F.min(F.col("level") - F.col("n")).over(upto))).cast("int"))
    # s: the open section at each depth; j: whether it was itself properly nested, since a jumped one starts a path of its own
    last = lambda k, c: F.last(F.when(F.col("depth") == k, c), ignorenulls=True).over(before)
    t = t.withColumns({f"s{k}": last(k, F.col(slug)) for k in range(1, max_level)} | {f"j{k}": last(k, F.col("level") != F.col("depth")) for k in range(1, max_level)})
    # the path of the open section at each depth; one column a depth, since each is read twice by the next
    t = t.withColumn("p1", F.col("s1"))
    for k in range(2, max_level):
        alone = F.coalesce(F.col(f"j{k}"), F.lit(False)) | F.col(f"p{k - 1}").isNull()
        t = t.withColumn(f"p{k}", F.when(alone, F.col(f"s{k}")).otherwise(F.concat_ws("/", f"p{k - 1}", f"s{k}")))
    nested = (F.col("level") >= 2) & (F.col("depth") == F.col("level"))
    paths = F.array(*[F.col(f"p{k}") for k in range(1, max_level)])
    t = t.withColumn("up", F.when(nested, F.get(paths, F.col("level") - 2)))
    out = t.withColumn("parent_id", F.when(F.col("up").isNotNull(), F.concat_ws("/", "source_id", "up")))
    out = out.withColumn("section_id", F.concat_ws("/", "source_id", "up", slug)).withColumn("is_root", F.col("level") == 1)
    return out.drop("n", "up", *[f"{x}{k}" for x in "sjp" for k in range(1, max_level)])


def page_ranges(toc: DataFrame, max_level: int | None = None) -> DataFrame:
    """Adds page_end: the page before the next entry that is no deeper, at least the own page; else the last page.

    ``page_count`` is a column of the outline.
    """
    max_level = max_level or levels_of(toc)
    # the following rows read backwards: a running frame, which needs no look-ahead for each row
    back = Window.partitionBy("source_id").orderBy(F.col("ord").desc()).rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.lit(None).cast("int")
    for k in range(1, max_level + 1):
        nxt = F.when(F.col("level") == k, F.last(F.when(F.col("level") <= k, F.col("pdf_page")), ignorenulls=True).over(back)).otherwise(nxt)
    return toc.withColumn("page_end", F.when(nxt.isNull(), F.col("page_count") - 1).otherwise(F.greatest(F.col("pdf_page"), nxt - 1)))


def clip_to_children(sections: DataFrame) -> DataFrame:
    """A parent ends before its first child begins, but not before its own start."""
    first = sections.where("parent_id is not null").groupBy("source_id", F.col("parent_id").alias("section_id")).agg(F.min("pdf_page_start").alias("first_child"))
    s = sections.join(first, ["source_id", "section_id"], "left")
    clipped = F.least("pdf_page_end", F.greatest(F.col("first_child") - 1, F.col("pdf_page_start")))
    return s.withColumn("text_page_end", F.when(F.col("first_child").isNull(), F.col("pdf_page_end")).otherwise(clipped)).drop("first_child")


def overlapping_siblings(sections: DataFrame) -> DataFrame:
    """Sections that begin on the page on which the sibling before or behind them in the outline begins."""
    w = Window.partitionBy("source_id", "parent_id").orderBy("ord", "section_row")
    start = F.col("pdf_page_start")
    s = sections.withColumn("before", F.lag(start).over(w)).withColumn("behind", F.lead(start).over(w))
    return s.where((start == F.col("before")) | (start == F.col("behind"))).drop("before", "behind")


def page_filter(sections: DataFrame, lo: int, hi: int) -> DataFrame:
    return sections.where((F.col("pdf_page_end") >= lo) & (F.col("pdf_page_start") <= hi))


def pattern_filter(sections: DataFrame, patterns: list[str]) -> DataFrame:
    """Exact id, slug, last part of the id, or part of the title in any case; any of the patterns."""
    cond = F.lit(False)
    for p in patterns:
        cond |= (F.col("section_id") == p) | (F.col("slug") == p) | F.col("section_id").endswith("/" + p) | F.contains(F.lower("title"), F.lit(p.lower()))
    return sections.where(cond)


def note_paths(tree: DataFrame, root: str = "books") -> DataFrame:
    """(source_id, section_id, path): a folder with an index where a section has children, else a file."""
    inner = tree.where("parent_id is not null").select(F.col("parent_id").alias("section_id")).distinct().withColumn("inner", F.lit(True))
    t = tree.select("source_id", "section_id").distinct().join(inner, "section_id", "left")
    return t.select("source_id", "section_id", F.concat(F.lit(root + "/"), "section_id", F.when(F.col("inner"), "/index.md").otherwise(".md")).alias("path"))


def resolve_pages(refs: DataFrame, sections: DataFrame) -> DataFrame:
    """(source_id, page, section_id, tier): the section that holds a page, a leaf before others, then outline order.

    The printed pages of a section come first (those of the file where it has none), then those of the file, then the
    same of other books, by their id. An interval join as an equi join: each section is laid out over its pages, whose
    number a book's length bounds.
    """
    parents = sections.where("parent_id is not null").select("source_id", F.col("parent_id").alias("section_id")).distinct().withColumn("inner", F.lit(1))
    s = sections.join(parents, ["source_id", "section_id"], "left")
    printed = F.col("printed_page_start").isNotNull()
    first = F.when(printed, page_number(F.col("printed_page_start"))).otherwise(F.col("pdf_page_start"))
    last = F.when(printed, page_number(F.coalesce("printed_page_end", "printed_page_start"))).otherwise(F.col("pdf_page_end"))
    best = None
    for tier, a, z in (("printed", first, last), ("file", F.col("pdf_page_start"), F.col("pdf_page_end"))):
        laid = s.withColumn("a", a).withColumn("z", z).where("a <= z")
        pages = laid.select("source_id", F.explode(F.sequence("a", "z")).alias("page"), F.struct(F.coalesce("inner", F.lit(0)).alias("inner"), "ord", "section_row", "section_id").alias("s"))
        part = pages.groupBy("source_id", "page").agg(F.min("s").alias("s"))  # combines before the shuffle
        part = part.select("source_id", "page", F.lit(0 if tier == "printed" else 1).alias("rank"), F.lit(tier).alias("tier"), F.col("s.section_id").alias("section_id"))
        best = part if best is None else best.unionByName(part)
    own = best.groupBy("source_id", "page").agg(F.min(F.struct("rank", "tier", "section_id")).alias("x"))
    # the first other book that has the page is the first book that has it, since the own one has not
    other = own.groupBy("page").agg(F.min(F.struct("source_id", "x.section_id")).alias("y"))
    j = refs.join(own, ["source_id", "page"], "left").join(other, "page", "left")
    return j.select("source_id", "page", F.coalesce("x.section_id", "y.section_id").alias("section_id"), F.coalesce("x.tier", F.when(F.col("y").isNotNull(), "other")).alias("tier"))


def unwrap_single_root(tree: DataFrame) -> DataFrame:
    """A book whose only root is the book itself loses that root: its children become roots, ids and levels follow.

    The root is the book if its slug and the source id are the same words. Other books pass unchanged. ``tree`` has
    source_id, section_id, parent_id, slug, level and is_root.
    """
    roots = tree.where("is_root").groupBy("source_id").agg(F.count(F.lit(1)).alias("n_roots"), F.min(F.struct("section_id", "slug")).alias("root"))
    same = F.replace("root.slug", F.lit("-"), F.lit(" ")) == F.replace(F.lower("source_id"), F.lit("-"), F.lit(" "))
    wraps = roots.where((F.col("n_roots") == 1) & same).select("source_id", F.col("root.section_id").alias("root_id"))
    t = tree.join(wraps, "source_id", "left").where(F.col("root_id").isNull() | (F.col("section_id") != F.col("root_id")))
    inside = F.col("root_id").isNotNull() & F.startswith(F.col("section_id"), F.concat("root_id", F.lit("/")))
    moved = lambda c: F.concat(F.col("source_id"), F.expr(f"substring({c}, length(root_id) + 1)"))
    top = inside & (F.col("parent_id") == F.col("root_id"))
    return t.withColumns({
        "section_id": F.when(inside, moved("section_id")).otherwise(F.col("section_id")),
        "parent_id": F.when(top, F.lit(None).cast("string")).when(inside & F.col("parent_id").isNotNull(), moved("parent_id")).otherwise(F.col("parent_id")),
        "level": F.when(inside, F.col("level") - 1).otherwise(F.col("level")),
        "is_root": F.coalesce(top, F.lit(False)) | F.col("is_root"),
    }).drop("root_id")


def page_labels(ranges: DataFrame, books: DataFrame) -> DataFrame:
    """(source_id, page, label) of label ranges (source_id, start, prefix, style, first) up to the next range or the end.

    ``books``: source_id, page_count. Of several ranges with one start the least prefix counts; pages before the first
    range have no label.
    """
    r = ranges.groupBy("source_id", "start").agg(F.min(F.struct("prefix", "style", "first")).alias("r")).select("source_id", "start", "r.*")
    r = r.withColumn("stop", F.lead("start").over(Window.partitionBy("source_id").orderBy("start"))).join(books.select("source_id", "page_count"), "source_id")
    r = r.withColumn("stop", F.least(F.coalesce("stop", "page_count"), "page_count")).where("start < stop")
    pages = r.select("*", F.explode(F.sequence("start", F.col("stop") - 1)).alias("page"))
    return pages.select("source_id", "page", page_label(F.col("prefix"), F.col("style"), F.col("first") + F.col("page") - F.col("start")).alias("label"))


def label_sections(sections: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds label_start and label_end: the labels of a section's first and last page, null where there is none."""
    of = lambda page, name: labels.select("source_id", F.col("page").alias(page), F.col("label").alias(name))
    return sections.join(of("pdf_page_start", "label_start"), ["source_id", "pdf_page_start"], "left").join(of("pdf_page_end", "label_end"), ["source_id", "pdf_page_end"], "left")


def cascade(tiers: list[DataFrame], books: DataFrame) -> DataFrame:
    """(source_id, page, label): each book's labels from the first of the tiers that has any; pages it lacks count from 1."""
    have, out = None, None
    for t in tiers:
        mine = t if have is None else t.join(have, "source_id", "left_anti")
        out = mine if out is None else out.unionByName(mine)
        now = t.select("source_id").distinct()
        have = now if have is None else have.union(now).distinct()
    pages = books.select("source_id", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page"))
    return pages.join(out, ["source_id", "page"], "left").select("source_id", "page", F.coalesce("label", (F.col("page") + 1).cast("string")).alias("label"))


def distinct_slug(slug: Column, title: Column) -> Column:
    """A slug made another one by the first word of the title, of three letters or more, that it does not hold, else ``rules``."""
    words = F.filter(F.split(F.lower(title), r"\s+"), lambda w: (F.length(w) > 2) & ~F.contains(slug, w))
    return F.concat(slug, F.lit("-"), F.coalesce(F.get(words, F.lit(0)), F.lit("rules")))
