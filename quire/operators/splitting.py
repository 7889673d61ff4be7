"""A book's whole Markdown cut into the texts of its sections, by matching section titles to headings.

A book's text is its documents in order; a line's place is (doc, line). Frames of headings and sections are long form
per book, and every step is a join or window over them; no book's text passes through one task.

Titles match exactly; else by containment, found by an equi join on the rarest four letters of the shorter title; else
by shared words, found by an equi join on pairs of each title's rarest words (as many as the similarity demands). Only
the last step, in which sections claim headings one after the other, reads a book in order, as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import rsub, strip_affixes, title_key
from quire.session import cut

#: Least similarity of the words of two titles, and least score with the bonus for near pages.
LIKE, ENOUGH = 0.3, 0.5
#: Titles of at most so many words are compared if they share two (or the only) words that they must share; longer ones, if one.
SHORT = 6
#: Least score of a contained title, of 80 for equal lengths.
CONTAINED = 30.0
ANCHOR = r'^<span\s+id="page-([0-9]+)-[0-9]+"\s*>\s*</span>'


def lines(docs: DataFrame) -> DataFrame:
    """(source_id, doc, line, text) of documents (source_id, doc, text); lines counted from 0."""
    return docs.where("text is not null and source_id is not null").select("source_id", "doc", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def headings(book_lines: DataFrame) -> DataFrame:
    """(source_id, h, doc, line, level, title, key, page): numbered in order; like neighbours are one heading.

    A heading whose normalised title and level are those of the heading before it belongs to it. ``page`` is that of
    the last page anchor at or before it: 0 before the first, null in a book without anchors.
    """
    page = F.when(F.col("text").rlike(ANCHOR), F.regexp_extract("text", ANCHOR, 1).cast("int"))
    marked = book_lines.withColumn("page", page).where(F.col("text").rlike(r"^#{1,6}\s+.") | F.col("page").isNotNull())
    book = Window.partitionBy("source_id").orderBy("doc", "line")
    upto = book.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = marked.withColumn("at", F.last("page", ignorenulls=True).over(upto)).withColumn("anchors", F.count("page").over(Window.partitionBy("source_id")))
    h = m.where("page is null").select("source_id", "doc", "line", F.length(F.regexp_extract("text", "^(#+)", 1)).alias("level"), rsub(F.regexp_extract("text", r"^#{1,6}\s+(.+)$", 1), r"^\s+|\s+\z", "").alias("title"), F.when(F.col("anchors") > 0, F.coalesce("at", F.lit(0))).alias("page"))
    h = h.withColumn("key", title_key(F.col("title")))
    new = ~(F.lag("key").over(book).eqNullSafe(F.col("key")) & F.lag("level").over(book).eqNullSafe(F.col("level")))
    h = h.withColumn("new", new).where("new").drop("new")
    return h.withColumn("h", F.row_number().over(book))


def _grams(c: Column, n: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n))))


def contained_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """(source_id, a, b): titles ``a`` and ``b`` of one book of which one holds the other. Both: (source_id, key)."""
    a, b = left.select("source_id", F.col("key").alias("a")).where("a != ''").distinct(), right.select("source_id", F.col("key").alias("b")).where("b != ''").distinct()

    none = F.array().cast("array<string>")

    def inside(short: DataFrame, s: str, long: DataFrame, t: str) -> DataFrame:
        of = lambda c, n, most: F.when((F.length(c) >= n) & (F.length(c) <= most), _grams(F.col(c), n)).otherwise(none)
        # a title that can hold one of n < 4 letters with a score of CONTAINED is at most so long
        g = long.select("source_id", t, F.explode(F.concat(*(of(t, n, 1 << 30 if n == 4 else int(n * 80 / CONTAINED)) for n in (1, 2, 3, 4)))).alias("g"))
        freq = g.groupBy("source_id", "g").agg(F.count(F.lit(1)).alias("n"))
        # all letters of the shorter stand in the longer: first the outer ones are looked up, then all of what is left
        for end in (F.left(F.col(s), F.lit(4)), F.right(F.col(s), F.lit(4))):
            short = short.withColumn("g", end).join(freq, ["source_id", "g"]).select("source_id", s)
        mine = short.select("source_id", s, F.explode(F.concat(*(of(s, n, 1 << 30 if n == 4 else n) for n in (1, 2, 3, 4)))).alias("g"))
        mine = mine.join(freq, ["source_id", "g"], "left")
        rare = mine.groupBy("source_id", s).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("x")).where("x.n > 0").select("source_id", s, F.col("x.g").alias("g"))
        return rare.join(g, ["source_id", "g"]).where(F.contains(t, s)).select("source_id", "a", "b")

    return inside(a, "a", b, "b").unionByName(inside(b, "b", a, "a")).distinct()


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    x, y = _words(a), _words(b)
    both = F.size(F.array_union(x, y))
    return F.when(both > 0, F.size(F.array_intersect(x, y)) / both).otherwise(0.0)


def _signs(n: int, least: float) -> list[tuple[int, int, int]]:
    """(m, i, j) for a title of ``n`` <= SHORT words: to be similar to one of ``m``, it shares words i and j first of all for some of these.

    Words are in the book's order of rarity. Two titles that must share ``o`` words have the first k shared ones among
    the first n - o + k of each; k is 2 here, or 1 (j = -1) where a single word is enough.
    """
    out = []
    for m in range(1, SHORT + 1):
        o = next((o for o in range(1, min(n, m) + 1) if o / (n + m - o) >= least), None)
        if o == 1:
            out += [(m, i, -1) for i in range(n)]
        elif o:
            out += [(m, i, j) for j in range(n - o + 2) for i in range(j)]
    return out


def _title_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """(source_id, key, in_a, in_b, full, bare): each title of either side with its words as numbers, with and without affixes.

    A book's words are numbered from the rarest on, so that equal numbers are equal words and sorted ones the rarest first.
    Words of a single title or side come before all others, with numbers below 0. ``bare`` is null if it is ``full``.
    """
    side = lambda x, a, b: x.select("source_id", "key", F.lit(a).alias("in_a"), F.lit(b).alias("in_b"))
    t = side(left, True, False).unionByName(side(right, False, True)).groupBy("source_id", "key").agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))
    t = t.withColumn("full", _words(F.col("key"))).withColumn("bare", _words(strip_affixes(F.col("key"))))
    w = t.select("source_id", "key", "in_a", "in_b", F.explode(F.array_union("full", "bare")).alias("w"), F.array_contains("full", F.col("w")).alias("f"), F.array_contains("bare", F.col("w")).alias("b"))
    ids = w.groupBy("source_id", "w").agg(F.count(F.lit(1)).alias("n"), (F.bool_or("in_a") & F.bool_or("in_b")).alias("shared")).withColumn("id", F.row_number().over(Window.partitionBy("source_id").orderBy("n", "w")))
    ids = ids.select("source_id", "w", F.when((F.col("n") > 1) & F.col("shared"), F.col("id")).otherwise(-F.col("id")).alias("id"))
    of = lambda c: F.sort_array(F.collect_list(F.when(F.col(c), F.col("id"))))
    return w.join(ids, ["source_id", "w"]).groupBy("source_id", "key", "in_a", "in_b").agg(of("f").alias("full"), of("b").alias("bare")).withColumn("bare", F.when(F.col("bare") != F.col("full"), F.col("bare")))


def similar_titles(left: DataFrame, right: DataFrame, least: float = LIKE, near: int | None = None, words: DataFrame | None = None) -> DataFrame:
    """(source_id, a, b, score): the larger Jaccard similarity of the words of two titles, with and without affixes.

    With ``near``, left and right have a ``page``, and titles come into question if theirs are at most so far apart;
    the result has them as ``page`` and ``at``. ``words``: ``_title_words`` of both, if there already.
    """
    t = cut(_title_words(left, right)) if words is None else words
    table = F.array(*(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.lit(j).alias("j")) for m, i, j in _signs(n, least))) for n in range(1, SHORT + 1)))

    def signed(titles: DataFrame, me: str) -> DataFrame:
        rows = None
        for form in ("full", "bare"):
            ws = F.col("full") if form == "full" else F.coalesce("bare", "full")
            n = F.size(ws)
            sign = lambda la, lb, u, v: F.struct(la.alias("la"), lb.alias("lb"), u.alias("u"), v.alias("v"))
            mine = lambda m: (n, m) if me == "a" else (m, n)  # noqa: E731, B023
            two = F.transform(F.get(table, n - 1), lambda s: sign(*mine(s["m"]), F.get(ws, s["i"]), F.coalesce(F.get(ws, s["j"]), F.lit(0))))  # noqa: B023
            # beyond: of n words, a similar title shares one of the n - ceil(least * n) + 1 rarest; la is 0 if a is long, -1 if b alone is
            one = lambda tag: F.transform(F.slice(ws, 1, n - F.ceil(n * least - 1e-9).cast("int") + 1), lambda u: sign(F.lit(tag), F.lit(0), u, F.lit(0)))  # noqa: E731, B023
            if me == "a":
                signs = F.when(n <= SHORT, F.concat(two, one(-1))).otherwise(one(0))
            else:
                signs = F.when(n <= SHORT, F.concat(two, one(0))).otherwise(F.concat(one(0), one(-1)))
            # a word of one title or side is no link
            x = titles.where(n > 0).select(*titles.columns, F.lit(form == "full").alias("whole"), F.explode(F.filter(signs, lambda s: (s["u"] > 0) & (s["v"] >= 0))).alias("s"))
            rows = x if rows is None else rows.unionByName(x)
        own = ["key", "full", "bare", *["page"] * (near is not None)]
        return rows.select("source_id", "whole", "s.*", *(["on"] if near is not None else []), *(F.col(c).alias(f"{me}_{c}") for c in own))

    a, b, on = t.where("in_a"), t.where("in_b"), ["source_id", "whole", "la", "lb", "u", "v"]
    if near is not None:
        pages = lambda x: x.where("page is not null").select("source_id", "key", "page").distinct()
        a = a.join(pages(left), ["source_id", "key"]).withColumn("on", F.explode(F.sequence(F.col("page") - near, F.col("page") + near)))
        b, on = b.join(pages(right), ["source_id", "key"]).withColumn("on", F.col("page")), [*on, "on"]
    # titles without affixes are alike in both forms: one is enough
    alike = F.col("a_bare").isNull() & F.col("b_bare").isNull()
    c = signed(a, "a").join(signed(b, "b"), on).where((F.col("whole") | ~alike) & (F.col("a_key") != F.col("b_key")))
    words = {"full": (F.col("a_full"), F.col("b_full")), "bare": (F.coalesce("a_bare", "a_full"), F.coalesce("b_bare", "b_full"))}
    both = {f: F.array_intersect(*x) for f, x in words.items()}
    score = {f: F.coalesce(F.try_divide(F.size(both[f]), F.size(x) + F.size(y) - F.size(both[f])), F.lit(0.0)) for f, (x, y) in words.items()}
    # every pair comes once: by the first words that it shares, and without affixes only if it isn't similar with them
    first = lambda x: (F.get(x, F.lit(0)) == F.col("u")) & ((F.col("v") == 0) | (F.get(x, F.lit(1)) == F.col("v")))
    c = c.where(F.when(F.col("whole"), first(both["full"])).otherwise(first(both["bare"])))
    c = c.where(F.when(F.col("whole"), score["full"] >= least).otherwise((score["bare"] >= least) & (score["full"] < least)))
    more = [F.col("a_page").alias("page"), F.col("b_page").alias("at")] if near is not None else []
    other = c.select("source_id", F.col("a_key").alias("a"), F.col("b_key").alias("b"), F.when(alike, score["full"]).otherwise(F.greatest(*score.values())).alias("score"), *more)
    # a title on both sides is wholly like itself
    a, b = a.where((F.size("full") > 0) & F.col("in_b")), b.where("in_a")
    equal = a.where(F.lit(least <= 1)).select("source_id", F.col("key").alias("a"), F.col("key").alias("b"), F.lit(1.0).alias("score"))
    if near is not None:
        equal = a.withColumnRenamed("page", "p").join(b.select("source_id", "key", "page", "on"), ["source_id", "key", "on"]).select("source_id", F.col("key").alias("a"), F.col("key").alias("b"), F.lit(1.0).alias("score"), F.col("p").alias("page"), F.col("page").alias("at"))
    return other.unionByName(equal)


def direct_matches(sections: DataFrame, heads: DataFrame) -> DataFrame:
    """(source_id, section_id, h, tier, score): the first heading of the same title, else that of the best contained one.

    ``sections``: source_id, section_id, key. Several sections may have one heading.
    """
    first = heads.groupBy("source_id", "key").agg(F.min("h").alias("h"))
    exact = sections.join(first, ["source_id", "key"]).select("source_id", "section_id", "h", F.lit("exact").alias("tier"), F.lit(100.0).alias("score"))
    rest = sections.join(exact.select("source_id", "section_id"), ["source_id", "section_id"], "left_anti")
    pairs = contained_titles(rest, heads).withColumn("score", F.least(F.length("a"), F.length("b")) / F.greatest(F.length("a"), F.length("b")) * 80)
    pairs = pairs.where((F.length("b") >= 4) & (F.col("score") >= CONTAINED)).join(first.withColumnRenamed("key", "b"), ["source_id", "b"])
    best = pairs.groupBy("source_id", "a").agg(F.min(F.struct((-F.col("score")).alias("s"), "h")).alias("x"))
    part = rest.join(best.withColumnRenamed("a", "key"), ["source_id", "key"]).select("source_id", "section_id", F.col("x.h").alias("h"), F.lit("contained").alias("tier"), (-F.col("x.s")).alias("score"))
    return exact.unionByName(part)


def _claim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each section in turn takes the best heading that is left; rows come by book, section and falling score."""
    book, section, done, taken = None, None, False, set()
    for b in batches:
        keep = []
        for k, (s, x, h) in enumerate(zip(b.column("source_id").to_pylist(), b.column("section_id").to_pylist(), b.column("h").to_pylist(), strict=True)):
            if s != book:
                book, section, taken = s, None, set()
            if x != section:
                section, done = x, False
            if not done and h not in taken:
                taken.add(h)
                done = True
                keep.append(k)
        yield b.take(pa.array(keep, pa.int64())).select(["source_id", "section_id", "h", "score"])


def fuzzy_matches(sections: DataFrame, heads: DataFrame, direct: DataFrame) -> DataFrame:
    """As ``direct_matches`` for the sections without one, over the headings that none has; each heading goes once.

    ``sections`` have ``ord`` and ``page`` too. The similarity of the words gains .3, .2 or .1 on the section's first
    page, the next ones and those two away.
    """
    rest = sections.join(direct.select("source_id", "section_id"), ["source_id", "section_id"], "left_anti")
    free = heads.join(direct.select("source_id", "h").distinct(), ["source_id", "h"], "left_anti")
    words = cut(_title_words(rest, free))
    far = similar_titles(rest, free, ENOUGH, words=words)
    # below ENOUGH, only a near page lifts a pair
    close = similar_titles(rest, free, LIKE, near=2, words=words).where(F.col("score") < ENOUGH)
    mine, theirs = rest.withColumnRenamed("key", "a"), free.select("source_id", F.col("key").alias("b"), "h", F.col("page").alias("at"))
    away = F.abs(F.col("page") - F.col("at"))
    bonus = F.when(away == 0, 0.3).when(away <= 1, 0.2).when(away <= 2, 0.1).otherwise(0.0)
    cols = ["source_id", "section_id", "ord", "h", (F.col("score") + bonus).alias("score")]
    c = far.join(mine, ["source_id", "a"]).join(theirs, ["source_id", "b"]).select(*cols).unionByName(close.join(mine, ["source_id", "a", "page"]).join(theirs, ["source_id", "b", "at"]).select(*cols))
    c = c.where(F.col("score") >= ENOUGH)
    kind = dict(c.dtypes)
    inorder = c.select("source_id", "section_id", "ord", "h", "score").repartition("source_id").sortWithinPartitions("source_id", "ord", "section_id", F.desc("score"), "h")
    got = inorder.mapInArrow(_claim, f"source_id {kind['source_id']}, section_id {kind['section_id']}, h int, score double")
    return got.select("source_id", "section_id", "h", F.lit("fuzzy").alias("tier"), "score")


def absorbed(heads: DataFrame, matches: DataFrame, depth: int = 3) -> DataFrame:
    """(source_id, section_id, h, stop): the first heading behind ``h`` that the section does not take in; null at the end.

    It takes in headings that no section has, up to one more than ``depth`` levels below its own.
    """
    taken = matches.select("source_id", "h").distinct().withColumn("taken", F.lit(True))
    h = heads.select("source_id", "h", "level").join(taken, ["source_id", "h"], "left")
    back = Window.partitionBy("source_id").orderBy(F.col("h").desc()).rowsBetween(Window.unboundedPreceding, -1)
    stop = F.lit(None).cast("int")
    for k in range(1, 7):  # Markdown has six levels
        stop = F.when(F.col("level") == k, F.last(F.when(F.coalesce("taken", F.lit(False)) | (F.col("level") > k + depth), F.col("h")), ignorenulls=True).over(back)).otherwise(stop)
    h = h.withColumn("stop", stop).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("source_id")))
    return matches.join(h.select("source_id", "h", "stop", "n"), ["source_id", "h"]).select("source_id", "section_id", "h", "stop", "n")


def pieces(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(source_id, h, doc, text): the lines of each heading, document by document; what stands before the first is left out.

    ``docs``: source_id, doc (once a book), text. A text is cut where it lies: only the places of headings are sorted.
    """
    starts = heads.groupBy("source_id", "doc").agg(F.array_sort(F.collect_list(F.struct("line", "h"))).alias("s"), F.max("h").alias("last"))
    docs = docs.where("text is not null and source_id is not null")
    # lines before a document's first heading belong to the last heading of the documents before
    upto = Window.partitionBy("source_id").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    cuts = docs.select("source_id", "doc").join(starts, ["source_id", "doc"], "left").withColumn("before", F.max("last").over(upto)).where("before is not null or s is not null")
    cuts = cuts.select("source_id", "doc", F.concat(F.array(F.struct(F.lit(0).alias("line"), F.col("before").alias("h"))), F.coalesce("s", F.array().cast("array<struct<line:int,h:int>>"))).alias("s"))
    x = docs.select("source_id", "doc", F.split("text", "\n").alias("t")).join(cuts, ["source_id", "doc"])
    to = F.coalesce(F.get(F.col("s"), F.col("k") + 1)["line"], F.size("t"))
    x = x.select("source_id", "doc", "t", "s", F.posexplode("s").alias("k", "x")).select("source_id", "doc", "t", F.col("x.line").alias("line"), F.col("x.h").alias("h"), to.alias("to")).where("h is not null and to > line")
    return x.select("source_id", "h", "doc", F.array_join(F.slice("t", F.col("line") + 1, F.col("to") - F.col("line")), "\n").alias("text"))


def anchored(book_lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source_id, section_id, text): the lines from the first anchor of ``page`` or later to the first beyond ``page_end``.

    Anchors at line ends are taken out. A book without anchors, or a section behind the last, gives no row.
    """
    place = F.struct("doc", "line")
    a = book_lines.where(F.col("text").rlike(ANCHOR)).select("source_id", place.alias("at"), F.regexp_extract("text", ANCHOR, 1).cast("int").alias("p"))
    # by page, the first place of it or a later page: one row a page
    firsts = a.groupBy("source_id", "p").agg(F.min("at").alias("at"))
    later = firsts.withColumn("at", F.min("at").over(Window.partitionBy("source_id").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    j = wanted.where("page is not null and page_end is not null").join(later, "source_id")
    span = j.groupBy("source_id", "section_id", "page", "page_end").agg(F.min(F.when(F.col("p") >= F.col("page"), F.col("at"))).alias("lo"), F.min(F.when(F.col("p") > F.col("page_end"), F.col("at"))).alias("hi")).where("lo is not null")
    x = book_lines.join(span, "source_id").where((place >= F.col("lo")) & (F.col("hi").isNull() | (place < F.col("hi"))))
    t = x.groupBy("source_id", "section_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc", "line", "text"))), lambda y: y["text"]), "\n").alias("text"))
    return t.select("source_id", "section_id", rsub(rsub(F.col("text"), r"^\s+|\s+\z", ""), r'(?m)\s*<span\s+id="page-[0-9]+-[0-9]+"\s*>\s*</span>\s*$', "").alias("text"))


def split_by_headings(docs: DataFrame, sections: DataFrame, depth: int = 3) -> DataFrame:
    """(source_id, section_id, tier, h, text) of every section: by heading, else by page anchors, else null.

    ``docs``: source_id, doc, text. ``sections``: source_id, section_id (once a book), ord, title, page, page_end.
    Null titles match nothing.
    """
    book_lines = lines(docs)
    # a few rows a book beside its text, read by every step
    heads = cut(headings(book_lines))
    s = cut(sections.withColumn("key", F.coalesce(title_key(F.col("title")), F.lit(""))))
    direct = cut(direct_matches(s.where("title is not null"), heads))
    matches = cut(direct.unionByName(fuzzy_matches(s, heads, direct)))
    got = absorbed(heads, matches, depth).withColumn("of", F.explode(F.sequence(F.col("h"), F.coalesce(F.col("stop") - 1, F.col("n")))))
    part = pieces(docs, heads).withColumnRenamed("h", "of")
    text = got.join(part, ["source_id", "of"]).groupBy("source_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("of", "doc", "text"))).alias("t"))
    text = text.select("source_id", "section_id", rsub(F.array_join(F.transform("t", lambda x: x["text"]), "\n"), r"^\s+|\s+\z", "").alias("by_heading"))
    text = matches.select("source_id", "section_id", "tier", "h").join(text, ["source_id", "section_id"])
    out = s.join(text, ["source_id", "section_id"], "left")
    pages = anchored(book_lines, s.join(matches.select("source_id", "section_id"), ["source_id", "section_id"], "left_anti").select("source_id", "section_id", "page", "page_end")).withColumnRenamed("text", "by_page")
    out = out.join(pages, ["source_id", "section_id"], "left")
    return out.select("source_id", "section_id", F.coalesce("tier", F.when(F.col("by_page").isNotNull(), "page")).alias("tier"), "h", F.coalesce("by_heading", "by_page").alias("text"))
