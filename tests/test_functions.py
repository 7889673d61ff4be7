import posixpath

import pytest
from pyspark.sql import functions as F

from quire.functions import paths, text
from quire.operators import markdown, outline, tables


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize("f, given, want", [
    (text.slug, "Chapter 1: Introduction", "chapter-1-introduction"), (text.slug, "", "untitled"), (text.slug, "Ünïcödé", "u-ni-co-de"), (text.slug, "(x) [y]", "x-y"),
    (text.entity_slug, "Breaking Point (Morality)", "breaking-point-morality"), (text.entity_slug, "10 Again", "10-again"), (text.entity_slug, "Extended  Action", "extended-action"), (text.entity_slug, "---", "unknown"),
    (text.source_slug, "PF2e - Core Rulebook (3rd Printing)", "pf2e-core-rulebook-3rd-printing"), (text.source_slug, "A---B___C", "a-b-c"),
    (text.collapse, "Destroyed Reputation\n(Social)", "Destroyed Reputation (Social)"), (text.collapse, "Hello   World", "Hello World"),
    (text.bullets, "•• Allow…\n••• Gain…", "- • Allow…\n- •• Gain…"), (text.tidy, "Line 1   \nLine 2  ", "Line 1\nLine 2\n"), (text.tidy, "\n\na\n\n\n\nb\n", "a\n\nb\n"),
    (text.annotate_pages, "See pp. 43-45", "See {{page-ref:43-45}}"), (text.annotate_pages, "see page 12", "{{page-ref:12}}"), (text.annotate_pages, "**Parkourp. 48**", "**Parkour {{page-ref:48}}**"), (text.annotate_pages, "map. 12 goblins", "map. 12 goblins"),
    (text.breaks_in_tables, "| A<BR>B | C<br/>D |\na<br>b", "| A / B | C / D |\na<br>b"), (text.drop_running_headers, ">> COMBAT <<\n> quote", "\n> quote"),
    (text.strip_affixes, "chapter 3 spells", "spells"), (text.strip_affixes, "introduction cont", "introduction"), (text.strip_affixes, "1. opening", "opening"), (text.strip_affixes, "", ""),
    (text.page_number, "43-45", 43), (text.page_number, "iv", None), (text.title_key, "**Damage** Types:", "damage types"),
])
def test_text(spark, f, given, want):
    assert one(spark, f, given) == want


@pytest.mark.parametrize("f", [text.slug, text.collapse, text.bullets, text.tidy, text.annotate_pages, text.page_number, text.title_key, paths.normalize])
def test_null_stays_null(spark, f):
    assert one(spark, f, None) is None


def test_labels(spark):
    df = spark.range(1, 4000).select(F.col("id").cast("int").alias("n"))
    got = dict(df.select("n", text.roman(F.col("n"))).collect())
    assert [got[i] for i in (1, 4, 9, 14, 1999)] == ["I", "IV", "IX", "XIV", "MCMXCIX"]
    abc = dict(df.select("n", text.alpha(F.col("n"))).collect())
    assert [abc[i] for i in (1, 26, 27, 702, 703)] == ["a", "z", "aa", "zz", "aaa"]
    assert df.where("n = 4").select(text.page_label(F.lit("App-"), F.lit("/D"), F.col("n"))).first()[0] == "App-4"


@pytest.mark.parametrize("file, target", [("a/b/c.md", "../x/./y.md"), ("a/b/c.md", "d.md"), ("a/b/c.md", "../../../../z.md"), ("c.md", "./../d//e.md"), ("a/b/c.md", "/q/r.md")])
def test_resolve(spark, file, target):
    want = posixpath.normpath(posixpath.join("/" + posixpath.dirname(file), target)).lstrip("/")
    assert one(spark, paths.resolve, file, target) == want


@pytest.mark.parametrize("a, b", [("books/t/combat/damage.md", "books/t/combat/defense.md"), ("a/b/c.md", "a/d.md"), ("a.md", "b/c.md"), ("a/b/c.md", "x/y/z.md"), ("a/a/c.md", "a/b/a/c.md")])
def test_relative(spark, a, b):
    assert one(spark, paths.relative, a, b) == posixpath.relpath(b, posixpath.dirname(a) or ".")


def test_tree_with_level_jumps(spark):
    rows = [("s", i, lv, t) for i, (lv, t) in enumerate([(2, "x"), (1, "a"), (3, "b"), (3, "c"), (2, "d"), (3, "e"), (1, "f")])]
    got = [tuple(r) for r in outline.section_tree(spark.createDataFrame(rows, "source_id string, ord int, level int, slug string")).orderBy("ord").select("depth", "parent_id", "section_id").collect()]
    assert got == [(1, None, "s/x"), (1, None, "s/a"), (2, None, "s/b"), (3, "s/b", "s/b/c"), (2, "s/a", "s/a/d"), (3, "s/a/d", "s/a/d/e"), (1, None, "s/f")]


def test_page_ranges(spark):
    rows = [("s", 0, 1, 0, 10), ("s", 1, 1, 4, 10), ("s", 2, 1, 8, 10)]
    got = outline.page_ranges(spark.createDataFrame(rows, "source_id string, ord int, level int, pdf_page int, page_count int")).orderBy("ord").collect()
    assert [(r.pdf_page, r.page_end) for r in got] == [(0, 3), (4, 7), (8, 9)]


def parse(spark, s):
    r = tables.parse_tables(spark.createDataFrame([(1, s)], "k int, t string"), "k", "t").collect()
    return (r[0].headers, r[0].body) if r else None


def test_tables(spark):
    assert parse(spark, "| Name | Cost |\n|---|:-:|\n| Sword | 10gp |\n| Shield |\n") == (["Name", "Cost"], [["Sword", "10gp"], ["Shield", ""]])
    assert parse(spark, "Name | | Name\n--- | --- | ---\na | b | c | d\n\nx\n| q |") == (["Name", "col_2", "Name_1"], [["a", "b", "c"]])
    assert parse(spark, "no table\nat all\nhere") is None and parse(spark, "") is None and parse(spark, None) is None
    t = tables.parse_tables(spark.createDataFrame([(1, "| A | B |\n|---|---|\n| x,y | 2 |")], "k int, t string"), "k", "t")
    assert tables.to_csv(t, "k").first().csv == 'A,B\r\n"x,y",2\r\n'
    assert parse(spark, tables.render(t, "k").first().markdown) == (["A", "B"], [["x,y", "2"]])


def test_definitions(spark):
    s = "**Action —** The thing that one does now. **Inner —** Another one inside.\n**Beat**: A short moment of play.\n**Cost** — A field and no term at all.\n**X**: too short"
    d = markdown.definitions(spark.createDataFrame([(1, s)], "k int, t string"), "k", "t")
    got = {(r.pattern, r.term) for r in d.where(markdown.is_term(F.col("term"), F.col("definition"))).collect()}
    assert got == {("a", "Action"), ("a", "Inner")} | ({("c", "Beat")} if "Beat" not in markdown.FIELD_LABELS else set())


def test_unwrap(spark):
    rows = [("my-book", 0, 1, "my-book"), ("my-book", 1, 2, "a"), ("my-book", 2, 3, "b"), ("two", 0, 1, "two"), ("two", 1, 1, "x"), ("two", 2, 2, "y")]
    tree = outline.section_tree(spark.createDataFrame(rows, "source_id string, ord int, level int, slug string"))
    got = {tuple(r) for r in outline.unwrap_single_root(tree).select("section_id", "parent_id", "level", "is_root").collect()}
    assert got == {("my-book/a", None, 1, True), ("my-book/a/b", "my-book/a", 2, False), ("two/two", None, 1, True), ("two/x", None, 1, True), ("two/x/y", "two/x", 2, False)}


@pytest.mark.parametrize("body, title, want", [
    ("# Damage\n\ntext", "Damage", "text"), ("## **Damage Types**\ntext", "Damage", "text"), ("# Other\ntext", "Damage", "# Other\ntext"), ("# Damage\n", "Damage", "# Damage\n"), ("text", "Damage", "text"),
])
def test_title_heading(spark, body, title, want):
    assert one(spark, markdown.drop_title_heading, body, title) == want


@pytest.mark.parametrize("given, want", [("conse-\nquence", "consequence"), ("a\u00adb", "ab"), ("x\n42\ny", "x y"), ("line\nof a", "line of a"), ("End.\nnext", "End.\nnext"), (None, None)])
def test_page_text(spark, given, want):
    assert one(spark, markdown.clean_page_text, given) == want
