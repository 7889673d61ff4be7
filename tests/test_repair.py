"""Repair steps, links, glossary fields, notes and labels on small texts."""

import pytest
from pyspark.sql import functions as F

from quire.functions import repair, text
from quire.operators import links, markdown, outline
from quire.sources import files


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t"))).first()[0]


@pytest.mark.parametrize("given, want", [
    ("vio lence", "violence"), ("assign ment", "assignment"), ("consequ ence", "consequence"), ("attack ing", "attacking"), ("quick ly", "quickly"), ("danger ous", "dangerous"), ("Fort Worth", "Fort Worth"),
    ("much less", "much less"), ("import ant el ements", "important elements"), ("how ever", "however"), ("", ""), (None, None), ("Make Ing", "Make Ing"), ("été ing", "étéing"),
])
def test_broken_words(spark, given, want):
    assert (None if given is None else repair.join_broken_words(given)) == want
    assert one(spark, given, repair.broken_words) == want


@pytest.mark.parametrize("given, known, want", [
    ("- Y **C:**", {"Y": "•"}, "- • **C:**"), ("- Y **C:**", None, "- • **C:**"), ("- Y **C:**", {}, "- Y **C:**"), ("(Y to YYY)", None, "(• to •••)"), ("a (YY) and You (Yes)", None, "a (••) and You (Yes)"), ("- Yes", None, "- Yes"), (None, None, None),
])
def test_symbols(spark, given, known, want):
    assert one(spark, given, lambda c: repair.symbols(c, known)) == want


@pytest.mark.parametrize("given, want", [
    (r"see [\(p.21\)](#page-21-0) now", "see p.21 now"), ('<span id="page-4-0"></span>Text<span></span>', "Text"), ("| A<br>B |\na<br>b", "| A / B |\na<br>b"), ("[x](y.md)", "[x](y.md)"), (None, None),
])
def test_anchors(spark, given, want):
    assert one(spark, given, repair.clean_anchors) == want


def test_repair_chain(spark):
    got = one(spark, ">> COMBAT <<\n•• Allow vio lence  \n\n\n\n[\\(p.21\\)](#page-21-0)", repair.repair)
    assert got == "- • Allow violence\n\n{{page-ref:21}}\n"


def test_running_lines(spark):
    df = spark.createDataFrame([("Action-Adventure [combat]   43\ntext 43\nAction-Adventure [combat]", ["Action-Adventure [combat]"])], "t string, h array<string>")
    assert df.select(repair.strip_running_lines(F.col("t"), F.col("h"))).first()[0] == "text 43"


def test_links(spark):
    assert [(a, t) for a, _, t in links.references("The dice pool and dice.\n# dice\n**dice** [dice](dice.md) xp", ["dice", "dice pool", "xp"])] == [(4, "dice pool"), (18, "dice")]
    terms = spark.createDataFrame([("b", "Dice Pool"), ("b", "dice"), ("b", "Лук"), ("o", "other")], "source_id string, term string")
    texts = spark.createDataFrame([("b", 1, "books/b/c/d.md", "A dice pool of dice, лук."), ("b", 2, "books/b/d.md", "nothing"), ("b", 3, "books/b/d.md", None), ("b", 4, "books/b/d.md", "dice " * 30)], "source_id string, key int, path string, text string")
    got = {r.key: r.text for r in links.link_terms(texts, terms).collect()}
    assert got[1] == "A [dice pool](../entities/dice-pool.md) of [dice](../entities/dice.md), [лук](../entities/unknown.md)."
    assert got[2] == "nothing" and got[3] is None and got[4].count("](entities/dice.md)") == 20


def test_see_also(spark):
    rows = [(k, "b", t, d) for k, (t, d) in enumerate([("Dice Pool", "An action with dice, the dice pool, a щит and xp"), ("dice", None), ("action", ""), ("щит", None), ("xp", None), ("dice pool roll", "x")])]
    g = spark.createDataFrame(rows, "glossary_id int, source_id string, term string, definition string")
    got = [(r.term, r.pos) for r in links.see_also(g, g.where("definition is not null")).orderBy("pos").collect()]
    assert got == [("action", 0), ("dice", 1), ("щит", 2)]


def test_fields_and_glossary(spark):
    df = spark.createDataFrame([(1, "b", "s", "**Effect:** strong **Cost:** 2\n**CustomLabel:** no")], "doc int, source_id string, section_id string, text string")
    assert [(r.label, r.value) for r in markdown.field_values(df, "doc", "text").orderBy("n").collect()] == [("Effect", "strong"), ("Cost", "2")]
    lex = "# Lexicon\n**Action —** What a hero does in a turn.\n**Omen —** A sign of things to come."
    d = spark.createDataFrame([(1, "b", "s", "**action**: another meaning of it here."), (2, "b", "lexicon", lex), (3, "b", "s", "**Tower** — A high and lonely place.\n**Effect** — not a term at all")], "doc int, source_id string, section_id string, text string")
    assert {(r.term, r.source_type) for r in markdown.extract_glossary(d).collect()} == {("Action", "lexicon"), ("Omen", "lexicon"), ("Tower", "inline")}


def test_notes(spark):
    cols = "path string, pdf_path string, sha256 string, source_id string, section_id string, level int, pdf_page_start int, pdf_page_end int, parent_id string, printed_page_start string, printed_page_end string, title string, text string"
    rows = [("a.md", "/x/B.pdf", "0123456789abcdefgh", "b", "b/a", 1, 0, 3, None, "117", None, "Damage", "# *Damage*\n\n## damage\ntext\n# Damage Types\n\nmore"), ("n.md", None, None, "b", "b/n", None, None, None, "b/a", None, None, None, None)]
    got = {r.path: r.content for r in files.render_notes(spark.createDataFrame(rows, cols)).collect()}
    assert got["a.md"] == '---\nsource_pdf: B.pdf (sha256:0123456789abcdef)\nsource_pdf_id: b\nsection_id: b/a\nlevel: 1\npdf_page_start: 0\npdf_page_end: 3\nparent_section_id: null\naliases: []\ntags:\n- rulebook\n- imported\nprinted_page_start: "117"\n---\n\n# Damage\n\ntext\nmore\n'
    assert "not yet populated" in got["n.md"] and "printed" not in got["n.md"]


def test_numerals(spark):
    df = spark.createDataFrame([(n,) for n in (1, 4, 9, 14, 26, 27, 702, 703, 1999, 4000, 18279, 0)], "n int")
    got = {r.n: (r.r, r.a) for r in df.select("n", text.roman(F.col("n")).alias("r"), text.alpha(F.col("n")).alias("a")).collect()}
    assert [got[n][0] for n in (1, 4, 9, 14, 1999, 4000, 0)] == ["I", "IV", "IX", "XIV", "MCMXCIX", "MMMM", None]
    assert [got[n][1] for n in (1, 26, 27, 702, 703, 18279, 0)] == ["a", "z", "aa", "zz", "aaa", "aaaa", None]
    v = spark.createDataFrame([("xiv",), ("MCMXCIX",), ("12",), ("xxv",), (None,)], "l string")
    assert [tuple(r) for r in v.select(text.roman_value(F.col("l")), text.is_roman(F.col("l"))).collect()] == [(14, True), (1999, True), (None, False), (25, False), (None, None)]


def test_outlines_deeper_than_six(spark):
    rows = [("b", k, k + 1, f"x{k}", k, 30) for k in range(8)] + [("b", 8, 7, "y", 9, 30)]
    toc = spark.createDataFrame(rows, "source_id string, ord int, level int, slug string, pdf_page int, page_count int")
    tree = {r.ord: r.section_id for r in outline.section_tree(toc).collect()}
    assert tree[7] == "b/" + "/".join(f"x{k}" for k in range(8)) and tree[8] == "b/" + "/".join(f"x{k}" for k in range(6)) + "/y"
    assert {r.ord: r.page_end for r in outline.page_ranges(toc).collect()}[6] == 8
    with pytest.raises(ValueError):
        outline.section_tree(toc.withColumn("level", F.lit(100)))
