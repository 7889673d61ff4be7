"""Headings, links and glossary entries inside Markdown texts, by regular expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import rsub, title_key

# Labels of structured fields, which are no glossary terms.
FIELD_LABELS = (
    "Effect", "Description", "Prerequisites", "Prerequisite", "Success", "Failure", "Exceptional Success", "Dramatic Failure", "Cost", "Drawback", "Resolution", "Background",
    "Storytelling Hints", "Mission", "Methods", "Levels", "Sample actions", "Sample Specialties", "Sample contacts", "Novice", "Professional", "Experienced", "Expert", "Master",
    "Causing the Tilt", "Ending the Tilt", "Causing the Condition", "Ending the Condition", "The Truth", "Damage", "Dice Pool", "Roll Results", "Larceny", "Streetwise", "Stealth",
    "Crafts", "Subterfuge", "Academics", "Empathy", "Athletics", "Attribute Tasks", "Beat",
)
# Words in bold that are no terms.
NO_TERMS = (
    "Example", "Note", "See Also", "See also", "See", "Table", "Figure", "Chapter", "Section", "Page", "Important", "Optional", "Required", "Recommended", "Special", "General", "Basic",
    "Advanced", "Personal", "Environmental", "Social", "Mental", "Physical", "Authors", "Developer", "Editor", "Artists", "Art Direction and Design", "Creative Director",
)
MIN_DEFINITION = 15


def headings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, level, title) of every heading line, lines counted from 0."""
    x = df.where(F.contains(text, F.lit("#"))).select(key, F.posexplode(F.split(text, "\n")).alias("line", "s")).where(F.col("s").rlike(r"^#{1,6}[ \t]+\S"))
    x = x.withColumn("s", rsub(F.col("s"), r"[ \t\r]+\z", ""))
    return x.select(key, "line", F.length(F.regexp_extract("s", r"^(#+)", 1)).alias("level"), F.regexp_extract("s", r"^#{1,6}[ \t]+(.+)$", 1).alias("title"))


def heading_ranges(heads: DataFrame, key: str) -> DataFrame:
    """Adds line_end: the last line before the next heading of the text, null for the last heading."""
    return heads.withColumn("line_end", F.lead("line").over(Window.partitionBy(key).orderBy("line")) - 1)


def links(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, label, target) of Markdown links to notes; images and other addresses are none."""
    pat = r"(?<!!)\[([^\[\]]*)\]\(([^()\s]+\.md)\)"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pat), F.lit(1)).alias("label"), F.regexp_extract_all(text, F.lit(pat), F.lit(2)).alias("target"))
    x = df.where(F.contains(text, F.lit("]("))).select(key, F.posexplode(both).alias("n", "x"))
    return x.select(key, "n", F.col("x.label").alias("label"), F.col("x.target").alias("target"))


def definitions(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pattern, n, term, definition): bold terms with a dash inside (a), a colon (c) or a dash behind (b).

    The definition is captured in a look-ahead, so an entry inside another's definition is found as well.
    """
    stop = r"(?=\n\s*\*\*|\n\s*\n\s*\n|\z)"
    shapes = {
        "a": rf"\*\*([^*]+?)\s*[—–]+\s*\*\*\s*(?=((?s:.*?)){stop})",
        "c": r"\*\*([^*]{2,60})\*\*:\s*(?=([^\n]*?)(?=\*\*|\n|\z))",
        "b": rf"\*\*([^*]{{2,80}})\*\*\s*[—–]+\s*(?=((?s:.*?)){stop})",
    }
    out = None
    src = df.where(F.contains(text, F.lit("**")))
    for name, p in shapes.items():
        both = F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(1)).alias("term"), F.regexp_extract_all(text, F.lit(p), F.lit(2)).alias("definition"))
        x = src.select(key, F.posexplode(both).alias("n", "x"))
        x = x.select(key, F.lit(name).alias("pattern"), "n", F.trim(F.col("x.term")).alias("term"), rsub(F.col("x.definition"), r"^\s+|\s+\z", "").alias("definition"))
        out = x if out is None else out.unionByName(x)
    return out.where("definition != ''")


def is_term(term: Column, definition: Column) -> Column:
    """Whether a bold term with a definition is a glossary entry."""
    bare = F.trim(rsub(term, r":+$", ""))
    return (
        (F.length(term) >= 2) & ~term.rlike(r"^[0-9\s.,;:!?—–/()-]+$") & ~term.rlike(r"\((see )?p\.\s*[0-9]+\)|#page-[0-9]+|^\[\(|^\(p\.|^\(see")
        & ~bare.isin(*NO_TERMS) & ~bare.isin(*FIELD_LABELS) & (F.length(F.trim(definition)) >= MIN_DEFINITION)
    )


def first_entries(glossary: DataFrame) -> DataFrame:
    """One row per book and term: the last lexicon entry, else the first of the others."""
    rank = F.struct(F.when(F.col("source_type") == "lexicon", 1).otherwise(0).alias("lex"), F.when(F.col("source_type") == "lexicon", F.col("glossary_id")).otherwise(-F.col("glossary_id")).alias("o"))
    g = glossary.groupBy("source_id", F.lower("term").alias("key")).agg(F.max_by("glossary_id", rank).alias("glossary_id"), F.count(F.lit(1)).alias("n"))
    return g


def match_headings(heads: DataFrame, sections: DataFrame) -> DataFrame:
    """(source_id, section_id, doc_id, line): the first heading of the book whose normalised title is the section's.

    ``heads``: source_id, doc_id, line, title. Several sections may claim one heading; a section without a match is
    left out, and so is one whose title has no letters.
    """
    h = heads.withColumn("key", title_key(F.col("title"))).where("key != ''")
    h = h.groupBy("source_id", "key").agg(F.min(F.struct("doc_id", "line")).alias("h"))  # the first, before the join
    s = sections.select("source_id", "section_id", title_key(F.col("title")).alias("key")).distinct()
    return s.join(h, ["source_id", "key"]).groupBy("source_id", "section_id").agg(F.min("h").alias("h")).select("source_id", "section_id", F.col("h.doc_id").alias("doc_id"), F.col("h.line").alias("line"))


def drop_title_heading(text: Column, title: Column) -> Column:
    """Headings that repeat the section's title are dropped with the empty lines behind them; the text is stripped.

    One repeats it if, without Markdown signs and case, it begins with the title or the title with it, or, from four
    characters on, one holds the other. A text of nothing else stays as it is.
    """
    clean = lambda c, signs: rsub(F.lower(rsub(c, signs, "")), r"^\s+|\s+\z", "")
    key = clean(title, r"[*_`\[\]()#]")

    def again(line: Column) -> Column:
        head = clean(F.regexp_extract(line, r"^#{1,6}\s+(.+)$", 1), r"[*_`\[\]()]")
        part = (F.length(key) >= 4) & (F.length(head) >= 4) & (F.contains(head, key) | F.contains(key, head))
        return line.rlike(r"^#{1,6}\s+.") & (F.startswith(head, key) | F.startswith(key, head) | part)

    marked = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.when(again(x), F.lit("\x01")).otherwise(x)), "\n")
    rest = rsub(rsub(marked, r"(?m)^\x01$\n?(?:[^\S\n]*\n)*", ""), r"^\s+|\s+\z", "")
    return F.when(key.isNull() | (rest == ""), text).otherwise(rest)


def field_values(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, label, value) of ``**Label:** value`` with a known label, up to the line's end or the next bold."""
    p = r"\*\*([^*]{2,40}):\*\*\s*(?=([^\n]*?)(?=\*\*|\n|\z))"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(1)).alias("label"), F.regexp_extract_all(text, F.lit(p), F.lit(2)).alias("value"))
    x = df.where(F.contains(text, F.lit(":**"))).select(key, F.posexplode(both).alias("n", "x"))
    return x.select(key, "n", F.trim("x.label").alias("label"), rsub(F.col("x.value"), r"^\s+|\s+\z", "").alias("value")).where(F.col("label").isin(*FIELD_LABELS) & (F.col("value") != ""))


def is_lexicon(section_id: Column, text: Column) -> Column:
    """Whether a section is a glossary: by its id, its first heading, or five entries with a dash in bold."""
    sid = F.coalesce(F.lower(section_id), F.lit(""))
    return F.contains(sid, F.lit("lexicon")) | F.contains(sid, F.lit("glossary")) | F.lower(F.left(text, F.lit(200))).rlike(r"^#+\s*(lexicon|glossary)\b") | (F.regexp_count(text, F.lit(r"\*\*[^*]+\s*[—–]+\s*\*\*")) >= 5)


def extract_glossary(df: DataFrame) -> DataFrame:
    """(source_id, term, definition, section_id, source_type): one entry a book and term, in any case.

    ``df``: source_id, doc, section_id, text. The last entry with a dash in bold of a glossary section; else the first
    of the others, by document, then dash in bold, colon, dash behind, then place.
    """
    d = df.where("text is not null").withColumn("lexicon", is_lexicon(F.col("section_id"), F.col("text")))
    x = definitions(d, "doc", "text").join(d.select("doc", "source_id", "section_id", "lexicon"), "doc")
    bare = F.trim(rsub(F.col("term"), r":+$", ""))
    x = x.where(is_term(F.col("term"), F.col("definition"))).where((F.col("pattern") == "a") | ~bare.isin(*FIELD_LABELS))
    strong = F.col("lexicon") & (F.col("pattern") == "a")
    step = F.when(F.col("pattern") == "a", 0).when(F.col("pattern") == "c", 1).otherwise(2)
    place = F.struct(F.when(strong, F.col("doc")).otherwise(-F.col("doc")).alias("d"), (-step).alias("p"), F.when(strong, F.col("n")).otherwise(-F.col("n")).alias("n"))
    entry = F.struct("term", "definition", "section_id", F.when(strong, "lexicon").otherwise("inline").alias("source_type"))
    best = x.groupBy("source_id", F.lower("term").alias("key")).agg(F.max_by(entry, F.struct(strong.alias("s"), place.alias("at"))).alias("e"))
    return best.select("source_id", "e.*")


def clean_page_text(text: Column) -> Column:
    """Text of a page as paragraphs: soft hyphens out, words split at line ends joined, page numbers out, lines joined."""
    s = rsub(text, r"\x{ad}\n?", "")
    s = rsub(s, r"(\p{L})-\n(\p{Ll})", "$1$2")
    s = rsub(s, r"(?m)^[ \t]*[0-9]{1,4}[ \t]*$\n?", "")
    s = rsub(s, r"(?<=[^\n.!?:;|>#*-])\n(?=\p{Ll})", " ")
    return rsub(rsub(s, r"\n{3,}", "\n\n"), r"^\s+|\s+\z", "")
