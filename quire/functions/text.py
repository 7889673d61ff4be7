"""Column functions over titles, Markdown text and page labels. All but the decomposing slug stay in the JVM.

Java's ``\\s``, ``\\w`` and ``\\b`` know ASCII only unless (?U) is set; where Unicode blanks matter, BLANKS is used.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, spelled out so that every regex dialect agrees on it.
BLANKS = r"[ \t\n\r\f\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def rsub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def collapse(c: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.trim(rsub(c, BLANKS + "+", " "))


def slug_ascii(title: Column) -> Column:
    """Lower case, brackets dropped, anything but letters and digits one hyphen; ``untitled`` if nothing is left."""
    s = rsub(F.lower(rsub(title, r"[()\[\]{}]", "")), r"[^a-z0-9]+", "-")
    s = rsub(s, r"^-+|-+$", "")
    return F.when(s == "", F.lit("untitled")).otherwise(s)


@F.pandas_udf(T.StringType())
def _decomposed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "replace").decode("ascii"))


def slug(title: Column) -> Column:
    """As ``slug_ascii`` after compatibility decomposition; a character with no ASCII part counts as punctuation."""
    return slug_ascii(F.when(title.rlike(r"[^\x00-\x7F]"), _decomposed(title)).otherwise(title))


def entity_slug(term: Column) -> Column:
    s = rsub(F.lower(collapse(term)), r"\s+", "-")
    s = rsub(rsub(rsub(s, r"[^a-z0-9-]", ""), r"-+", "-"), r"^-+|-+$", "")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


def source_slug(stem: Column) -> Column:
    """An id from a file name without its extension; punctuation other than brackets stays."""
    s = rsub(F.lower(rsub(stem, r"[()\[\]{}]", "")), r"[ _]", "-")
    s = rsub(rsub(s, r"-+", "-"), r"^-+|-+$", "")
    return F.when(s == "", F.lit("unnamed-source")).otherwise(s)


def title_key(title: Column) -> Column:
    """A heading without Markdown signs, soft hyphens, case and closing punctuation."""
    return rsub(F.lower(collapse(rsub(title, r"[*_`\[\]():\x{ad}]", ""))), r"[.,;:!?]+$", "")


def strip_affixes(key: Column) -> Column:
    """A normalised title without leading articles and part names, closing continuation marks and leading numbers."""
    s = rsub(collapse(key), r"^(?:(?:the|a|an|chapter|ch|section|part|book|appendix) )+(?=\S)", "")
    s = rsub(s, r"(?:(?:^| )(?:contd|continued|cont|\(cont\)|\(continued\)))+$", "")
    return collapse(rsub(s, r"^[0-9]+\.?", ""))


def bullets(text: Column) -> Column:
    """Bullet characters at line starts become list marks; further dots are a rating and stay."""
    b = "•◦▪►‣▸▹●○◎"
    return rsub(rsub(text, rf"(?m)^([ \t]*)[{b}]([{b}]+)[ \t]*", "$1- $2 "), rf"(?m)^([ \t]*)[{b}][ \t]*", "$1- ")


def tidy(text: Column) -> Column:
    """No blanks at line ends, at most one empty line in a row, none at either end, one closing line break."""
    s = rsub(rsub(text, r"[ \t\r\f\x0b]+(?=\n|\z)", ""), r"\n{3,}", "\n\n")
    return F.concat(rsub(s, r"^[ \t\r\n]+|[ \t\r\n]+\z", ""), F.lit("\n"))


def drop_running_headers(text: Column) -> Column:
    return rsub(text, r"(?m)^[ \t]*>>[ \t]+[^\n]+?[ \t]+<<[ \t]*$", "")


def breaks_in_tables(text: Column) -> Column:
    """``<br>`` becomes `` / `` on lines that hold a pipe."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.when(F.contains(x, F.lit("|")), rsub(x, r"(?i)<br[ \t]*/?>", " / ")).otherwise(x)), "\n")


def drop_anchors(text: Column) -> Column:
    return rsub(text, r'<span\s+id="page-[0-9]+-[0-9]+"\s*>\s*</span>', "")


def annotate_pages(text: Column) -> Column:
    """``p. 12``, ``pp. 3-5`` and ``see page 7`` become references that can be resolved."""
    s = rsub(text, r"([A-Z][A-Za-z0-9_]*?)p\.[ \t\n]*([0-9]+(?:[ \t]*[-–][ \t]*[0-9]+)?)\b", "$1 p. $2")
    s = rsub(s, r"\b[pP]{1,2}\.[ \t\n]*([0-9]+(?:[ \t]*[-–][ \t]*[0-9]+)?)\b", "{{page-ref:$1}}")
    return rsub(s, r"(?i)\b(?:see|on|at|to)[ \t\n]+page[ \t\n]+([0-9]+)\b", "{{page-ref:$1}}")


def page_number(label: Column) -> Column:
    """The number of an Arabic page label or of the first page of a range; null for any other label."""
    first = F.trim(F.get(F.split(label, "-"), F.lit(0)))
    return F.when(first.rlike(r"^[0-9]{1,9}$"), first.cast("int"))


def roman(n: Column) -> Column:
    """Capital Roman numerals of 1 and more; thousands are as many M. Others give none."""
    digit = lambda names, div: F.element_at(F.array(*[F.lit(x) for x in names]), (F.floor(n / div) % 10 + 1).cast("int"))
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
    tens = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
    hundreds = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
    return F.when(n >= 1, F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), digit(hundreds, 100), digit(tens, 10), digit(ones, 1)))


def roman_value(label: Column) -> Column:
    """The number of a Roman numeral in any case, by its letters alone: one before a larger one counts down. Else null."""
    worth = F.create_map(*[F.lit(x) for kv in zip("IVXLCDM", (1, 5, 10, 50, 100, 500, 1000), strict=True) for x in kv])
    v = F.transform(F.filter(F.split(F.upper(F.trim(label)), ""), lambda c: c != ""), lambda c: worth[c])
    total = F.aggregate(F.sequence(F.lit(1), F.size(v)), F.lit(0), lambda acc, i: acc + F.when(F.get(v, i - 1) < F.coalesce(F.get(v, i), F.lit(0)), -F.get(v, i - 1)).otherwise(F.get(v, i - 1)))
    return F.when(F.trim(label).rlike("^[IVXLCDMivxlcdm]+$"), total)


def is_roman(label: Column) -> Column:
    """Whether a page label is a Roman numeral of front matter: the first twenty, or one that ends in I, IV or IX."""
    t = F.lower(F.trim(label))
    first = [x.lower() for x in ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX", "XX")]
    return t.isin(*first) | t.rlike(r"^m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{1,3})$")


def alpha(n: Column) -> Column:
    """1 = a, 26 = z, 27 = aa, and so on without end; less than 1 gives none."""
    state = F.aggregate(
        F.sequence(F.lit(1), F.lit(14)),  # 26 ** 14 is beyond any number of 64 bits
        F.struct(F.lit("").alias("s"), n.cast("bigint").alias("k")),
        lambda a, _: F.when(a["k"] > 0, F.struct(F.concat(F.chr(F.lit(97) + (a["k"] - 1) % 26), a["s"]).alias("s"), ((a["k"] - 1 - (a["k"] - 1) % 26) / 26).cast("bigint").alias("k"))).otherwise(a),
        lambda a: a["s"],
    )
    return F.when(n >= 1, state)


def page_label(prefix: Column, style: Column, n: Column) -> Column:
    body = F.when(style == "/R", roman(n)).when(style == "/r", F.lower(roman(n))).when(style == "/A", F.upper(alpha(n))).when(style == "/a", alpha(n)).otherwise(n.cast("string"))
    return F.concat(prefix, body)
