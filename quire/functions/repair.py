"""Repair of converted texts: page anchors, symbol fonts, words broken by recognition, running lines."""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import annotate_pages, breaks_in_tables, bullets, drop_anchors, drop_running_headers, rsub, tidy

# Fixed values: (least, most) letters before a break, and the word ends behind it.
ENDINGS = (
    (2, 7, "tion|tions|tive|tively"), (2, 7, "lence|rence|sion|sure|plish|nish|tish|lish"), (3, 7, "ment|ments|mental"), (3, 7, "ence|ences|ance|ances"), (3, 7, "ous|ously|ive|ively|ivity"),
    (3, 7, "able|ably|ible|ibly"), (3, 7, "ally"), (3, 7, "arly"), (3, 8, "ly"), (3, 7, "ing|ingly|ation|ations"), (3, 7, "er|ers|est"), (3, 7, "ed|edly|ening"), (3, 7, "ful|fully|less|lessly"),
    (3, 7, "ness|nesses"), (3, 7, "ize|ized|izes|ise|ised|ises"),
)
# Broken words that no ending tells; a bar where the first part begins a word.
BROKEN = (
    "import ant", "import ance", "|en counter", "|dis count", "|con sider", "|con sideration", "|com petition", "|rap pelling", "|spell ing", "end less", "regard less", "|estab lish", "|pun lish", "|how ever",
    "|never the", "|what ever", "|where ever", "|fur nish", "|van ish", "|accom plish", "|charac ter", "|charac ters", "|for ward", "|el ement", "|el ements",
)
# Pairs that are two words.
TWO_WORDS = frozenset({"much less", "much lessly", "will less", "with less"})


def _breaks() -> list[re.Pattern]:
    out = [re.compile(rf"(\w{{{a},{z}}})\s+({ends})\b") for a, z, ends in ENDINGS]
    for pair in BROKEN:
        first, second = pair.lstrip("|").split(" ")
        # the one word of three parts keeps its last blank: the two parts joined come first
        last = r"\s+(?:less)\b" if second == "the" else r"\b"
        out.append(re.compile((r"(\b" if pair[0] == "|" else "(") + rf"{first})\s+({second}){last}"))
    return out


_BREAKS = _breaks()


def _rejoin(m: re.Match) -> str:
    a, b = m.group(1), m.group(2)
    whole = a + b
    return whole if f"{a} {b}" not in TWO_WORDS and whole.isalpha() and whole.islower() else m.group()


def join_broken_words(text: str) -> str:
    for p in _BREAKS:
        text = p.sub(_rejoin, text)
    return text


@F.pandas_udf(T.StringType())
def _joined(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else join_broken_words(x))


def broken_words(text: Column) -> Column:
    """Words that recognition broke in two are joined: known endings behind a lower-case part, and known words.

    The match of a rule is consumed even where the joined word is refused; a part is at most eight letters, so the
    letters before those are not looked at. Texts without a lower-case letter on both sides of a blank are not sent to Python.
    """
    return F.coalesce(_joined(F.when(text.rlike(r"(?U)\p{Ll}\s+[a-z]"), text)), text)


def unwrap_page_links(text: Column) -> Column:
    """``[\\(p.21\\)](#page-21-0)`` becomes ``p.21``: links to page anchors leave their label without brackets and dots."""
    marked = rsub(text, r"\[([^\]]*?)\]\(#page-[0-9]+-[0-9]+\)", "\x01$1\x01")
    label = lambda x: rsub(rsub(rsub(x, r"\\[()]", ""), r"^\s+|\s+\z", ""), r"^[().]+|[().]+\z", "")
    return F.array_join(F.transform(F.split(marked, "\x01"), lambda x, i: F.when(i % 2 == 1, label(x)).otherwise(x)), "")


def clean_anchors(text: Column) -> Column:
    """Links to page anchors unwrapped, anchors and empty spans out, line breaks in tables as slashes."""
    return breaks_in_tables(rsub(drop_anchors(unwrap_page_links(text)), r"<span\s*>\s*</span>", ""))


#: What symbols are read as where nothing is known of a book's fonts.
DINGBATS = {"Y": "•"}


def symbols(text: Column, known: Mapping[str, str] | None = None) -> Column:
    """Letters that stand for signs of a symbol font: at the head of a list item, and alone in brackets, ``(Y to YY)`` too.

    ``known`` are a book's signs; None takes the usual ones, an empty map none. Lengths are kept.
    """
    def swapped(x: Column, c: str, sign: str) -> Column:
        one = lambda y: F.replace(y, F.lit(c), F.lit(sign))
        return F.when(x.rlike(r"\sto\s"), F.array_join(F.transform(F.split(x, r"\s+to\s+"), one), " to ")).otherwise(one(x))

    t = text
    for c, sign in (DINGBATS if known is None else known).items():
        q = re.escape(c)
        for p in (rf"(?m)^(?:- ){q}+(?=\s|$)", rf"\({q}+\)", rf"\({q}+\s+to\s+{q}+\)"):
            parts = F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(0)), lambda x: swapped(x, c, sign))  # noqa: B023
            both = F.arrays_zip(F.split(t, p, -1).alias("a"), parts.alias("b"))
            t = F.when(t.rlike(p), F.array_join(F.transform(both, lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")))), "")).otherwise(t)
    return t


def repair(text: Column, known: Mapping[str, str] | None = None) -> Column:
    """All steps in their order: anchors, symbols, running lines, broken words, bullets, white space, page references."""
    return annotate_pages(tidy(bullets(broken_words(drop_running_headers(symbols(clean_anchors(text), known))))))


def strip_running_lines(text: Column, lines: Column) -> Column:
    """Lines out that equal one of ``lines`` (an array), or are one of them with a page number behind."""
    again = lambda x: F.exists(lines, lambda h: (F.trim(x) == h) | (F.startswith(F.trim(x), h) & F.substring(F.trim(x), F.length(h) + 1, F.length(x)).rlike(r"^\s*[0-9]*\s*$")))
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: (F.trim(x) == "") | ~again(x)), "\n")
