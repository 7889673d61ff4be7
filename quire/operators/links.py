"""Terms in texts: which a text names, where, and links to their pages."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import entity_slug, rsub

#: Terms shorter than this are too common to be looked for.
LEAST = 3


def _norm(c: Column) -> Column:
    return F.trim(rsub(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def named_terms(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """(source_id, key, term): terms of the book whose words stand one after the other in a text, in any case.

    ``terms``: source_id, term (lower case). ``texts``: source_id, key, text. A term is looked up by that word of it
    that the fewest terms of the book have, so that a common word joins little; then the whole term is compared.
    """
    t = terms.select("source_id", "term").where(F.length("term") >= LEAST).distinct().withColumn("plain", _norm(F.col("term"))).where("plain != ''")
    w = t.select("source_id", "term", "plain", F.explode(F.array_distinct(F.split("plain", " "))).alias("word"))
    rare = w.join(w.groupBy("source_id", "word").agg(F.count(F.lit(1)).alias("n")), ["source_id", "word"]).groupBy("source_id", "term", "plain").agg(F.min(F.struct("n", "word")).alias("x")).select("source_id", "term", "plain", F.col("x.word").alias("word"))
    x = texts.where("text is not null").select("source_id", "key", _norm(F.col("text")).alias("text"))
    words = x.select("source_id", "key", F.explode(F.array_distinct(F.split("text", " "))).alias("word")).where("word != ''")
    hits = words.join(rare, ["source_id", "word"]).select("source_id", "key", "term", "plain")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return hits.join(x, ["source_id", "key"]).where(F.contains(pad(F.col("text")), pad(F.col("plain")))).select("source_id", "key", "term").distinct()


def see_also(terms: DataFrame, definitions: DataFrame, most: int = 8) -> DataFrame:
    """(source_id, glossary_id, term, pos): the terms that a definition names, longer ones first, at most ``most``.

    Not the entry's own term, nor one that is part of another one named there.
    """
    t = terms.select("source_id", F.lower("term").alias("term"))
    hit = named_terms(t, definitions.select("source_id", F.col("glossary_id").alias("key"), F.col("definition").alias("text")))
    own = definitions.groupBy("source_id", F.col("glossary_id").alias("key")).agg(F.collect_set(F.lower("term")).alias("own"))
    hit = hit.join(own, ["source_id", "key"]).where(~F.array_contains("own", F.col("term")))
    g = hit.groupBy("source_id", "key").agg(F.array_sort(F.collect_list(F.struct((-F.length("term")).alias("n"), "term"))).alias("all"))
    free = F.filter("all", lambda x: ~F.exists("all", lambda y: (y["term"] != x["term"]) & F.contains(y["term"], x["term"])))
    return g.select("source_id", F.col("key").alias("glossary_id"), F.posexplode(F.slice(free, 1, most)).alias("pos", "x")).select("source_id", "glossary_id", F.col("x.term").alias("term"), "pos")


def references(text: str, terms: list[str]) -> list[tuple[int, int, str]]:
    """(start, end, term) of every place that may be linked, longest term first, none over another, in their order.

    A place in a heading, in bold, or in a link or its target is none.
    """
    low, taken, out = text.lower(), bytearray(len(text)), []
    if len(low) != len(text):  # a character whose lower case is two has no place of its own
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for term in sorted(set(terms), key=lambda t: (-len(t), t)):
        if len(term) < LEAST:
            continue
        for m in re.finditer(rf"(?<!\w){re.escape(term)}(?!\w)", low):
            a, z = m.span()
            line = text[text.rfind("\n", 0, a) + 1 : a]
            bold = text[max(0, a - 2) : a] == "**" and text[z : z + 2] == "**"
            target = re.search(r"\][^\]]*\([^)]*$", text[max(0, a - 50) : a])
            if any(taken[a:z]) or bold or target or line.lstrip().startswith("#") or ("[" in line and "]" not in line[line.rfind("[") :]):
                continue
            taken[a:z] = b"\1" * (z - a)
            out.append((a, z, term))
    return out


@F.pandas_udf(T.StringType())
def _linked(text: pd.Series, terms: pd.Series, slugs: pd.Series, prefix: pd.Series, most: pd.Series) -> pd.Series:
    def one(t, names, paths, p, k):
        if t is None or names is None:
            return t
        slug = dict(zip(names, paths, strict=True))
        for a, z, term in sorted(references(t, list(names))[:k], reverse=True):
            t = f"{t[:a]}[{t[a:z]}]({p}entities/{slug[term]}.md){t[z:]}"
        return t

    return pd.Series([one(*x) for x in zip(text, terms, slugs, prefix, most, strict=True)])


def link_terms(texts: DataFrame, terms: DataFrame, most: int = 20) -> DataFrame:
    """(key, text): texts with links to the pages of the terms they name, at most ``most`` each.

    ``texts``: source_id, key, path, text; the path of the note below ``books/`` tells how far up the pages lie. Texts
    without terms pass as they are.
    """
    hit = named_terms(terms.select("source_id", F.lower("term").alias("term")), texts)
    g = hit.groupBy("source_id", "key").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    x = texts.join(g, ["source_id", "key"], "left")
    up = F.repeat(F.lit("../"), F.greatest(F.size(F.split("path", "/")) - 3, F.lit(0)))
    slugs = F.transform("terms", entity_slug)
    return x.select("key", _linked("text", "terms", slugs, up, F.lit(most)).alias("text"))
