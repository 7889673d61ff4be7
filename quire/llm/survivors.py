"""One surviving entry for each group of duplicate glossary entries, by skyline selection.

The key of a group is the source and the term in one form: restored encoding, consistent characters, folded case,
single blanks, no closing dashes, colons and full stops. Inside a group an entry is a point with a definition or not,
a section or not, a trust and a time. The entries that no other dominates are the first layer, the next ones the
second, and so on; within a layer the policy (trust, then time, then smallest id) orders them. The survivor takes
each field from the first entry in that order that has it, so nulls are filled from successive layers.

A group may hold a third of all rows. Of the entries of a group with equal trust and equal completeness only the
latest (smallest id on ties) can be undominated, and it dominates the others; so the group is first reduced, by an
aggregate that combines before the shuffle, to at most one candidate for each of the few combinations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import encoding, scripts
from quire.session import cut

#: Trust by source_type, the most trusted last; anything else, null included, is the least.
TRUST = ("field", "inline", "lexicon")


def fold(term: Column) -> Column:
    """Case, blanks and closing dashes, colons and full stops out of a term already in consistent characters."""
    t = F.replace(F.lower(term), F.lit("ß"), F.lit("ss"))
    t = F.regexp_replace(t, F.lit(r"\s+"), F.lit(" "))
    return F.regexp_replace(t, F.lit(r"^ +|[ \-‐-―:.]+$"), F.lit(""))


def term_keys(glossary: DataFrame, words: DataFrame) -> DataFrame:
    """(record_id, key): the folded term of each row that has one; rows of pure ASCII take no part in any join.

    A term of nothing but signs that folding drops is its own key.
    """
    src = glossary.select(F.lit("term").alias("field"), F.col("glossary_id").alias("record_id"), F.col("source_id").alias("source"), F.col("term").alias("text")).where("text is not null")
    odd = F.col("text").rlike(scripts.NOT_PLAIN)
    key = F.coalesce(F.nullif(fold(F.col("text")), F.lit("")), F.col("text")).alias("key")
    fixed = encoding.restore(src.where(odd).select("field", "record_id", "text").distinct(), words).select("record_id", "restored")
    # what was damaged is little; it is read by the two steps of the next line
    whole = cut(src.where(odd).join(fixed, "record_id", "left").withColumn("text", F.coalesce("restored", "text")).drop("restored"))
    forms = scripts.consistent_forms(whole).select("record_id", F.col("form").alias("text"))
    return src.where(~odd).unionByName(whole.where(~odd)).select("record_id", key).unionByName(forms.select("record_id", key))


def candidates(rows: DataFrame) -> DataFrame:
    """At most one entry of a group for each trust and completeness.

    ``rows``: source, key, id, at, trust, has_def, has_sec. -> source, key, group_id, n, points
    """
    # numbers alone are compared; a time that is null is before all others
    at = F.coalesce(F.unix_micros(F.col("at").cast("timestamp")), F.lit(-(1 << 63)))
    cell = rows.groupBy("source", "key", "trust", "has_def", "has_sec").agg(F.max(F.struct(at.alias("at"), (-F.col("id")).alias("neg_id"))).alias("p"), F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    point = F.struct("trust", F.col("p.at").alias("at"), F.col("p.neg_id").alias("neg_id"), "has_def", "has_sec")
    return cell.groupBy("source", "key").agg(F.min("least").alias("group_id"), F.sum("n").alias("n"), F.collect_list(point).alias("points"))


_DOMINATES = """(a.trust >= b.trust and a.at >= b.at and a.has_def >= b.has_def and a.has_sec >= b.has_sec
  and (a.trust > b.trust or a.at > b.at or a.has_def > b.has_def or a.has_sec > b.has_sec))"""


def layers(groups: DataFrame) -> DataFrame:
    """Adds ``ranked``: the candidates by dominance layer, then trust, time and smallest id.

    A candidate's layer is the length of the longest chain of candidates above it. Dominance implies a higher policy
    order, so one pass in that order finds it.
    """
    order = "sort_array(transform(points, p -> named_struct('trust', p.trust, 'at', p.at, 'neg_id', p.neg_id, 'p', p)), false)"
    g = groups.withColumn("sorted", F.expr(f"transform({order}, x -> x.p)"))
    above = f"filter(acc, a -> {_DOMINATES})"
    kind = "struct<layer:int,trust:int,at:bigint,has_def:boolean,has_sec:boolean,neg_id:bigint>"
    fields = "b.trust as trust, b.at as at, b.has_def as has_def, b.has_sec as has_sec, b.neg_id as neg_id"
    step = f"concat(acc, array(struct(cast(coalesce(array_max(transform({above}, a -> a.layer)), 0) + 1 as int) as layer, {fields})))"
    g = g.withColumn("layered", F.expr(f"aggregate(sorted, cast(array() as array<{kind}>), (acc, b) -> {step})"))
    return g.withColumn("ranked", F.expr("array_sort(layered, (x, y) -> case when x.layer != y.layer then x.layer - y.layer when x.trust != y.trust then y.trust - x.trust when x.at != y.at then case when x.at > y.at then -1 else 1 end when x.neg_id > y.neg_id then -1 else 1 end)")).drop("sorted", "layered")


def survivors(rows: DataFrame) -> DataFrame:
    """One row a group of two or more: group_id, source_id, entry_from, definition_from, section_from.

    The ids of the entries that the term and source type, the definition and the section come from. ``entry_from`` is
    the first entry; a blank definition counts as none; a group without any definition (section) has null there. Rows
    without a term or source take no part. Exact repeats under new ids count as rows of the group.
    """
    g = layers(candidates(rows.where("key is not null and source is not null")).where("n >= 2"))
    return g.select(
        "group_id", F.col("source").alias("source_id"), F.expr("-ranked[0].neg_id").alias("entry_from"),
        F.expr("-get(filter(ranked, x -> x.has_def), 0).neg_id").alias("definition_from"), F.expr("-get(filter(ranked, x -> x.has_sec), 0).neg_id").alias("section_from"),
    )


def filled(definition: Column) -> Column:
    """Whether a definition holds anything but blanks."""
    return F.coalesce(F.length(F.regexp_replace(definition, r"(?U)\s+", "")) > 0, F.lit(False))


def glossary_survivors(glossary: DataFrame, words: DataFrame) -> DataFrame:
    trust = F.coalesce(F.array_position(F.array(*map(F.lit, TRUST)), F.col("source_type")), F.lit(0)).cast("int")
    g = glossary.select(
        F.col("source_id").alias("source"), F.col("glossary_id").alias("record_id"), F.col("glossary_id").alias("id"), F.col("extracted_at").alias("at"), trust.alias("trust"),
        filled(F.col("definition")).alias("has_def"), F.col("section_id").isNotNull().alias("has_sec"),
    )
    return survivors(g.join(term_keys(glossary, words), "record_id"))


def surviving_entries(glossary: DataFrame, words: DataFrame) -> DataFrame:
    """The survivors with their term, source_type, definition and section_id, fetched for the winners alone."""
    out = glossary_survivors(glossary, words)
    for at, fields in (("entry_from", ("term", "source_type")), ("definition_from", ("definition",)), ("section_from", ("section_id",))):
        one = glossary.groupBy(F.col("glossary_id").alias(at)).agg(*(F.first(c).alias(c) for c in fields))
        out = out.join(one, at, "left")
    return out.select("group_id", "source_id", "term", "source_type", "definition", "definition_from", "section_id", "section_from")
