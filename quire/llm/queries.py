"""Queries of the training-text operators over the whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, encoding, leakage, markup, quality, scripts, survivors
from quire.session import cut, table


def _words(spark: SparkSession, d: str) -> DataFrame:
    """The clean words of the corpus: section texts and section titles."""
    return cut(encoding.corpus_words([table(spark, d, "documents").select("text"), table(spark, d, "sections").select("title")]))


def _field(df: DataFrame, field: str, key: str, text: str) -> DataFrame:
    return df.select(F.lit(field).alias("field"), F.col(key).cast("bigint").alias("record_id"), F.col("source_id").alias("source"), F.col(text).alias("text"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    """Terms, bookmark titles and section titles, by the names of p1."""
    g, t, s = (table(spark, d, n) for n in ("glossary", "toc_entries", "sections"))
    return reduce(DataFrame.unionByName, (_field(g, "glossary", "glossary_id", "term"), _field(t, "toc", "entry_id", "title"), _field(s, "section", "section_row", "title")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    differs = scripts.differing(_titles(spark, d)).select(F.col("field").alias("kind"), "record_id", "text")
    # a field whose encoding is damaged is no case here; section titles are no field of that kind
    garbled = encoding.garbled_fields(differs.where("kind != 'section'").select(F.col("kind").alias("field"), "record_id", "text"), _words(spark, d))
    out = differs.join(garbled.withColumnRenamed("field", "kind"), ["kind", "record_id"], "left_anti")
    return out.select("kind", "record_id").distinct()


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every term and title, also of those that are theirs already."""
    src = _titles(spark, d)
    forms = scripts.consistent_forms(src).select(F.col("field").alias("kind"), "record_id", "form", "differs")
    plain = src.where("text is null").select(F.col("field").alias("kind"), "record_id", F.col("text").alias("form"), F.lit(False).alias("differs")).unionByName(
        src.where(~F.col("text").rlike(scripts.NOT_PLAIN)).select(F.col("field").alias("kind"), "record_id", F.col("text").alias("form"), F.lit(False).alias("differs"))
    )
    return forms.unionByName(plain)


def _encoded_fields(spark: SparkSession, d: str) -> DataFrame:
    g, t = table(spark, d, "glossary"), table(spark, d, "toc_entries")
    parts = (_field(g, "term", "glossary_id", "term"), _field(g, "definition", "glossary_id", "definition"), _field(t, "title", "entry_id", "title"))
    return reduce(DataFrame.unionByName, parts).drop("source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_fields(_encoded_fields(spark, d), _words(spark, d))


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restore(_encoded_fields(spark, d), _words(spark, d)).select("field", "record_id", "restored", "complete")


def _marked_fields(spark: SparkSession, d: str) -> DataFrame:
    g, t = table(spark, d, "glossary"), table(spark, d, "pipe_tables")
    return _field(g, "definition", "glossary_id", "definition").withColumn("is_table", F.lit(False)).unionByName(_field(t, "raw_text", "table_id", "raw_text").withColumn("is_table", F.lit(True)))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_texts(_marked_fields(spark, d)).where("marked").select("field", "record_id").distinct()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_texts(_marked_fields(spark, d)).where("marked").select("field", "record_id", "clean", F.array_join("kinds", ",").alias("kinds"))


def p5_votes(spark: SparkSession, d: str) -> DataFrame:
    """What each book votes on each path; ``raised`` and ``lowered`` are the containers whose verdict is the vote's alone."""
    v = markup.path_votes(markup.readings(_marked_fields(spark, d)))
    weak = F.col("n") - F.col("strong")
    return v.select("source", "path", "n", F.round("score", 6).alias("score"), F.round("overall", 6).alias("overall"), "won", F.when(F.col("won"), weak).otherwise(0).alias("raised"), F.when(F.col("won"), 0).otherwise(F.col("strong")).alias("lowered"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    out = survivors.glossary_survivors(table(spark, d, "glossary"), _words(spark, d))
    return out.select("group_id", "definition_from", "section_from")


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.surviving_entries(table(spark, d, "glossary"), _words(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    out = leakage.leaked_items(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return out.select("doc_id", "item_id")


def _statistics(spark: SparkSession, d: str, chunk: int = quality.CHUNK) -> DataFrame:
    return quality.text_statistics(table(spark, d, "documents"), "doc_id", "text", quality.common_set(table(spark, d, "common_words")), chunk)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d).where("shape is not null").select("doc_id", "shape")


def _reported(s: DataFrame) -> DataFrame:
    rounded = ("mean_word_length", "symbol_ratio", "digit_ratio", "ended_share", "common_share")
    return s.select("doc_id", "n_chars", "n_words", "n_lines", *(F.round(c, 6).alias(c) for c in rounded))


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _reported(_statistics(spark, d))


def p9_chunked(spark: SparkSession, d: str) -> DataFrame:
    """The same statistics with every text cut into chunks of 512 characters and merged through the tree."""
    return _reported(_statistics(spark, d, 512))


P9_STATISTICS = r"""
WITH c AS (SELECT list(DISTINCT lower(word)) AS common FROM common_words),
d AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w, regexp_replace(text, '[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]+', '', 'g') AS ink
      FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, w, ink, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]+$', '')), lambda x: x <> '') AS lines FROM d),
n AS (SELECT doc_id, text, w, length(ink) AS ink, len(regexp_extract_all(ink, '\p{Nd}')) AS digits, len(lines) AS n_lines, len(list_filter(lines, lambda x: regexp_matches(x, '[.!?…。！？:;»”"’'')]$'))) AS ended, list_sum(list_transform(w, lambda x: length(x))) AS chars FROM l)
SELECT doc_id, length(text) AS n_chars, len(w) AS n_words, n_lines,
       CASE WHEN ink > 0 THEN round(digits / ink, 6) ELSE 0.0 END AS digit_ratio,
       CASE WHEN n_lines > 0 THEN round(ended / n_lines, 6) ELSE 0.0 END AS ended_share,
       CASE WHEN len(w) > 0 THEN round(chars / len(w), 6) ELSE 0.0 END AS mean_word_length,
       CASE WHEN ink > 0 THEN round((ink - coalesce(chars, 0)) / ink, 6) ELSE 0.0 END AS symbol_ratio,
       CASE WHEN len(w) > 0 THEN round(len(list_filter(w, lambda x: list_contains(common, x))) / len(w), 6) ELSE 0.0 END AS common_share
FROM n, c
"""

QUERIES = {
    "p1_found": p1_found, "p1_forms": p1_forms, "p4_found": p4_found, "p4_restored": p4_restored, "p5_found": p5_found, "p5_clean": p5_clean, "p5_votes": p5_votes, "p6_found": p6_found, "p6_survivors": p6_survivors, "p7_ids": p7_ids,
    "p8_found": p8_found, "p9_found": p9_found, "p9_statistics": p9_statistics, "p9_chunked": p9_chunked,
}
SQL = {"p9_statistics": P9_STATISTICS, "p9_chunked": P9_STATISTICS}
