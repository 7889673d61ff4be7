"""Font, size and character profiles of spans, running headers, and reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUSPICIOUS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x80-\x9F\x{E000}-\x{F8FF}\x{FFFD}]"


def font_stats(spans: DataFrame) -> DataFrame:
    """Per font: characters, spans, pages, and whether any span is bold, italic or of a symbol font."""
    return spans.groupBy("font").agg(
        F.sum(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("n_spans"), F.count_distinct("page").alias("n_pages"),
        F.bool_or((F.col("flags").bitwiseAND(16)) != 0).alias("bold"), F.bool_or((F.col("flags").bitwiseAND(2)) != 0).alias("italic"),
        F.bool_or(F.col("font").rlike("(?i)ding|symbol|zapf|wing|math|fantasy")).alias("symbol"),
    )


def top_sizes(spans: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent rounded sizes of each font; the smaller size on ties."""
    n = spans.groupBy("font", F.round("size", 1).alias("size")).count()
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("font").orderBy(F.desc("count"), "size"))).where(F.col("rank") <= k)


def body_size(spans: DataFrame, group: list[str]) -> DataFrame:
    """The most frequent size; of equally frequent ones that which comes first."""
    n = spans.where(~F.col("text").rlike(r"^[\s0-9]*$")).groupBy(*group, "size").agg(F.count(F.lit(1)).alias("n"), F.min("span_id").alias("first"))
    return n.groupBy(*group).agg(F.max_by("size", F.struct("n", (-F.col("first")).alias("o"))).alias("body_size"))


def suspicious(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, char, n): control, private-use and replacement characters of each text."""
    x = texts.where(F.col(text).rlike(SUSPICIOUS)).select(key, F.explode(F.regexp_extract_all(text, F.lit(SUSPICIOUS), F.lit(0))).alias("c"))
    return x.groupBy(key, F.hex(F.encode("c", "UTF-16BE")).alias("char")).agg(F.count(F.lit(1)).alias("n"))


def char_frequency(texts: DataFrame, group: str, text: str, k: int = 50) -> DataFrame:
    """The k most frequent characters of each group."""
    c = texts.select(group, F.explode(F.split(text, "")).alias("char")).where("char != ''").groupBy(group, "char").count()
    return c.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("count"), F.encode("char", "UTF-8")))).where(F.col("rank") <= k)


def clusters(values: str, tolerance: float = 20.0):
    """Number of clusters of an array: a value further than the tolerance from a cluster's first begins the next."""
    return F.expr(f"aggregate(array_sort({values}), named_struct('n', 0, 's', cast(null as double)), (a, y) -> case when a.s is null or y - a.s > {tolerance} then named_struct('n', a.n + 1, 's', cast(y as double)) else a end, a -> a.n)")


def running_lines(spans: DataFrame, min_length: int = 5, max_clusters: int = 3) -> DataFrame:
    """Texts that come again at few heights of a page: (source_id, text, n, n_clusters)."""
    g = spans.where(F.length("text") >= min_length).groupBy("source_id", "text").agg(F.count(F.lit(1)).alias("n"), F.collect_set("y").alias("ys"))
    return g.where("n >= 2").withColumn("n_clusters", clusters("ys")).where(F.col("n_clusters") <= max_clusters).drop("ys")
