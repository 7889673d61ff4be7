"""Sources, step states, files and images: upserts, latest states, set differences and tiered look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and the old ones whose key is not among them."""
    return new.unionByName(old.join(new.select(keys).distinct(), keys, "left_anti"))


def latest(events: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The last row of each key."""
    cols = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(at, tie)).alias("r")).select(*keys, "r.*")


def pending(wanted: DataFrame, states: DataFrame, keys: list[str], done: str = "completed") -> DataFrame:
    return wanted.join(states.where(F.col("status") == done).select(keys).distinct(), keys, "left_anti")


def missing_files(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Paths that are expected but not present."""
    return expected.select("path").distinct().join(present.select("path").distinct(), "path", "left_anti")


def image_paths(refs: DataFrame, images: DataFrame) -> DataFrame:
    """(source_id, ref, path, tier): by name, else without a leading underscore, else the first image of the page."""
    named = images.groupBy("source_id", "ref_name").agg(F.min_by("path", "image_id").alias("path"))
    page = F.regexp_extract("ref_name", r"^(_page_[0-9]+_)", 1)
    paged = images.withColumn("page", page).where("page != ''").groupBy("source_id", "page").agg(F.min_by("path", "image_id").alias("path"))
    r = refs.join(named.select("source_id", F.col("ref_name").alias("ref"), F.col("path").alias("p1")), ["source_id", "ref"], "left")
    r = r.withColumn("bare", F.regexp_replace("ref", "^_", "")).join(named.select("source_id", F.col("ref_name").alias("bare"), F.col("path").alias("p2")), ["source_id", "bare"], "left")
    r = r.withColumn("page", F.regexp_extract("ref", r"(_page_[0-9]+_)", 1)).join(paged.select("source_id", "page", F.col("path").alias("p3")), ["source_id", "page"], "left")
    tier = F.when(F.col("p1").isNotNull(), 1).when(F.col("p2").isNotNull(), 2).when(F.col("p3").isNotNull(), 3).otherwise(0)
    return r.select("source_id", "ref", F.coalesce("p1", "p2", "p3").alias("path"), tier.alias("tier"))


def report_summary(reports: DataFrame) -> DataFrame:
    """Findings of each run by kind, and whether it was clean."""
    n = lambda c: F.greatest(F.size(F.coalesce(c, F.expr(f"slice({c}, 1, 0)"), )), F.lit(0))
    s = reports.select("report_id", "source_id", n("broken_links").alias("n_links"), n("broken_images").alias("n_images"), n("orphan_files").alias("n_orphans"), n("unresolved_page_refs").alias("n_refs"), n("warnings").alias("n_warnings"))
    return s.withColumn("is_clean", F.expr("n_links + n_images + n_orphans + n_refs = 0"))
