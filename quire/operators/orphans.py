"""References to records that do not exist: long-form union of parent and child keys, one group a parent key.

Parents (rows that can be referred to, with a life span) and children (references with a time) of any number of
table pairs go into one long form tagged by kind. One shuffle groups it by (kind, key); within a group a running
maximum of the ends of the parents that began so far tells for each child whether some parent is alive at its time,
and the group's parent flag tells ``missing`` from ``late``. Groups that lack the flag are the orphans proper.
A key that holds more than ``hot_rows`` children is spread over several salted groups, to each of which the (few)
parents of that key are copied; keys below it cost nothing extra.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import paths

HOT_ROWS = 200_000
FOREVER = "timestamp_ntz'9999-12-31 23:59:59'"


def long_form(children: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Tagged union with a salt: (kind, key, salt, at, ends, parent, record_id, pos)."""
    kids = children.where("key is not null and key != ''").withColumn("at", F.col("at").cast("timestamp_ntz"))
    # repeated parent rows collapse before the shuffle; of equal starts only the latest end matters
    folk = parents.where("key is not null").groupBy("kind", "key", F.col("starts").cast("timestamp_ntz").alias("at")).agg(
        F.max(F.coalesce(F.col("ends").cast("timestamp_ntz"), F.expr(FOREVER))).alias("ends")
    )
    hot = kids.groupBy("kind", "key").count().where(F.col("count") > hot_rows).select("kind", "key", F.ceil(F.col("count") / hot_rows).cast("int").alias("n"))
    found = hot.take(2001)
    if found:
        if len(found) <= 2000:  # a checked size; beyond it the planner joins the two sides by shuffling
            hot = F.broadcast(children.sparkSession.createDataFrame(found, hot.schema))
        kids = kids.join(hot, ["kind", "key"], "left").withColumn("salt", F.expr("coalesce(pmod(xxhash64(record_id, pos), n), 0)").cast("int")).drop("n")
        folk = folk.join(hot, ["kind", "key"], "left").withColumn("salt", F.explode(F.expr("sequence(0, coalesce(n, 1) - 1)"))).drop("n")
    else:
        kids, folk = kids.withColumn("salt", F.lit(0)), folk.withColumn("salt", F.lit(0))
    none = F.lit(None)
    return folk.select("kind", "key", "salt", "at", "ends", F.lit(1).alias("parent"), none.cast("long").alias("record_id"), none.cast("int").alias("pos")).unionByName(
        kids.select("kind", "key", "salt", "at", none.cast("timestamp_ntz").alias("ends"), F.lit(0).alias("parent"), "record_id", "pos")
    )


def orphan_references(children: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(kind, record_id, pos, at, state) of every reference without a living target.

    ``children``: kind, record_id, pos, key, at. ``parents``: kind, key, starts (inclusive), ends (exclusive, null
    for never). State is ``missing`` if no parent row has the key, ``deleted`` if one began by then, else ``late``.
    A null or empty key is no reference. A parent without a start counts as a row that never began. A reference
    without a time has no living target only if the key is missing or no parent ever began. Repeated parents change
    nothing; repeated references each come out. Either side may be empty.
    """
    rows = long_form(children, parents, hot_rows)
    group = Window.partitionBy("kind", "key", "salt")
    upto = group.orderBy(F.col("at").asc_nulls_last(), F.col("parent").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    began = (F.col("parent") == 1) & F.col("at").isNotNull()
    rows = rows.withColumns({
        "reach": F.max(F.when(began, F.col("ends"))).over(upto),
        "has_parent": F.max("parent").over(group),
    }).where("parent = 0")
    alive = F.when(F.col("at").isNull(), F.col("reach").isNotNull()).otherwise(F.coalesce(F.col("reach") > F.col("at"), F.lit(False)))
    state = F.when(F.col("has_parent") == 0, "missing").when(F.col("reach").isNotNull(), "deleted").otherwise("late")
    return rows.where(~alive).select("kind", "record_id", "pos", "at", state.alias("state"))


def orphans_by_period(orphans: DataFrame, period: str = "month") -> DataFrame:
    """Counts per parent table, state and period of the reference's time."""
    return orphans.groupBy("kind", F.date_trunc(period, F.col("at").cast("timestamp")).cast("date").alias("period"), "state").agg(F.count(F.lit(1)).alias("n_refs"))


def wiki_references(reports: DataFrame, sections: DataFrame) -> DataFrame:
    """The references of the wiki: links and images named in validation reports, parents named in sections."""
    links = reports.select("report_id", F.col("run_at").alias("at"), F.posexplode("broken_links").alias("pos", "x")).select(
        F.lit("link").alias("kind"), F.col("report_id").alias("record_id"), "pos", F.when(F.col("x.target") != "", paths.resolve(F.col("x.file"), F.col("x.target"))).alias("key"), "at"
    )
    images = reports.select("report_id", F.col("run_at").alias("at"), F.posexplode("broken_images").alias("pos", "x")).select(
        F.lit("image").alias("kind"), F.col("report_id").alias("record_id"), "pos", F.when(F.col("x.path") != "", paths.resolve(F.col("x.file"), F.col("x.path"))).alias("key"), "at"
    )
    parents = sections.where("parent_id is not null and parent_id != ''").select(
        F.lit("parent").alias("kind"), F.col("section_row").alias("record_id"), F.lit(0).alias("pos"), F.col("parent_id").alias("key"), F.col("loaded_at").alias("at")
    )
    return reduce(DataFrame.unionByName, (links, images, parents))


def wiki_targets(notes: DataFrame, images: DataFrame, sections: DataFrame) -> DataFrame:
    """What those references may point to, with life spans."""
    a = notes.select(F.lit("link").alias("kind"), F.col("path").alias("key"), F.col("created_at").alias("starts"), F.col("deleted_at").alias("ends"))
    b = images.select(F.lit("image").alias("kind"), F.col("path").alias("key"), F.col("created_at").alias("starts"), F.col("deleted_at").alias("ends"))
    c = sections.select(F.lit("parent").alias("kind"), F.col("section_id").alias("key"), F.col("loaded_at").alias("starts"), F.col("removed_at").alias("ends"))
    return reduce(DataFrame.unionByName, (a, b, c))
