"""Continuous periods and gaps of overlapping integer intervals, by hierarchical run bitmaps.

An interval [a, b] of exact units (pages, seconds, days) is never expanded to its units. It becomes at most two
64-bit masks on each of three levels: level 0 has one bit a unit, level 1 one bit for 64 full units, level 2 one
bit for 4,096; one level-2 word spans a shard of 262,144 units, and an interval longer than a shard adds one full
word for each shard it covers. Equal words of an entity are united with ``bit_or``, which combines before the
shuffle, so a hot entity or a repeated row costs one word. The set runs of the united words are merged inside each
(entity, shard); only what touches a shard's edge, two rows a shard at most, is stitched per entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 3
SHARD_BITS = 6 * LEVELS


def _decompose(df: DataFrame) -> DataFrame:
    """(entity, lo, hi) -> (entity, level, word, mask), with ``lo <= hi`` both long.

    On level k an interval covers the full blocks ``l_k .. h_k`` of 64**k units. What level k+1 does not cover of
    them is a head and a tail, each inside one word; the top level takes one word a shard.
    """
    ends = {"l0": "lo", "h0": "hi"}
    for k in range(1, LEVELS):
        ends |= {f"l{k}": f"shiftright(lo + {64**k - 1}, {6 * k})", f"h{k}": f"shiftright(hi + 1, {6 * k}) - 1"}
    df = df.select("entity", *(F.expr(x).alias(n) for n, x in ends.items()))
    ranges = []
    for k in range(LEVELS - 1):
        low, high, nl, nh = f"l{k}", f"h{k}", f"l{k + 1}", f"h{k + 1}"
        head = f"case when {nl} <= {nh} then 64 * {nl} - 1 else least({high}, {low} | 63) end"
        tail = f"case when {nl} <= {nh} then 64 * ({nh} + 1) when shiftright({low}, 6) < shiftright({high}, 6) then {high} & ~63L else {high} + 1 end"
        ranges.append(f"named_struct('level', {k}, 'x', {low}, 'y', {head})")
        ranges.append(f"named_struct('level', {k}, 'x', {tail}, 'y', {high})")
    top = LEVELS - 1
    words = f"sequence(shiftright(l{top}, 6), shiftright(h{top}, 6))"
    whole = f"transform({words}, w -> named_struct('level', {top}, 'x', greatest(l{top}, w * 64), 'y', least(h{top}, w * 64 + 63)))"
    pieces = f"concat(array({', '.join(ranges)}), case when l{top} <= h{top} then {whole} else array() end)"
    out = df.select("entity", F.explode(F.expr(pieces)).alias("p")).where("p.x <= p.y").select("entity", "p.*")
    mask = "shiftleft(-1L, cast(x & 63 as int)) & shiftrightunsigned(-1L, cast(63 - (y & 63) as int))"
    return out.select("entity", "level", F.expr("shiftright(x, 6)").alias("word"), F.expr(mask).alias("mask"))


def _runs(words: DataFrame) -> DataFrame:
    """United words -> (entity, lo, hi) runs of set bits in units."""
    bits = "case when {m} = 0 then cast(array() as array<int>) else filter(sequence(0, 63), i -> (shiftrightunsigned({m}, i) & 1L) = 1L) end"
    w = words.withColumn("s", F.expr("mask & ~shiftleft(mask, 1)")).withColumn("e", F.expr("mask & ~shiftrightunsigned(mask, 1)"))
    z = w.select("entity", "level", "word", F.explode(F.expr(f"case when mask = -1L then array(named_struct('a', 0, 'z', 63)) else transform(arrays_zip({bits.format(m='s')}, {bits.format(m='e')}), x -> named_struct('a', x['0'], 'z', x['1'])) end")).alias("r"))
    return z.select(
        "entity",
        F.expr("shiftleft(shiftleft(word, 6) + r.a, 6 * level)").alias("lo"),
        F.expr("shiftleft(shiftleft(word, 6) + r.z + 1, 6 * level) - 1").alias("hi"),
    )


def periods_and_gaps(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """(entity, kind, unit_from, unit_to): maximal covered periods and the gaps between neighbouring periods.

    Both ends are inclusive integers. Rows whose entity or either end is null, or whose end lies before its start,
    count for nothing; repeated, nested and adjacent intervals merge; an entity with one period has no gap; an
    empty table gives an empty result. Other columns of ``df`` are not read and may have any name.
    """
    rows = df.select(df[entity].alias("entity"), df[start].cast("long").alias("lo"), df[end].cast("long").alias("hi"))
    rows = rows.where("entity is not null and lo is not null and hi is not null and lo <= hi")
    words = _decompose(rows).groupBy("entity", "level", "word").agg(F.expr("bit_or(mask)").alias("mask"))
    runs = _runs(words).withColumn("shard", F.shiftright("lo", SHARD_BITS))

    in_shard = Window.partitionBy("entity", "shard").orderBy("lo", "hi")
    before = in_shard.rowsBetween(Window.unboundedPreceding, -1)
    isl = runs.withColumn("reach", F.max("hi").over(before))
    isl = isl.withColumn("island", F.sum(F.when(F.col("reach").isNull() | (F.col("lo") > F.col("reach") + 1), 1).otherwise(0)).over(in_shard))
    isl = isl.groupBy("entity", "shard", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    # neighbours inside the shard, and of the whole shard through its summary row
    summary = isl.groupBy("entity", "shard").agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    per_entity = Window.partitionBy("entity").orderBy("shard")
    summary = summary.select("entity", "shard", F.lag("last").over(per_entity).alias("prev_last"), F.lead("first").over(per_entity).alias("next_first"))
    w = Window.partitionBy("entity", "shard").orderBy("lo")
    isl = isl.withColumn("p", F.lag("hi").over(w)).withColumn("n", F.lead("lo").over(w)).join(summary, ["entity", "shard"])
    isl = isl.select("entity", "lo", "hi", F.coalesce("p", "prev_last").alias("p"), F.coalesce("n", "next_first").alias("n"))
    isl = isl.withColumn("cut_l", F.coalesce(F.col("p") + 1 == F.col("lo"), F.lit(False))).withColumn("cut_r", F.coalesce(F.col("hi") + 1 == F.col("n"), F.lit(False)))

    own = F.when(~F.col("cut_l") & ~F.col("cut_r"), F.struct(F.lit("period").alias("kind"), F.col("lo").alias("unit_from"), F.col("hi").alias("unit_to")))
    gap = F.when(F.col("n") > F.col("hi") + 1, F.struct(F.lit("gap").alias("kind"), (F.col("hi") + 1).alias("unit_from"), (F.col("n") - 1).alias("unit_to")))
    inner = isl.select("entity", F.explode(F.array(own, gap)).alias("x")).where("x is not null").select("entity", "x.*")
    chain = isl.where("cut_l or cut_r").withColumn("g", F.sum(F.when(F.col("cut_l"), 0).otherwise(1)).over(Window.partitionBy("entity").orderBy("lo")))
    chained = chain.groupBy("entity", "g").agg(F.min("lo").alias("unit_from"), F.max("hi").alias("unit_to")).select("entity", F.lit("period").alias("kind"), "unit_from", "unit_to")
    return inner.unionByName(chained)


def page_periods(sections: DataFrame) -> DataFrame:
    """The page periods and page gaps of every book: (source_id, kind, page_from, page_to)."""
    out = periods_and_gaps(sections, "source_id", "pdf_page_start", "pdf_page_end")
    return out.select(F.col("entity").alias("source_id"), "kind", F.col("unit_from").cast("int").alias("page_from"), F.col("unit_to").cast("int").alias("page_to"))
