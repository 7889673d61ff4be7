"""Splitting by headings against a plain reading of the rules, and the single steps against brute force."""

import random
import threading

from pyspark.sql import functions as F

from quire.operators import splitting as sp

DOCS = "source_id string, doc bigint, text string"
SECTIONS = "source_id string, section_id string, ord int, title string, page int, page_end int"


def _split(spark, text, sections, depth=3):
    docs = spark.createDataFrame([("b", k, t) for k, t in enumerate(text if isinstance(text, list) else [text])], DOCS)
    s = spark.createDataFrame([("b", i, k, t, a, z) for k, (i, t, a, z) in enumerate(sections)], SECTIONS)
    return {r.section_id: (r.tier, r.text) for r in sp.split_by_headings(docs, s, depth).collect()}


def test_unclaimed_headings_are_absorbed(spark):
    md = ["intro\n# Weapons\nSwords.\n\n## Ranged Chart\n| a |\n\n## Melee Chart", "more of it\n# Next Section\nOther."]
    got = _split(spark, md, [("w", "Weapons", 0, 1), ("n", "Next section:", 2, 3)])
    assert got == {"w": ("exact", "# Weapons\nSwords.\n\n## Ranged Chart\n| a |\n\n## Melee Chart\nmore of it"), "n": ("exact", "# Next Section\nOther.")}


def test_depth(spark):
    md = "# A\na\n## B\nb\n### C\nc\n#### D\nd\n##### E\ne\n###### F\nf"
    assert _split(spark, md, [("a", "A", 0, 0)])["a"][1].endswith("#### D\nd")
    assert _split(spark, md, [("a", "A", 0, 0)], depth=1)["a"][1].endswith("## B\nb")


def test_tiers_and_pages(spark):
    md = '<span id="page-0-0"></span>\n# The Silver Tower of Omens\nx\n# Silver\nlast\n<span id="page-3-0"></span>\n# Herald of the pale rival gate\ny\n# Herald of the pale rival gate\nz\n<span id="page-5-0"></span>\nplain'
    got = _split(spark, md, [("c", "Silver Tower of Omens", 0, 0), ("f", "Pale herald and gate of rivals", 3, 3), ("p", "Quite other", 3, 4), ("q", "Nothing", 9, 9), ("n", None, 9, 9)])
    assert {k: v[0] for k, v in got.items()} == {"c": "contained", "f": "fuzzy", "p": "page", "q": None, "n": None}
    assert got["f"][1].startswith("# Herald") and got["f"][1].count("# Herald") == 2
    assert got["p"][1].startswith("# Herald") is False or "y" in got["p"][1]


def test_pairs_of_titles_against_brute_force(spark):
    rnd = random.Random(3)
    vocab = ["the", "omen", "tower", "of", "ax", "silver", "a", "gate", "pale", "chapter", "3", "rival", "io"]
    titles = sorted({" ".join(rnd.sample(vocab, rnd.randrange(1, 5))) for _ in range(120)})
    left, right = titles[::2], titles[1::2]
    df = lambda t: spark.createDataFrame([("b", x) for x in t], "source_id string, key string")
    keep = lambda a, b: min(len(a), len(b)) / max(len(a), len(b)) * 80 >= sp.CONTAINED
    got = {(r.a, r.b) for r in sp.contained_titles(df(left), df(right)).collect() if keep(r.a, r.b)}
    assert got == {(a, b) for a in left for b in right if (a in b or b in a) and keep(a, b)} and got
    cross = df(left).select(F.col("key").alias("a")).crossJoin(df(right).select(F.col("key").alias("b")))
    score = F.greatest(sp.jaccard(F.col("a"), F.col("b")), sp.jaccard(sp.strip_affixes(F.col("a")), sp.strip_affixes(F.col("b"))))
    want = {(r.a, r.b, r.s) for r in cross.select("a", "b", score.alias("s")).where(F.col("s") >= sp.LIKE).collect()}
    assert {(r.a, r.b, r.score) for r in sp.similar_titles(df(left), df(right)).collect()} == want and want


def test_headings_are_claimed_once(spark):
    heads = [("b", h, f"omen tower gate {x}") for h, x in enumerate(("red", "blue", "green"), 1)]
    h = spark.createDataFrame([(s, i, k, 0) for s, i, k in heads], "source_id string, h int, key string, page int")
    s = spark.createDataFrame([("b", f"s{k}", k, f"omen tower gate {x}", 0) for k, x in enumerate(("x", "y", "z", "w"))], "source_id string, section_id string, ord int, key string, page int")
    none = spark.createDataFrame([], "source_id string, section_id string, h int")
    assert {(r.section_id, r.h) for r in sp.fuzzy_matches(s, h, none).collect()} == {("s0", 1), ("s1", 2), ("s2", 3)}


def test_titles_that_share_common_words_only_are_no_candidates(spark):
    """8,000 titles a side, each of the form "the ... of ...": 64 million pairs share two words, 8,000 are similar."""
    df = lambda x: spark.range(8000).select(F.lit("b").alias("source_id"), F.format_string(f"the k%1$d of w%1$d{x}", "id").alias("key"))
    stop = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        rows = sp.similar_titles(df("x"), df("y"), 0.5).agg(F.count("*"), F.min("score"), F.max("score"), F.count_distinct("a"), F.count_distinct("b")).first()
    finally:
        stop.cancel()
    assert tuple(rows) == (8000, 0.6, 0.6, 8000, 8000)


def test_similar_titles_of_any_length_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{k}" for k in range(12)] + ["the", "chapter", "3", "continued"]
    left, right = ([" ".join(rnd.choices(vocab, k=rnd.choice((1, 2, 3, 4, 5, 6, 7, 9, 12)))) for _ in range(150)] for _ in range(2))
    df = lambda t: spark.createDataFrame([("b", x) for x in t], "source_id string, key string")
    score = F.greatest(sp.jaccard(F.col("a"), F.col("b")), sp.jaccard(sp.strip_affixes(F.col("a")), sp.strip_affixes(F.col("b"))))
    cross = df(left).distinct().select(F.col("key").alias("a")).crossJoin(df(right).distinct().select(F.col("key").alias("b"))).select("a", "b", score.alias("s"))
    want = sorted((r.a, r.b, r.s) for r in cross.where("s >= 0.3").collect())
    for least in (0.3, 0.5, 0.7):
        assert sorted((r.a, r.b, r.score) for r in sp.similar_titles(df(left), df(right), least).collect()) == [x for x in want if x[2] >= least]


def test_far_headings_are_claimed_without_pairs_of_common_words(spark):
    """64 million pairs of a section and a heading share "the" and "of", of which no page is near; 8,000 are similar enough."""
    ids = spark.range(8000).withColumn("source_id", F.lit("b"))
    key = lambda x: F.format_string(f"the k%1$d of w%1$d{x}", "id").alias("key")
    s = ids.select("source_id", F.col("id").cast("string").alias("section_id"), F.col("id").cast("int").alias("ord"), key("x"), F.lit(0).alias("page"))
    h = ids.select("source_id", F.col("id").cast("int").alias("h"), key("y"), F.lit(None).cast("int").alias("page"))
    none = spark.createDataFrame([], "source_id string, section_id string, h int")
    stop = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        rows = sp.fuzzy_matches(s, h, none).agg(F.count("*"), F.sum((F.col("section_id") == F.col("h")).cast("int"))).first()
    finally:
        stop.cancel()
    assert tuple(rows) == (8000, 8000)
