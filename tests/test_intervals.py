import random

from quire.operators.intervals import periods_and_gaps

SCHEMA = "e string, a bigint, b bigint, kind string"


def brute(rows):
    out = set()
    by = {}
    for e, a, b, _ in rows:
        if e is not None and a is not None and b is not None and a <= b:
            by.setdefault(e, []).append((a, b))
    for e, xs in by.items():
        merged = []
        for a, b in sorted(xs):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out |= {(e, "period", a, b) for a, b in merged}
        out |= {(e, "gap", x[1] + 1, y[0] - 1) for x, y in zip(merged, merged[1:])}
    return out


def run(spark, rows):
    got = [tuple(r) for r in periods_and_gaps(spark.createDataFrame(rows, SCHEMA), "e", "a", "b").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_random_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for e, reach, size in (("small", 300, 20), ("words", 5_000, 200), ("blocks", 80_000, 9_000), ("shards", 3_000_000, 400_000), ("hot", 40, 3)):
        for _ in range(60 if e != "hot" else 3_000):
            a = rnd.randrange(-reach, reach)
            rows.append((e, a, a + rnd.randrange(size), "x"))
    rows += [(e, 64 * k, 64 * k + 63, "x") for e, k in (("edge", 0), ("edge", 1), ("edge", 3), ("edge", 4096), ("edge", 4095))]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [("a", 1, 3, "x"), ("a", 4, 9, "x"), ("a", 20, 15, "x"), ("a", None, 5, "x"), ("a", 5, None, "x"), (None, 1, 2, "x"), ("a", 12, 12, "x"), ("a", 12, 12, "x"), ("b", 262143, 262144, "x"), ("b", 0, 0, "x")]
    assert run(spark, rows) == {("a", "period", 1, 9), ("a", "gap", 10, 11), ("a", "period", 12, 12), ("b", "period", 262143, 262144), ("b", "gap", 1, 262142), ("b", "period", 0, 0)}


def test_empty(spark):
    assert run(spark, []) == set()
