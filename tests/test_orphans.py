import datetime as dt
import random

from quire.operators.orphans import orphan_references, orphans_by_period

T = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
KIDS = "kind string, record_id bigint, pos int, key string, at timestamp_ntz"
FOLK = "kind string, key string, starts timestamp_ntz, ends timestamp_ntz"


def brute(kids, folk):
    out = set()
    for kind, rid, pos, key, at in kids:
        if not key:
            continue
        rows = [(s, e) for k, x, s, e in folk if k == kind and x == key]
        began = [(s, e) for s, e in rows if s is not None and (at is None or s <= at)]
        alive = bool(began) if at is None else any(e is None or e > at for s, e in began)
        if not alive:
            out.add((kind, rid, pos, "missing" if not rows else "deleted" if began else "late"))
    return out


def run(spark, kids, folk, **kw):
    rows = orphan_references(spark.createDataFrame(kids, KIDS), spark.createDataFrame(folk, FOLK), **kw).collect()
    return {(r.kind, r.record_id, r.pos, r.state) for r in rows}, len(rows)


def test_random_with_a_hot_key(spark):
    rnd = random.Random(3)
    kids = [(rnd.choice("xy"), i, i % 3, rnd.choice(["hot", "hot", "a", "b", "c", "", None]), T(rnd.randrange(40)) if rnd.random() > 0.05 else None) for i in range(800)]
    folk = []
    for _ in range(40):
        s = rnd.randrange(40)
        folk.append((rnd.choice("xy"), rnd.choice(["hot", "a", "b", "d"]), T(s) if rnd.random() > 0.1 else None, T(s + rnd.randrange(15)) if rnd.random() > 0.3 else None))
    want = brute(kids, folk)
    assert run(spark, kids, folk) == (want, len(want))
    assert run(spark, kids, folk, hot_rows=50) == (want, len(want))  # the salted way gives the same


def test_boundaries(spark):
    folk = [("x", "k", T(1), T(5)), ("x", "k", T(1), T(5)), ("x", "m", T(9), None)]
    kids = [("x", 1, 0, "k", T(1)), ("x", 2, 0, "k", T(5)), ("x", 3, 0, "k", T(0)), ("x", 4, 0, "m", T(9)), ("x", 5, 0, "n", T(9)), ("y", 6, 0, "k", T(2))]
    assert run(spark, kids, folk)[0] == {("x", 2, 0, "deleted"), ("x", 3, 0, "late"), ("x", 5, 0, "missing"), ("y", 6, 0, "missing")}


def test_empty_sides_and_periods(spark):
    kids = [("x", 1, 0, "k", T(1)), ("x", 2, 0, "k", T(800))]
    assert run(spark, kids, []) == ({("x", 1, 0, "missing"), ("x", 2, 0, "missing")}, 2)
    assert run(spark, [], [("x", "k", T(1), None)]) == (set(), 0)
    o = orphan_references(spark.createDataFrame(kids, KIDS), spark.createDataFrame([], FOLK))
    assert {(r.period, r.n_refs) for r in orphans_by_period(o).collect()} == {(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 1)}
