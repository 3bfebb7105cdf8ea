import random
from datetime import datetime

from cartolux.operators import intervals, orphans

MAPS = "CMapId long, ContigLength double, loaded_at timestamp, retired_at timestamp, side string"
HITS = "XmapEntryID long, QryContigID long, QryLen double, RefContigID long, RefLen double, aligned_at timestamp, key string"


def day(n):
    return datetime(2023, 1 + n // 28, 1 + n % 28)


def test_orphans(spark, rows):
    maps = spark.createDataFrame([
        (1, 100.0, day(1), None, "x"), (1, None, day(9), None, "x"), (2, float("nan"), day(1), day(40), "x"), (2, 50.0, day(1), None, "x"),
        (3, None, day(30), None, None), (None, 1.0, day(1), day(1), None),
    ], MAPS)
    hits = spark.createDataFrame([
        (1, 1, 100.9, 2, 50.0, day(10), "a"), (1, 1, 100.9, 2, 50.0, day(10), "a"), (2, 1, 101.1, 2, 50.0, day(40), None), (3, 9, 1.0, 3, 5.0, day(29), None),
        (4, None, 1.0, 3, 5.0, day(30), None), (5, 3, float("inf"), 2, None, day(41), None), (6, 8, 1.0, 1, 1.0, None, None), (7, 1, None, 1, float("nan"), day(0), None),
    ], HITS)
    got = rows(orphans.orphans(maps, hits))
    assert got == sorted([
        (2, "qry", "length", "2023-02"), (2, "ref", "deleted", "2023-02"), (3, "qry", "missing", "2023-02"), (3, "ref", "late", "2023-02"),
        (5, "ref", "deleted", "2023-02"), (6, "qry", "missing", None), (6, "ref", "length", None), (7, "qry", "late", "2023-01"), (7, "ref", "late", "2023-01"),
    ], key=str)
    counts = {tuple(r)[2:] for r in orphans.per_period(orphans.orphans(maps, hits)).collect()}
    assert ("ref", "deleted", "2023-02", 2) in counts
    assert orphans.orphans(maps.limit(0), hits).filter("reason <> 'missing'").count() == 0
    assert orphans.orphans(maps, hits.limit(0)).count() == 0


def brute(spans):
    out, groups = [], {}
    for k, a, b in spans:
        groups.setdefault(k, []).append((min(a, b), max(a, b)))
    for k, xs in groups.items():
        merged = []
        for lo, hi in sorted(xs):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        out += [(k, "period", a, b) for a, b in merged]
        out += [(k, "gap", p[1], q[0]) for p, q in zip(merged, merged[1:])]
    return sorted(out, key=str)


def test_sweep_against_brute_force(spark, rows):
    rng = random.Random(3)
    spans = [(rng.choice(["a", "b", None]), x, x + rng.choice([0, 0, 1, 5, 40])) for x in (rng.randrange(-300, 900) for _ in range(400))]
    df = spark.createDataFrame(spans, "k string, lo long, hi long")
    for block in (7, 64, 1 << 20):
        assert rows(intervals.sweep(df, ["k"], block)) == brute(spans)


def test_coverage_cases(spark, rows):
    h = spark.createDataFrame([
        ("s", 1, 10.0, 5.0, 9.0, 0), ("s", 1, 10.0, None, 2.0, 0), ("s", 1, 12.0, 13.0, None, 0), ("s", 1, 20.0, 20.0, None, 0), ("s", None, 1.0, 2.0, None, 0),
        ("s", 1, None, 2.0, 5.0, 0), ("s", 1, 50.0, None, None, 0), ("s", 1, 60.0, float("nan"), 1.0, 0), (None, 1, 1.0, 2.0, None, 0), ("s", 1, 10.0, 5.0, 9.0, 0),
    ], "aln_set string, RefContigID long, RefStartPos double, RefEndPos double, QryLen double, start int")
    assert rows(intervals.coverage(h)) == sorted([
        ("s", 1, "period", 50, 130), ("s", 1, "gap", 130, 200), ("s", 1, "period", 200, 200), ("s", 1, "gap", 200, 600), ("s", 1, "period", 600, 610), (None, 1, "period", 10, 20),
    ], key=str)
    assert intervals.coverage(h.limit(0)).count() == 0
