"""Shapes that are hard for contraction, the order's mixing, and the shuffle without broadcasts."""

import random

from pyspark.sql import functions as F

from cartolux.llm import components as C


def groups_of(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_mixing_is_undone(spark):
    ids = [0, 1, -1, 2, 77, 1 << 40, -(1 << 62), (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([(i,) for i in ids], "x long").withColumn("y", F.col("x"))
    for turn in range(6):
        rows = C.mixed(df, "y", turn).collect()
        assert len({r.y for r in rows}) == len(ids)
        assert [r.x for r in C.unmixed(C.mixed(df, "y", turn), "y", turn).filter("x <> y").collect()] == []


def test_chain_star_and_pairs(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(3000)]  # one chain
    links += [(10_000, 10_001 + i) for i in range(14_000)]  # one vertex with most edges
    links += [(50_000 + 2 * i, 50_001 + 2 * i) for i in range(500)] + [(draw.randrange(60_000, 62_000), draw.randrange(60_000, 62_000)) for _ in range(1500)]
    draw.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.record_id: r.group_id for r in C.consolidated(spark.createDataFrame([(99_999,)], "id long"), df).collect()}
    assert got == {**groups_of(links), 99_999: 99_999}
