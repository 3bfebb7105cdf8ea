"""Contexts of gaps, small maps tried for them, and the maps filled with them."""

import numpy as np
from pyspark.sql import functions as F

from cartolux.functions import aligner as A
from cartolux.operators import align
from cartolux.operators import maps as M
from cartolux.plans import align_queries
from cartolux.plans import inputs as I

TRUE = np.cumsum(np.random.default_rng(4).integers(2000, 20000, 70)).astype(float)
HIDDEN = range(30, 40)


def _long(p):
    return [int(x) for x in np.round(p)]


def _fillers(spark, host, small):
    gap = int(np.flatnonzero(np.diff(host) == np.diff(host).max())[0])
    lo, hi = int(host[gap]), int(host[gap + 1])
    contexts = spark.createDataFrame([(1, lo, hi, _long(host[max(gap - 28, 0) : gap + 30]))], "map_id long, lo long, hi long, context array<long>")
    return align.gap_fillers(contexts, spark.createDataFrame([(9, _long(small))], "map_id long, positions array<long>")), lo, hi


def test_a_bridge_of_two_thirds_of_the_gap_is_tried(spark):
    # The gap is stated half as wide again; flanks of three labels leave the small map shorter than 0.75 of it.
    true = np.concatenate([np.arange(30) * 5000.0 + np.arange(30) ** 2 * 60, [0.0] * 40])
    true[30:] = true[29] + 200_000 + np.arange(40) * 4000.0 + np.arange(40) ** 2 * 50
    host = np.concatenate([true[:30], true[30:] + 110_000])
    small = np.concatenate([true[27:30], true[29] + np.arange(1, 8) * 25_000.0, true[30:33]]) - true[27]
    assert 0.6 * 310_000 <= small[-1] < 0.75 * 310_000
    got, lo, hi = _fillers(spark, host, small)
    assert hi - lo == 310_000 and [(r.small_id, round(r.shift)) for r in got.collect()] == [(9, -110_000)]


def test_contexts_end_at_the_next_gap_and_need_three_labels_a_side(spark):
    def contexts(p, at):
        rows = [("A", 1, int(x)) for x in p]
        gaps = spark.createDataFrame([("A", 1, int(p[at - 1]), int(p[at]), 618.0)], "map_set string, map_id long, lo long, hi long, stop double")
        return [r.context for r in align.gap_contexts(gaps, spark.createDataFrame(rows, "map_set string, map_id long, pos long")).collect()]

    d = np.full(80, 100)
    d[39] = 1000
    whole = np.cumsum(d)
    assert contexts(whole, 39) == [whole[10:68].tolist()]
    d[[30, 45]] = 618
    p = np.cumsum(d)
    assert contexts(p, 39) == [p[30:45].tolist()]
    d[37] = 618
    assert contexts(np.cumsum(d), 39) == []


def test_filled_maps_carry_the_shifts_of_all_gaps_before(spark):
    labels = spark.createDataFrame([(1, x) for x in (10, 20, 100, 110, 300, 310)] + [(2, 5)], "map_id long, pos long")
    fillers = spark.createDataFrame([(1, 20, 100, 7, 6, 1.0, 30.0, [60]), (1, 110, 300, 8, 6, 1.0, -20.4, [150, 200])], "map_id long, lo long, hi long, small_id long, n_pairs int, score double, shift double, inner array<long>")
    got = [(r.site_id, r.pos, r.small_id) for r in align.filled_maps(labels, fillers).orderBy("site_id").collect()]
    assert got == list(zip(range(1, 10), (10, 20, 60, 130, 140, 180, 230, 310, 320), (None, None, 7, None, None, 8, 8, None, None)))


def _generated(seed, smalls):
    rng = np.random.default_rng(seed)
    maps = [np.cumsum(rng.integers(3, 200, n) * 10).astype(float) for n in rng.integers(1, 60, smalls)]
    hosts = []
    for n in rng.integers(10, 50, 6):
        d, gap = rng.integers(3, 200, n) * 10, int(rng.integers(3, n - 3))
        d[gap] = rng.integers(600, 3000) * 10
        hosts.append((np.cumsum(d).astype(float), gap))
    return maps, hosts


def test_scores_over_a_gap_are_those_of_the_aligner():
    maps, hosts = _generated(3, 40)
    sides = A.Block(maps), A.Block([A.reversed_positions(p) for p in maps])
    for host, gap in hosts:
        assert A.gap_scores(host, gap, *sides).tolist() == [A.align_both(p, host, gap=gap).score for p in maps]


def test_fillers_are_the_best_of_all_small_maps_and_few_are_traced(spark, monkeypatch):
    maps, hosts = _generated(5, 60)
    maps += maps[:20]  # ties go to the smaller id
    gaps = [(1000 + i, int(h[g - 1]), int(h[g]), h, g) for i, (h, g) in enumerate(hosts)]
    want = []
    for host, lo, hi, h, gap in gaps:
        every = [(a.score, int(p[0] - p[-1]), -i, len(a.pairs)) for i, p in enumerate(maps) if p[-1] - p[0] >= 0.6 * (hi - lo) - 1e-3 and (a := A.fills(p, h, gap))]
        want += [(host, lo, hi, -max(every)[2], max(every)[3], max(every)[0])] if every else []
    contexts = spark.createDataFrame([(host, lo, hi, _long(h)) for host, lo, hi, h, _ in gaps], "map_id long, lo long, hi long, context array<long>")
    smalls = spark.createDataFrame([(i, _long(p)) for i, p in enumerate(maps)], "map_id long, positions array<long>")
    got = align.gap_fillers(contexts, smalls).orderBy("map_id").collect()
    assert want and [(r.map_id, r.lo, r.hi, r.small_id, r.n_pairs, r.score) for r in got] == want

    traced, fills = [], A.fills
    monkeypatch.setattr(A, "fills", lambda *x: traced.append(1) or fills(*x))
    align._filled(contexts.toPandas(), smalls.withColumnRenamed("map_id", "small_id").toPandas())
    assert 0 < len(traced) < len(maps)


def test_filled_maps_read_the_labels_once(spark, monkeypatch):
    calls, labels = [], I.labels
    monkeypatch.setattr(I, "labels", lambda *x: calls.append(1) or labels(*x))
    align_queries.x14_filled_maps(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1


def test_contexts_found_in_arrays_are_those_of_the_gaps(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(12):
        d = rng.integers(30, 200, int(rng.integers(40, 90)))
        d[rng.integers(2, len(d) - 2, 3)] = rng.choice([700, 1200, 3000], 3)
        rows += [(f"S{i % 2}", i // 2, k, 1, int(x)) for k, x in enumerate(np.cumsum(d))]
    rows += [(s, i, k + 1000, 2, x) for s, i, k, _, x in rows[::7]]  # two labels at one place
    labels = spark.createDataFrame(rows, "map_set string, map_id long, site_id int, channel int, pos long")
    mean = spark.createDataFrame([("S0", 100.0), ("S1", 115.5)], "map_set string, mean_distance double")
    gap, stop = 10 * F.col("mean_distance"), 0.618 * 10 * F.col("mean_distance")
    gaps = M.internal_gaps(labels, mean, 10, 51).distinct().join(mean, "map_set").withColumn("stop", stop)
    key = lambda df: sorted((r.map_id, r.lo, r.hi, tuple(r.context)) for r in df.collect())
    want = key(align.gap_contexts(gaps, labels))
    assert want and key(align.gaps_in_context(align.map_arrays(labels).join(mean, "map_set"), gap, stop, 51)) == want


def test_arrays_of_labels_need_one_shuffle_of_the_labels(spark):
    d = "/root/testdata/sf0.001"
    got = align.map_arrays(I.labels(spark, d, align.MAP))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Union")[0].count("Exchange") == 1
    assert got.select("map_set", "map_id", "n", F.explode("positions").alias("pos")).exceptAll(align.map_arrays(I.labels(spark, d)).select("map_set", "map_id", "n", F.explode("positions").alias("pos"))).count() == 0


def test_distances_over_a_gap_take_as_many_passes_as_labels_agree():
    p = np.cumsum(np.full(400, 10.0))
    block = A.Block([p, p[:50], p[:1]])
    got = list(block.over(1000.0))
    assert len(got) <= 110  # of the 399 labels back, those 60 to 167 back agree
    assert sorted((int(j), int(b), float(r)) for js, bs, rs in got for j, b, r in zip(js, bs, rs) if 0.6 <= r / 1000 <= 1 / 0.6) == [(j, b, b * 10.0) for j in range(400) for b in range(60, min(j, 166) + 1)]
