"""Micro-fixtures computed by hand, and brute force where SQL has no form."""

import random

import pytest

from cartolux.functions import aligner as A
from cartolux.functions import sequence as S
from cartolux.operators import align, evidence, export, graph, hits, maps, prefix, ranges

HIT = "entry_id long, aln_set string, qry_id long, ref_id long, qs long, qe long, rs long, re long, ori string, conf long, ql long, rl long, channel int, cigar string, pairs string"


def hit(spark, *given):
    base = dict(entry_id=1, aln_set="s", qry_id=1, ref_id=1, qs=1, qe=10, rs=1, re=10, ori="+", conf=1, ql=10, rl=100, channel=1, cigar="1M", pairs="(1,1)")
    return spark.createDataFrame([tuple((base | g).values()) for g in given], HIT)


def test_switched_roles(spark):
    h = hit(spark, dict(qs=90, qe=10, rs=100, re=180, ori="-", cigar="2M1D3M1I", pairs="(1,9)(2,8)", qry_id=5, ref_id=6))
    r = hits.switched(h).first()
    assert (r.qry_id, r.ref_id, r.qs, r.qe, r.rs, r.re, r.pairs, r.cigar) == (6, 5, 180, 100, 10, 90, "(8,2)(9,1)", "1D3M1I2M")
    assert hits.switched(hits.switched(h)).first() == h.first()


def test_nx(spark):
    df = spark.createDataFrame([("a", x) for x in (10, 8, 5, 3, 2)] + [("b", 7)], "k string, len long")
    for block in (2, 1 << 20):
        got = {r.k: (r.n50, r.n90) for r in prefix.nx(df, ["k"], "len", {"n50": 0.5, "n90": 0.9}, block).collect()}
        assert got == {"a": (8, 3), "b": (7, 7)}
        assert {r.k: r["median"] for r in prefix.median(df, ["k"], "len", block=block).collect()} == {"a": 5.0, "b": 7.0}


def test_prefix_sum_over_blocks(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", None]), i, rng.randrange(9)) for i in rng.sample(range(-500, 500), 300)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.up for r in prefix.prefix_sum(df, ["k"], "o", "v", "up", 37).collect()}
    assert got == {(k, o): sum(v for k2, o2, v in rows if k2 == k and o2 <= o) for k, o, _ in rows}


def test_outermost_and_best(spark):
    h = hit(spark, dict(entry_id=1, rs=1, re=50), dict(entry_id=2, rs=2, re=40), dict(entry_id=3, rs=45, re=60, conf=9), dict(entry_id=4, rs=45, re=50, conf=9))
    assert sorted(r.entry_id for r in hits.outermost(h, ["ref_id"]).collect()) == [1, 3]
    assert hits.best_per_query(h, ["qry_id"]).first().entry_id == 3
    assert sorted(r.new_id for r in hits.renumbered(h, [h.rs, h.entry_id]).collect()) == [1, 2, 3, 4]


def test_translation_is_undone(spark):
    lengths = spark.createDataFrame([(5, 1000), (6, 50)], "map_id long, len long")
    cuts = spark.createDataFrame([(5, 400), (5, 400), (5, 700), (6, 999)], "map_id long, at long")
    seg = maps.fragments(cuts, lengths, 1, 2, 100)
    assert sorted(tuple(r)[:4] for r in seg.collect()) == [(5, 0, 400, 105), (5, 401, 700, 305), (5, 701, 999, 505), (6, 0, 49, 6)]
    assert maps.invalid_segments(seg).count() == 0
    back = hits.translated(hit(spark, dict(qry_id=305, qs=9, qe=20), dict(qry_id=77, qs=9, qe=20, ql=33)), seg)
    assert sorted((r.qry_id, r.qs, r.qe, r.ql) for r in back.collect()) == [(5, 410, 421, 1000), (77, 9, 20, 33)]
    labels = spark.createDataFrame([("m", 5, i, 1, p) for i, p in enumerate((100, 400, 401, 402, 999), 1)], "map_set string, map_id long, site_id int, channel int, pos long")
    got = sorted((r.new_id, r.pos) for r in maps.cut(labels, seg, 64).collect())
    assert got == [(105, 100), (105, 400), (305, 1), (505, 298)]


def test_conflict_cases(spark):
    df = spark.createDataFrame([(r, q, s) for r in (True, False) for q in (True, False) for s in ("okay", "cut")], "r boolean, q boolean, s string")
    from pyspark.sql import functions as F

    ref, qry = maps.settled(F.col("r"), F.col("q"), F.lit("was"), F.col("s"))
    got = {(x.r, x.q, x.s): (x.a, x.b) for x in df.select("r", "q", "s", ref.alias("a"), qry.alias("b")).collect()}
    assert got == {
        (True, True, "okay"): ("okay", "okay"), (True, True, "cut"): ("okay", "okay"), (False, True, "okay"): ("cut", "okay"), (False, True, "cut"): ("okay", "okay"),
        (True, False, "okay"): ("okay", "okay"), (True, False, "cut"): ("okay", "cut"), (False, False, "okay"): ("was", "okay"), (False, False, "cut"): ("was", "cut"),
    }


def test_overlaps_against_brute_force(spark):
    rng = random.Random(5)
    span = lambda: (lambda a: (a, a + rng.randrange(60)))(rng.randrange(300))
    a, b = [(1, *span()) for _ in range(60)], [(1, *span()) for _ in range(60)]
    left, right = spark.createDataFrame(a, "k long, lo long, hi long").distinct(), spark.createDataFrame(b, "k long, lo2 long, hi2 long").distinct()
    got = sorted(tuple(r) for r in ranges.overlaps(left, right, ["k"], 16, 5).select("lo", "hi", "lo2", "hi2").collect())
    assert got == sorted((x[1], x[2], y[1], y[2]) for x in set(a) for y in set(b) if min(x[2], y[2]) - max(x[1], y[1]) + 1 >= 5)


def kruskal(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    out = []
    for a, b, w, *_ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            out.append((a, b, w))
    return sorted(out)


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_forest_and_layout(spark, shape):
    rng = random.Random(7)
    n = 60
    pairs = {"random": [(rng.randrange(n), rng.randrange(n)) for _ in range(90)], "chain": [(i + 1, i) for i in range(n)], "star": [(0, i) for i in range(1, n)]}[shape]
    true = {i: (rng.choice([1, -1]), rng.randrange(10_000)) for i in range(n + 2)}  # node -> map to a common axis

    def edge(a, b):
        (sa, ta), (sb, tb) = true[a], true[b]
        return a, b, rng.randrange(5), sa * sb, sb * (ta - tb)

    edges = list({(min(p), max(p)): edge(*p) for p in pairs if p[0] != p[1]}.values())
    df = spark.createDataFrame(edges + edges[:3] + [(4, 4, 9, 1, 1)], "a long, b long, weight long, sign int, shift long")
    forest, at = graph.spanning_layout(df)
    want = kruskal([(min(a, b), max(a, b), w) for a, b, w, *_ in edges])
    assert sorted(tuple(r) for r in forest.select("a", "b", "weight").collect()) == want
    for r in at.collect():
        (sn, tn), (sr, tr) = true[r.node], true[r.root]
        assert (r.sign, r.shift) == (sn * sr, sr * (tn - tr))
    assert graph.spanning_layout(df.limit(0))[1].count() == 0


def test_layout_starts_at_zero(spark):
    e = spark.createDataFrame([(1, 2, 5, 1, -100), (2, 3, 4, -1, 50)], "a long, b long, weight long, sign int, shift long")
    got = sorted(tuple(r) for r in graph.layout(e, spark.createDataFrame([(1, 80), (2, 90)], "node long, len long")).collect())
    assert got == [(1, 1, "+", 0, 80), (1, 2, "+", 100, 190), (1, 3, "-", 150, 150)]


def test_trimmed_evidence(spark):
    from math import ceil, sqrt

    rng = random.Random(4)
    rows = [(i, 1, rng.choice([2, 3]), "5", "3", rng.choice([100, 110, 120, 90, 5000])) for i in range(80)] + [(900 + i, 7, 8, "5", "5", d) for i, d in enumerate((1, 2, 90000))]
    df = spark.createDataFrame(rows, "no long, ctg1 long, ctg2 long, end1 string, end2 string, distance long")
    want = set()
    for key in {r[1:5] for r in rows}:
        g = [r for r in rows if r[1:5] == key]

        def stat(x):
            m = sum(r[5] for r in x) / len(x)
            return m, sqrt(sum((r[5] - m) ** 2 for r in x) / len(x))

        m, s = stat(g)
        off = lambda r: abs(r[5] - m)
        if len(g) > 3:
            edge = sorted(map(off, g))[len(g) - ceil(len(g) * 0.1) - 1]
            g = [r for r in g if off(r) <= edge + 1e-3 or off(r) < 1.2 * s]
        m2, s2 = stat(g)
        want |= {r[0] for r in g} if m2 > -3000 and s2 < 10000 else set()
    assert {r.no for r in evidence.trimmed(df, evidence.LINK).collect()} == want


def test_sequences(spark):
    assert S.occurrences("CCTCAGCCTCAGC", "CCTCAGC") == [1, 7]
    assert S.sites("aacttaagttCTTAAG", {1: ["CTTAAG"]}) == [(3, 1), (11, 1)]
    assert S.reverse_complement("ACGTNacgt") == "acgtNACGT"
    rng = random.Random(6)
    seqs = [(i, "".join(rng.choices("ACGT", k=n))) for i, n in enumerate((0, 5, 63, 64, 65, 700))]
    df = spark.createDataFrame(seqs, "seq_id long, seq string")
    motifs = {1: ["CACG"], 2: ["GAT", "CTT"]}
    got = sorted(tuple(r) for r in S.digested(df, motifs, 64).collect())
    assert got == sorted((i, at, c) for i, s in seqs for at, c in S.sites(s, motifs))
    turned = S.sites(S.reverse_complement(seqs[5][1]), {1: ["CACG"]})
    assert sorted(700 - at - 2 for at, _ in turned) == [at for at, _ in S.sites(seqs[5][1], {1: ["CACG"]})]
    gaps = spark.createDataFrame([(1, "NNACNNNNnA"), (2, "")], "seq_id long, seq string")
    assert [tuple(r) for r in S.n_gaps(gaps, 3).collect()] == [(1, 4, 9)]


def test_agp_and_gaps(spark):
    h = hit(
        spark, dict(entry_id=1, qry_id=11, rs=100, re=200, qs=1, qe=101, ql=101), dict(entry_id=2, qry_id=12, rs=210, re=300, qs=91, qe=1, ql=91, ori="-"),
        dict(entry_id=3, qry_id=13, rs=220, re=240, qs=1, qe=21, ql=21), dict(entry_id=4, qry_id=14, rs=400, re=450, qs=11, qe=61, ql=61),
    )
    gaps = export.scaffold_gaps(h)
    got = {r.entry_id: (r.prev_qry, r.gap, r.adjusted_gap, r.embedded) for r in gaps.collect()}
    assert got == {1: (None, None, None, False), 2: (11, 9, 9, False), 3: (12, -81, -81, True), 4: (12, 99, 89, False)}
    names = spark.createDataFrame([(11, "c11")], "id long, name string")
    rows = sorted((r.part, r.object_beg, r.object_end, r.kind, r.component) for r in export.agp(h, gaps, names).collect())
    assert rows == [(1, 1, 101, "W", "c11"), (2, 102, 124, "N", "23"), (3, 125, 215, "W", "12"), (4, 216, 304, "N", "89"), (5, 305, 365, "W", "14")]
    report = export.gap_report(gaps, h, names)
    assert report.count() == 4 and report.filter("name1 = name2").first().name1 == "14"
    seqs = spark.createDataFrame([("c11", "ACGTT"), ("12", "AAC")], "name string, seq string")
    pieces = {r.part: r.piece for r in export.scaffold_sequences(export.agp(h, gaps, names), seqs).collect()}
    assert pieces[1] == "ACGTT" and pieces[2] == "N" * 23 and pieces[3] == "GTT"
    assert export.gap_sequence(8, [3, 7], "GAT") == "NNGATNNN"


def test_aligner():
    import numpy as np

    rng = np.random.default_rng(0)
    ref = np.cumsum(rng.integers(2000, 20000, 50)).astype(float)
    q = (ref[10:30] - ref[10]) * 1.01
    a = A.align_both(q, ref)
    assert a.pairs == [(i, i + 10) for i in range(20)] and not a.turned and a.confidence > 18
    t = A.align_both(A.reversed_positions(q), ref)
    assert t.turned and t.pairs == [(19 - i, i + 10) for i in range(20)]
    assert A.align_both(np.delete(q, 7), ref).passed == 1
    assert A.align(np.array([]), ref).pairs == [] and A.align(np.array([5.0]), ref).pairs == []
    assert A.align_whole(q, ref) and not A.align_whole(np.cumsum(rng.integers(2000, 20000, 20)).astype(float), ref)
    host = np.concatenate([ref[:20], ref[28:] - 900])
    f = A.fills(ref[12:36] - ref[12], host, 20)
    spliced, shift = A.spliced(host, ref[12:36] - ref[12], f, 20)
    assert shift == pytest.approx(900) and np.allclose(spliced, ref)
    assert A.fills(ref[12:18] - ref[12], host, 20) is None
    assert A.align_seeded(q, ref).pairs == a.pairs


def test_seeded_alignment_finds_every_piece(spark):
    rng = random.Random(8)
    refs = []
    for i in range(6):
        p, out = 0, []
        for _ in range(60):
            p += rng.randrange(2000, 20000)
            out.append(p)
        refs.append((100 + i, out))
    pieces = [(i, [round((x - r[5]) * 1.004) for x in r[5:30]]) for i, (_, r) in enumerate(refs)]
    turned = [(50 + i, [p[-1] - x for x in p[::-1]]) for i, p in pieces]
    q = spark.createDataFrame(pieces + turned + [(99, [5])], "map_id long, positions array<long>")
    r = spark.createDataFrame(refs, "map_id long, positions array<long>")
    got = {x.qry_id: (x.ref_id, x.ori, len(x.pairs)) for x in align.two_passes(q, r).collect()}
    assert got == {**{i: (100 + i, "+", 25) for i in range(6)}, **{50 + i: (100 + i, "-", 25) for i in range(6)}}
