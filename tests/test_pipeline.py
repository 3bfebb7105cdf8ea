import random

from cartolux import __main__ as cli
from cartolux.functions import scalars
from cartolux.functions.sequence import ENZYMES
from cartolux.operators import align as A
from cartolux.operators import graph as G
from cartolux.plans import pipeline
from cartolux.sources import text as R
from pyspark.sql import functions as F


def genome(rng, n=60_000):
    seq = rng.choices("ACGT", k=n)
    at = 300
    while at < n - 300:
        seq[at : at + 6] = ENZYMES["BSSSI"]
        at += rng.randrange(250, 1500)
    return "".join(seq)


def test_scaffold_places_sequences_on_their_map(spark, tmp_path):
    rng = random.Random(11)
    g = genome(rng)
    from cartolux.functions.sequence import sites

    cuts = [(1, g[1000:21000]), (2, g[24000:44000]), (3, g[45000:59000])]
    seqs = spark.createDataFrame(cuts, "seq_id long, seq string")
    whole = spark.createDataFrame([(900, 1, at * 10) for at, _ in sites(g, {1: [ENZYMES["BSSSI"]]})], "map_id long, channel int, pos long")
    for expected in (["digest", "align", "layout", "merge", "report"], []):
        steps = []
        run = pipeline.Steps.run

        def spy(self, *a, run=run, steps=steps):
            out = run(self, *a)
            steps[:] = [*steps, *self.ran]
            self.ran.clear()
            return out

        pipeline.Steps.run = spy
        try:
            out = pipeline.scaffold(spark, f"file://{tmp_path}/run", seqs, whole, ["BSSSI"], "v1")
        finally:
            pipeline.Steps.run = run
        assert steps == expected
    spans = {r.node_id: (r.path_id, r.start, r.end) for r in out["layout"].collect()}
    assert {p for p, *_ in spans.values()} == {1} and set(spans) == {1, 2, 3, 900}
    ordered = sorted((s, n) for n, (_, s, _) in spans.items() if n != 900)
    assert [n for _, n in ordered] in ([1, 2, 3], [3, 2, 1])
    assert out["report"].first().n_paths == 1
    assert pipeline.ranked_paths(out["layout"]).first()["rank"] == 1


def test_merged_sets_keep_what_does_not_align(spark):
    rng = random.Random(12)
    pos = [0]
    for _ in range(40):
        pos.append(pos[-1] + rng.randrange(20_000, 200_000))
    a = spark.createDataFrame([(1, 1, p) for p in pos] + [(5, 1, 10), (5, 1, 99_000)], "map_id long, channel int, pos long")
    b = spark.createDataFrame([(2, 2, p - pos[10]) for p in pos[10:]], "map_id long, channel int, pos long")
    out = pipeline.merged_sets(a, b)
    paths = {r.node_id: r.path_id for r in out.select("path_id", "node_id").distinct().collect()}
    assert paths == {1: 1, 2: 1, 5: 5}
    at = {(r.node_id, r.pos) for r in out.collect()}
    assert (1, pos[10] + 200) in at and (2, pos[10] + 200) in at


def test_merged_sets_trace_the_forest_only_and_are_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    sets = []
    for ids in (range(1, 13), range(9, 21)):  # four ids are in both sets
        rows = []
        for i in ids:
            pos = 0
            for _ in range(30):
                pos += rng.randrange(10, 60) * 1000
                rows.append((i, 1, pos))
        sets.append(spark.createDataFrame(rows, "map_id long, channel int, pos long"))
    p1, p2 = (A.packed(x) for x in sets)
    every = A.aligned(p1, p2).cache()
    lengths = sets[0].unionByName(sets[1]).groupBy(F.col("map_id").alias("node")).agg(F.max("pos").alias("len"))
    want = {tuple(r) for r in A.merged_labels(G.layout(pipeline.edges_of(every, p1, p2), lengths), sets[0].unionByName(sets[1])).select("path_id", "node_id", "channel", "pos").collect()}
    counts, traced = [], A.traced
    monkeypatch.setattr(A, "traced", lambda pairs, *x: counts.append(pairs.count()) or traced(pairs, *x))
    got = pipeline.merged_sets(*sets).select("path_id", "node_id", "channel", "pos")
    nodes = {n for _, n, _, _ in want}
    assert len(nodes) > 10 and {tuple(r) for r in got.collect() if r.node_id in nodes} == want
    assert sum(counts) < 30 < every.count()


def test_command_line(spark, tmp_path):
    fa = tmp_path / "a.fa"
    fa.write_text(">x\n" + "A" * 50 + "CACGAG" + "C" * 44 + "\n>y\nACGT\n")
    cli.main(["digest", "-i", str(fa), "-o", str(tmp_path / "m"), "-e", "BSSSI", "-m", "1"])
    c = R.read_cmap(spark, str(tmp_path / "m")).orderBy("SiteID").collect()
    assert [(r.CMapId, r.SiteID, r.LabelChannel, r.Position, r.NumSites) for r in c] == [(1, 1, 1, 51.0, 1), (1, 2, 0, 100.0, 1)]
    assert R.read_keys(spark, str(tmp_path / "m.key")).count() == 2
    cli.main(["stats", "-i", str(tmp_path / "m"), "-o", str(tmp_path / "s")])
    (tmp_path / "ids").write_text("1\n")
    cli.main(["select", "-i", str(tmp_path / "m"), "-o", str(tmp_path / "k"), "--ids", str(tmp_path / "ids"), "--exclude"])
    cli.main(["unify", "-i", str(tmp_path / "m"), "-o", str(tmp_path / "u")])
    assert R.read_cmap(spark, str(tmp_path / "u")).count() == 2


def test_scalars(spark):
    lit = lambda *v: [F.lit(x) for x in v]
    row = spark.range(1).select(
        *scalars.line_through(*lit(1.0, 3.0, 5.0, 9.0)), *scalars.unit_line(*lit(0, 10, 30, 22)), scalars.distance_weight(F.lit(1400)), scalars.distance_counts(F.lit(600)),
        scalars.cost_limit(F.lit(6)), scalars.cost_limit(F.lit(10)), scalars.insertion_index(F.array(*lit(1.0, 5.0, 9.0)), F.lit(5.05)), scalars.turned_positions(F.array(*lit(1, 4)), F.lit(10)),
        scalars.shared_gap(F.array(F.lit(1), F.lit(None).cast("int"), F.lit(5)), F.array(*lit(3, 7, 11))), scalars.newest_common_version(F.array(*lit("0.2", "0.1"))),
    ).first()
    assert list(row) == [2.0, 3.0, -1, 31.0, 0.375, 0, 18.0, 72.0, 1, [6, 9], 4.0, 0.1]
