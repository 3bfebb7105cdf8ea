from cartolux.functions.sequence import ENZYMES
from cartolux.sinks import text as W
from cartolux.sources import text as R
from cartolux.streaming import bnx as B

CMAP = """# CMAP File Version:\t0.1
# Label Channels:\t1
# Nickase Recognition Site 1:\tgctcttc
# Number of Consensus Maps:\t99
#h CMapId\tContigLength\tNumSites\tSiteID\tLabelChannel\tPosition\tStdDev\tCoverage\tOccurrence\tChimQuality
#f int\tfloat\tint\tint\tint\tfloat\tfloat\tfloat\tfloat\tfloat
2\t1000.0\t2\t1\t1\t100.5\t1.0\t20\t19\t-1
2\t1000.0\t2\t2\t1\t800.0\t1.0\t20.0\t19.0\t90.1
2\t1000.0\t2\t3\t0\t1000.0\t0.0\t1.0\t1.0\t
1\t600.0\t1\t1\t1\t20.0\t1.0\t7.0\t7.0\t50.0\r
1\t600.0\t1\t2\t0\t600.0\t0.0\t1.0\t1.0\t0.0
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_cmap_round_trip(spark, tmp_path):
    c = R.read_cmap(spark, write(tmp_path / "a.cmap", CMAP)).drop("file")
    assert c.count() == 5 and c.filter("Mask IS NULL").count() == 5
    assert R.channel_mismatches(spark, str(tmp_path / "a.cmap")).count() == 0
    assert {r.CMapId: r.positions for r in R.packed(c).collect()} == {1: [20.0], 2: [100.5, 800.0]}
    for one in (True, False):
        out = str(tmp_path / f"out{one}")
        W.write_cmap(c.select(*[x for x in c.columns if x in W.CMAP][:10]), out, {1: "GCTCTTC"}, 2, one_file=one)
        back = R.read_cmap(spark, out).drop("file")
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, c.collect()), key=str)
    assert R.motif_of(str(tmp_path / "a.cmap")) == "GCTCTTC"
    assert R.checked_motifs({"a": "CTTAAG", "b": "GCTCTTC"}, ENZYMES) == ["BSPQI", "DLE1"]


def test_two_files_keep_their_own_columns(spark, tmp_path):
    write(tmp_path / "a.cmap", CMAP)
    write(tmp_path / "b.cmap", "#h CMapId\tPosition\tLabelChannel\n#f int\tfloat\tint\n9\t5.5\t1\n")
    got = {(r.CMapId, r.Position): r.ChimQuality for r in R.read_cmap(spark, str(tmp_path) + "/*.cmap").collect()}
    assert got[9, 5.5] is None and got[2, 800.0] == 90.1


def test_xmap_round_trip(spark, tmp_path):
    text = "#h XmapEntryID\tQryContigID\tRefcontigID\tQryStartPos\tQryEndPos\tRefStartPos\tRefEndPos\tOrientation\tConfidenence\tHitEnum\tQryLen\tRefLen\tLabelChannel\tAlignment\n#f x\n1\t5\t6\t90.0\t10.0\t100.0\t180.0\t-\t12.34\t2M\t99.0\t999.0\t1\t(1,9)(2,8)\n"
    x = R.read_xmap(spark, write(tmp_path / "a.xmap", text)).drop("file")
    r = x.first()
    assert (r.RefContigID, r.Confidence, r.Alignment) == (6, 12.34, "(1,9)(2,8)")
    W.write_xmap(x, str(tmp_path / "o"), "r.cmap", "q.cmap", one_file=True)
    assert R.read_xmap(spark, str(tmp_path / "o")).drop("file").first() == r


BNX = "# BNX File Version:\t1.2\n0\t7\t1000.5\t1\t2\t3\tx\n1\t10.0\t20.0\t30.0\t1000.5\nQX11\t1\t2\t3\nQX12\t4\t5\t6\n0\t8\t50.0\t1\t2\t1\tx\n1\t25.0\t50.0\nQX11\t1\nQX12\t4\n"


def test_bnx(spark, tmp_path):
    path = write(tmp_path / "a.bnx", BNX)
    got = {r.molecule_id: (r.length, r.n_labels, r.labels, r.snr) for r in R.read_bnx(spark, path, 1).collect()}
    assert got == {7: (1000.5, 3, [10.0, 20.0, 30.0], [1.0, 2.0, 3.0]), 8: (50.0, 1, [25.0], [1.0])}
    assert R.read_bnx(spark, path, 3).count() == 1
    scaled = R.rescaled_molecules(R.read_bnx(spark, path, 3), 510).first()
    assert (scaled.length, scaled.labels) == (1020.51, [10.2, 20.4, 30.6])
    W.write_bnx(R.read_bnx(spark, path, 1), str(tmp_path / "o"))
    assert {r.molecule_id: r.labels for r in R.read_bnx(spark, str(tmp_path / "o"), 1).collect()} == {7: [10.0, 20.0, 30.0], 8: [25.0]}


def test_bnx_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.bnx", BNX)
    q = B.molecules(spark, str(tmp_path / "in"), 1).writeStream.format("memory").queryName("mols").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.molecule_id for r in spark.sql("SELECT * FROM mols").collect()} == {7, 8}


def test_fasta(spark, tmp_path):
    s = R.read_fasta(spark, write(tmp_path / "a.fa", ">one first thing\nACGT\nac\n>two\nNN\n>three\n"))
    assert sorted(map(tuple, s.collect())) == [("one", "first thing", "ACGTac"), ("three", "", ""), ("two", "", "NN")]
    assert R.read_fasta(spark, str(tmp_path / "a.fa"), upper=True).filter("name = 'one'").first().seq == "ACGTAC"
    W.write_fasta(s, str(tmp_path / "o"), 3)
    assert sorted(map(tuple, R.read_fasta(spark, str(tmp_path / "o")).select("name", "seq").collect())) == sorted(map(tuple, s.select("name", "seq").collect()))


def test_tables_and_lists(spark, tmp_path):
    path = write(tmp_path / "t.tsv", "#oldId\toldStart\toldEnd\tnewId\tnewStart\tnewEnd\n1\t0\t9\t7\t0\t9\n1\t10\t30\t8\t0\t20\nshort\trow\n")
    t = R.read_translation(spark, path)
    assert t.count() == 2
    W.write_table(t, str(tmp_path / "o"), ["oldId", "oldStart"], one_file=True)
    assert R.read_translation(spark, str(tmp_path / "o")).count() == 2
    for bad, message in (("oldId\tx\n1\t2\n", "columns missing"), ("oldId\toldStart\toldEnd\tnewId\tnewStart\tnewEnd\n1\t0\t9\t7\t0\t9\n1\t11\t30\t8\t0\t20\n", "not contiguous")):
        try:
            R.read_translation(spark, write(tmp_path / "bad.tsv", bad))
            raise AssertionError
        except ValueError as e:
            assert message in str(e)
    assert sorted(r.id for r in R.read_ids(spark, write(tmp_path / "ids", "5\nx\n 7 \n-1\n")).collect()) == [5, 7]
    keys = R.ids_in_names(R.read_keys(spark, write(tmp_path / "k", "CompntId\tCompntName\tCompntLength\n1\tgi|88|x\t50\n2\tplain\t60\n")))
    assert sorted((r.CompntId, r.name_id) for r in keys.collect()) == [(1, 88), (2, None)]
    xml = write(tmp_path / "c.xml", '<root><base><flag attr="-a" val0="1"/></base><one><include val0="base"/><flag attr="-b" val0="2" val1="3"/></one></root>')
    assert R.read_stage_config(xml)["one"] == {"-a": ["1"], "-b": ["2", "3"]}
    assert [W.round_letters(n) for n in (1, 26, 27, 28, 702, 703)] == ["A", "Z", "AA", "AB", "ZZ", "AAA"]


def test_decimals(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.25,), (-0.25,), (12.0,), (None,), (1234567.891,)], "x double")
    assert [r[0] for r in df.select(W.decimals(F.col("x"), 1)).collect()] == ["0.3", "-0.3", "12.0", None, "1234567.9"]
