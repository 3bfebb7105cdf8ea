from datetime import datetime

import pytest

from cartolux.operators import drift

FILES = "file_id long, stream string, kind string, made_at timestamp, extra int"
LINES = "file_id long, line_no int, line string, stream string"


def tables(spark, files, bodies):
    f = spark.createDataFrame([(i, s, k, datetime(2023, 1, day), 0) for i, s, k, day in files], FILES)
    rows = [(i, n, text, "clash") for i, lines in bodies.items() for n, text in enumerate(lines, 1)]
    return f, spark.createDataFrame(rows, LINES)


HEAD = ["# CMAP File Version:\t0.1", "#h CMapId\tPosition\tChimQuality", "#f int\tfloat\tfloat"]


def test_changes(spark, rows):
    f, l = tables(spark, [(1, "s", "CMAP", 1), (3, "s", "CMAP", 2), (2, "s", "CMAP", 2), (4, "t", "CMAP", 1)], {
        1: [*HEAD, "1\t2.0\t3.5"],
        2: ["#h\tPosition\tCMapId\tChimQual\tNote\r", "#f\tfloat\tint\tfloat\tstring\r", "2.0\t1\t93.3%\tx\r", "\t\tNA\t"],
        3: ["#h CMAPID\tChimQuality\tNote", "#f int\tint\tstring", "1\t5\t7"],
        4: HEAD,
    })
    found = rows(drift.changes(drift.file_schemas(f, l)))
    assert found == [
        (2, "ChimQuality", "renamed"), (2, "ChimQuality", "retyped"), (2, "Note", "added"),
        (3, "CMapId", "renamed"), (3, "ChimQuality", "renamed"), (3, "ChimQuality", "retyped"), (3, "Position", "removed"),
    ]


def test_same_schema_in_another_order_is_no_change(spark):
    f, l = tables(spark, [(1, "s", "CMAP", 1), (2, "s", "CMAP", 5)], {1: HEAD, 2: ["#h Position\tChimQuality\tCMapId", "#f float\tfloat\tint"]})
    assert drift.changes(drift.file_schemas(f, l)).count() == 0


def test_conformed(spark):
    f, l = tables(spark, [(1, "s", "CMAP", 1), (2, None, "CMAP", 2), (3, "x", "XMAP", 3)], {
        1: ["#h CMapId\tPosition\tLblCh\tQual\tChimQual", "#f int\tfloat\tint\tint\tfloat", "ctg_7\t2.5\tred_01\t9\t93,5", "8\tbad\tend\t\tq12"],
        2: ["#h\tPos\tMask", "#f\tfloat\tHex", "NA\t0x1F", "  ", "3.5"],
        3: ["#h XmapEntryID\tSense\tConfidence", "#f int\tstring\tfloat", "1\trev\t12.50*", "2\tsideways\t1"],
    })
    schemas = drift.file_schemas(f, l)
    got = {(r.file_id, r.line_no): r for r in drift.conformed(schemas, l, "CMAP").collect()}
    one, two = got[1, 3], got[1, 4]
    assert (one.CMapId, one.Position, one.LabelChannel, one.ChimQuality, one.extras) == (7, 2.5, 2, 93.5, '{"Qual":"9"}')
    assert (two.Position, two.LabelChannel, two.ChimQuality, two.extras) == (None, 0, 12.0, '{"!Position":"bad"}')
    assert (got[2, 3].Position, got[2, 3].Mask, got[2, 5].Position, got[2, 5].Mask) == (None, 31, 3.5, None)
    assert (2, 4) not in got
    x = sorted(drift.conformed(schemas, l, "XMAP").select("XmapEntryID", "Orientation", "Confidence", "extras").collect())
    assert [tuple(r) for r in x] == [(1, "-", 12.5, "{}"), (2, None, 1.0, '{"!Orientation":"sideways"}')]


def test_versions(spark):
    f, l = tables(spark, [(1, "s", "CMAP", 1), (2, "s", "CMAP", 2)], {1: HEAD, 2: HEAD})
    (v,) = drift.versions(drift.file_schemas(f, l)).collect()
    assert (v.n_files, v.renames, v.casts) == (2, "", "CMapId:int>long,ChimQuality:float>double,Position:float>double")
    assert "Coverage" in v.defaults


@pytest.mark.parametrize("lines", [{}, {1: ["no header\tat all"]}, {9: HEAD}, {1: [None]}])
def test_nothing_to_compare(spark, lines):
    f, l = tables(spark, [(1, "s", "CMAP", 1), (1, "s", "CMAP", 1)], lines)
    schemas = drift.file_schemas(f, l)
    assert drift.changes(schemas).count() == 0
    assert drift.conformed(schemas, l, "CMAP").count() == 0


def test_empty_tables_and_nulls(spark):
    f = spark.createDataFrame([(1, None, None, None, None), (2, None, None, None, None), (None, "s", "CMAP", None, None)], FILES)
    l = spark.createDataFrame([(1, 1, "#h CMapId\tNumSites", None), (2, 1, "#h XmapEntryID", None), (2, 2, "", None)], LINES)
    found = drift.changes(drift.file_schemas(f, l)).select("field", "change").collect()
    assert sorted(map(tuple, found)) == [("CMapId", "removed"), ("NumSites", "removed"), ("XmapEntryID", "added")]
    assert drift.changes(drift.file_schemas(f.limit(0), l.limit(0))).count() == 0


def test_orientation_codes_and_the_record_of_steps(spark):
    f, l = tables(spark, [(1, "s", "XMAP", 1), (2, "s", "XMAP", 2)], {
        1: ["#h XmapEntryID\tOrientation", "#f int\tint", "1\t1", "2\t-1"],
        2: ["#h XmapEntryID\tDirection\tNote", "#f int\tstring\tstring", "3\tF\tx", "4\trev\ty"],
    })
    schemas = drift.file_schemas(f, l)
    assert [r.Orientation for r in drift.conformed(schemas, l, "XMAP").orderBy("XmapEntryID").collect()] == ["+", "-", "+", "-"]
    steps = [(r.file_id, r.version, r.action, r.field, r.source, r.target) for r in drift.applied(schemas).filter("action <> 'default'").orderBy("file_id", "step_no").collect()]
    assert steps == [
        (1, 1, "cast", "Orientation", "int", "string"), (1, 1, "cast", "XmapEntryID", "int", "long"),
        (2, 2, "rename", "Orientation", "Direction", "Orientation"), (2, 2, "cast", "Orientation", "string", "string"), (2, 2, "cast", "XmapEntryID", "int", "long"), (2, 2, "keep", "Note", "string", "extras"),
    ]
    moved = [(r.from_version, r.to_version, r.step_no, r.action, r.field) for r in drift.migrations(schemas).orderBy("step_no").collect()]
    assert moved == [(1, 2, 1, "add", "Note"), (1, 2, 2, "rename", "Orientation"), (1, 2, 3, "cast", "Orientation")]
