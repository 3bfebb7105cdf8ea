"""Which rows of cmap are labels."""

from cartolux.plans import inputs

COLUMNS = "map_set string, CMapId long, ContigLength double, NumSites int, SiteID int, LabelChannel int, Position double, Coverage double, ChimQuality double"


def _places(spark, tmp_path, rows):
    made = [(s, m, length, 3, n, 1, at, 1.0, 90.0) for n, (s, m, length, at) in enumerate(rows)]
    spark.createDataFrame(made, COLUMNS).write.parquet(f"{tmp_path}/cmap.parquet")
    return sorted((r.map_id, r.pos) for r in inputs.labels(spark, str(tmp_path)).collect())


def test_labels_end_with_their_map_not_at_a_fixed_place(spark, tmp_path):
    rows = [("A", 1, 266_500_020.0, x) for x in (5.0, 99_999_999.0, 100_000_000.0, 266_500_000.0, 266_500_021.0, float("nan"), float("inf"), -1.0)]
    assert _places(spark, tmp_path, rows) == [(1, 50), (1, 999_999_990), (1, 1_000_000_000), (1, 2_665_000_000)]


def test_a_row_without_length_is_judged_by_the_other_rows_of_its_map(spark, tmp_path):
    rows = [("A", 1, 2e8, 7.0), ("A", 1, None, 1.5e8), ("A", 1, None, 2.5e8), ("A", 1, float("nan"), 9.0), ("A", 1, float("nan"), 3e8), ("A", 1, None, float("nan"))]
    rows += [("A", 2, 1000.0, 7.0), ("A", 2, None, 1001.0), ("A", 3, None, 1.2e8), ("A", 3, None, float("nan")), ("A", 3, None, 1e300)]
    assert _places(spark, tmp_path, rows) == [(1, 70), (1, 90), (1, 1_500_000_000), (2, 70), (3, 1_200_000_000)]


def test_long_maps_and_large_ids_reach_the_label_queries(spark, tmp_path):
    """A label at 200 Mb of a map of 240 Mb whose id is beyond ten million is cut, numbered and counted."""
    from datetime import datetime

    from cartolux.plans import hit_queries, map_queries

    far, when = 12_345_678, datetime(2023, 1, 1)
    cmap = [("BNG_DLE1", i, length, 3, s, 1, p, 1.0, 20.0, 20.0, q, when, None) for i, length in ((far, 240e6), (7, 1e6)) for s, (p, q) in enumerate(((1000.0, 90.0), (length * 5 / 6, 30.0), (length - 500, 90.0)), 1)]
    schema = "map_set string, CMapId long, ContigLength double, NumSites int, SiteID int, LabelChannel int, Position double, StdDev double, Coverage double, Occurrence double, ChimQuality double, loaded_at timestamp, retired_at timestamp"
    spark.createDataFrame(cmap, schema).write.parquet(f"{tmp_path}/cmap.parquet")
    xmap = [("a", 1, 7, far, 1000.0, 9000.0, 199e6, 201e6, "+", 20.0, "8M", 1e6, 240e6, 1, "(1,1)", when, when)]
    names = "aln_set string, XmapEntryID long, QryContigID long, RefContigID long, QryStartPos double, QryEndPos double, RefStartPos double, RefEndPos double, Orientation string, Confidence double, HitEnum string, QryLen double, RefLen double, LabelChannel int, Alignment string, aligned_at timestamp, received_at timestamp"
    spark.createDataFrame(xmap, names).write.parquet(f"{tmp_path}/xmap.parquet")
    pieces = {r.new_id: (r.old_id, r.old_start, r.old_end) for r in map_queries.x12_fragments(spark, str(tmp_path)).collect()}
    assert len(pieces) == 4 and {o for o, *_ in pieces.values()} == {far, 7}
    assert (far, 2_000_000_001, 2_399_999_999) in pieces.values()
    cut = map_queries.x11_cut_maps(spark, str(tmp_path)).collect()
    assert len(cut) == 6 and {r.new_id for r in cut} <= set(pieces)
    (beside,) = hit_queries.j2_overhang_labels(spark, str(tmp_path)).collect()
    assert (beside.n_left, beside.n_right) == (1, 1)
