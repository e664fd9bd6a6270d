"""Plans that must not evaluate their inputs again and again, and boxes that must not meet all to all."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from geonet.operators import graph, grid, intervals
from geonet.queries import registry
from geonet.session import Scratch
from geonet.sources import geojson

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, scans", [("color_edges", 6), ("merge_runs", 8), ("best_match", 6), ("oneway_status", 10)])
def test_scans(spark, name, scans):
    plan = registry()[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= scans


def test_components_rounds_are_few(spark):
    """Jobs of the whole loop on a table of chains, stars and cycles."""
    rows = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000 + i, 2000 + (i + 1) % 300) for i in range(300)]
    edges = spark.createDataFrame(rows, "src int, dst int")
    seen = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    spark.sparkContext.setJobGroup("components", "")
    try:
        got = {r["node"]: r["component"] for r in graph.connected_components(edges).collect()}
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("components"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(got.values()) == {0, 1000, 2000} and len(got) == 401 + 400 + 300
    assert jobs <= 100 and seen >= 0


def test_distances_follow_a_chain(spark):
    """More rounds than any fixed number that one would set, with late shortcuts that improve known nodes."""
    n = 120
    rows = [(i, i + 1, 1.0) for i in range(n)] + [(0, 60, 80.0), (0, 100, 70.0)]
    edges = spark.createDataFrame([e for a, b, w in rows for e in ((a, b, w), (b, a, w))], "src int, dst int, len double")
    sources = spark.createDataFrame([(0, 0.0)], "node int, d0 double")
    got = {r["node"]: r["d"] for r in graph.network_distance(edges, sources).collect()}
    assert got == {i: min(i, 70.0 + abs(i - 100)) for i in range(n + 1)}
    near = {r["node"]: r["d"] for r in graph.network_distance(edges, sources, cutoff=5.0).collect()}
    assert near == {i: float(i) for i in range(6)}


def test_distances_through_a_long_chain(spark, monkeypatch):
    """20,000 hops with two dead ends, a source in the middle and one at an end."""
    n = 20_000
    edges = spark.range(n).selectExpr("inline(array(struct(id AS src, id + 1 AS dst, 1D AS len), struct(id + 1 AS src, id AS dst, 1D AS len)))")
    sources = spark.createDataFrame([(5_000, 2.0), (n, 0.0)], "node long, d0 double")
    written = []
    real = Scratch.cut
    monkeypatch.setattr(Scratch, "cut", lambda self, df, name: (written.append(name), real(self, df, name))[1])
    got = {r["node"]: r["d"] for r in graph.chain_distance(edges, sources).collect()}
    assert got == {i: float(min(abs(i - 5_000) + 2, n - i)) for i in range(n + 1)}
    assert len(written) < 30  # tables written, one per round
    near = {r["node"]: r["d"] for r in graph.chain_distance(edges, sources, cutoff=4.0).collect()}
    assert near == {i: d for i, d in got.items() if d <= 4}


def test_one_wide_box_costs_little(spark):
    def boxes(n, p, far):
        d = spark.range(n).selectExpr(f"id AS {p}id", f"id * 10D + {far} AS {p}x", f"0D AS {p}y")
        return d.selectExpr(f"{p}id", f"{p}x AS {p}0", f"{p}y AS {p}1", f"{p}x + 1 AS {p}2", f"{p}y + 1 AS {p}3")

    def took(a, b):
        start = time.time()
        n = grid.any_box_pairs(a, b, ["a0", "a1", "a2", "a3"], ["b0", "b1", "b2", "b3"], 20.0).count()
        return n, time.time() - start

    a, b = boxes(40_000, "a", 0), boxes(40_000, "b", 5)
    wide = spark.createDataFrame([(-1, -1.0, -1.0, 500_000.0, 2.0)], "aid bigint, a0 double, a1 double, a2 double, a3 double")
    took(a, b)
    n, plain = took(a, b)
    m, more = took(a.unionByName(wide), b)
    assert n == 0 and m == 40_000
    assert more < 4 * plain + 4


def test_wide_boxes_in_a_hot_cell_are_not_copied(spark):
    rows = [(i, 0.5, 0.5, 99.5, 99.5) for i in range(300)]
    a = spark.createDataFrame(rows, "aid int, a0 double, a1 double, a2 double, a3 double")
    b = a.toDF("bid", "b0", "b1", "b2", "b3")
    d = grid.box_pairs(a, b, ["a0", "a1", "a2", "a3"], ["b0", "b1", "b2", "b3"], 100.0, hot_rows=10)
    assert d.count() == 300 * 300


def test_chained_cut_points(spark):
    pts = [(1, 0, k * 0.6) for k in range(100)] + [(2, 0, 0.0), (2, 0, 5.0)]
    d = spark.createDataFrame(pts, "line_id int, seg_idx int, t double")
    got = sorted((r["line_id"], r["t"]) for r in intervals.dedupe_splits(d, ["line_id", "seg_idx"], "t", 1.0).collect())
    want, last = [], None
    for _, _, t in sorted(pts[:100]):
        if last is None or t - last >= 1.0:
            want.append((1, t))
            last = t
    assert got == want + [(2, 0.0), (2, 5.0)]


@pytest.mark.parametrize("scaled", [False, True])
def test_cut_points_in_long_chains(spark, monkeypatch, scaled):
    """Chains beyond the walked length, with ties on the distance, copies and a segment without length."""
    monkeypatch.setattr(intervals, "WALK_ROWS", 3)
    rng = random.Random(7)
    pts = [(line, rng.randrange(2), rng.randrange(400) / 400, float(3 * line)) for line in range(4) for _ in range(300)]
    pts += [(9, 0, k * 1e-3 + rng.random() * 1e-4, 3.0) for k in range(0, 1000, 2)] * 2
    d = spark.createDataFrame(pts, "line_id int, seg_idx int, t double, len double")
    scale = F.col("len") if scaled else None
    got = sorted(map(tuple, intervals.dedupe_splits(d, ["line_id", "seg_idx"], "t", 0.0125, scale).collect()))
    want, last = [], None
    for line, seg, t, unit in sorted(set(pts)):
        if last is None or last[:2] != (line, seg) or (t - last[2]) * (unit if scaled else 1.0) >= 0.0125:
            last = (line, seg, t, unit)
            want.append(last)
    assert got == want


def test_one_chain_of_many_cut_points(spark):
    """Half a million points that all hang together: every tenth stays."""
    n = 500_000
    d = spark.range(n).selectExpr("1 AS line_id", "id / 1048576D AS t")
    got = intervals.dedupe_splits(d, ["line_id"], "t", 10 / 1048576).selectExpr("count(1) AS n", "min(t) AS a", "max(t) AS b").first()
    assert tuple(got) == (n // 10, 0.0, (n - 10) / 1048576)


SQUARE = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[2, 2], [3, 2], [3, 3], [2, 3], [2, 2]]
FAR = [[20, 20], [21, 20], [21, 21], [20, 21], [20, 20]]
GEOMETRIES = [
    {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [FAR]]},
    {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [FAR]]},
                                                  {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]},
    {"type": "Polygon", "coordinates": [SQUARE, HOLE]},
    {"type": "Point", "coordinates": [3, 4]},
    {"type": "Point", "coordinates": [3, 4]},
    {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 2]], [[5, 5], [6, 6]]]},
]
FEATURES = [{"type": "Feature", "properties": {"k": "v"}, "geometry": g} for g in GEOMETRIES]


def collection(features):
    return json.dumps({"type": "FeatureCollection", "features": features})


@pytest.mark.parametrize("by_line, text", [
    (False, collection(FEATURES)), (True, collection(FEATURES) + "\n"),
    (True, '{\n"type": "FeatureCollection",\n"name": "x",\n"features": [\n' + ",\n".join(map(json.dumps, FEATURES)) + "\n]\n}\n"),
    (True, '{"type":"FeatureCollection","features":[\n' + ",\n".join(map(json.dumps, FEATURES)) + "\n]}\n")])
def test_geometry_survives_a_round_trip(spark, tmp_path, by_line, text):
    (tmp_path / "a.geojson").write_text(text)
    d = geojson.read_features(spark, str(tmp_path / "a.geojson"), "x", by_line)
    assert d.select("feature_id").distinct().count() == len(FEATURES)
    back = [json.loads(r["value"])["geometry"] for r in geojson.feature_json(d).collect()]
    key = lambda g: json.dumps(g, sort_keys=True)
    assert sorted(map(key, back)) == sorted(key(json.loads(json.dumps(g), parse_int=float)) for g in GEOMETRIES)


def test_broken_files_are_not_passed_over(spark, tmp_path):
    (tmp_path / "cut.geojson").write_text(collection(FEATURES)[:-40])
    with pytest.raises(Exception, match="unreadable GeoJSON file"):
        geojson.read_features(spark, str(tmp_path / "cut.geojson"), "x").collect()
    assert geojson.broken_parts(spark, str(tmp_path / "cut.geojson")).count() == 1
    (tmp_path / "lines.geojson").write_text(json.dumps(FEATURES[0]) + "\n" + json.dumps(FEATURES[1])[:60] + "\n")
    with pytest.raises(Exception, match="broken GeoJSON line"):
        geojson.read_features(spark, str(tmp_path / "lines.geojson"), "x", by_line=True).collect()
    assert geojson.read_features(spark, str(tmp_path / "lines.geojson"), "x", by_line=True, bad="skip").count() == 1
    (tmp_path / "osm.json").write_text('{"elements": [{"type": "node"')
    with pytest.raises(Exception, match="unreadable element file"):
        geojson.read_osm_elements(spark, str(tmp_path / "osm.json")).collect()
