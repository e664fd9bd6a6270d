"""Values worked by hand."""

import math

import pytest
from pyspark.sql import functions as F

from geonet.functions import attributes as at, geometry as geo
from geonet.functions.crs import reproject
from geonet.operators import cells, chains, clip, coloring, cover, discs, graph, match, noding, vertices


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("masks, rest, status", [
    ([(0, 0, 60, 0, 5)], 0.35, "ja"), ([(0, 0, 58, 0, 5)], 0.37, "nein"), ([(0, 0, 30, 0, 5), (20, 3, 60, 3, 5)], 0.36, "ja")])
def test_coverage_status(spark, segments, masks, rest, status):
    m = spark.createDataFrame([tuple(map(float, r)) for r in masks], "x1 double, y1 double, x2 double, y2 double, r double")
    got = cover.classify_coverage(segments([(1, 0, 0, 0, 100, 0)]), m).first()
    assert got["rge"] == status and got["rest"] == pytest.approx(rest, abs=1e-9)


def test_line_without_length_is_closed(spark, segments):
    m = spark.createDataFrame([(0.0, 0.0, 60.0, 0.0, 5.0)], "x1 double, y1 double, x2 double, y2 double, r double")
    got = {r["line_id"]: r["rge"] for r in cover.classify_coverage(segments([(1, 0, 9, 9, 9, 9), (2, 0, 500, 500, 600, 500)]), m).collect()}
    assert got == {1: "nein", 2: "nein"}


def test_match_shares(segments):
    o = segments([(1, 0, 0, 0, 100, 0)], "oneway_id")
    s = segments([(1, 0, 0, 1, 100, 1), (2, 0, 0, 0, 180, 0), (3, 0, 0, 1, 150, 1)], "street_id")
    got = {r["street_id"]: r["street_share"] for r in match.match_lines(o, s).collect()}
    assert got == {1: pytest.approx(1), 3: pytest.approx(0.678214, abs=1e-6)}
    assert match.match_best(o, s).first()["street_id"] == 3  # the longest overlap


def test_match_copies_take_lowest_id(segments):
    o = segments([(i, 0, 0, 0, 100, 0) for i in (1, 2, 3)], "oneway_id")
    s = segments([(i, 0, 0, 1, 100, 1) for i in (9, 7, 8)], "street_id")
    assert rows(match.match_best(o, s), "oneway_id", "street_id") == [(1, 7), (2, 7), (3, 7)]


def test_sync_split(segments, points):
    target = segments([(1, 0, 0, 0, 100, 0)])
    for p, n in (((50, 0.3), 1), ((50, 0.6), 0), ((0.005, 0), 0)):
        assert noding.sync_points(points([p]), target, 0.5).count() == n
    got = noding.sync_nodes(segments([(5, 0, 50, 0.3, 50, 80)]), target, 0.5)
    assert rows(got, "piece", "x1", "x2") == [(0, 0.0, 50.0), (1, 50.0, 100.0)]


@pytest.mark.parametrize("angles, hit", [((0, 90, 180), 1), ((0, 20, 180), 0)])
def test_true_intersections(segments, angles, hit):
    arms = [(i, 0, 0, 0, 50 * math.cos(math.radians(a)), 50 * math.sin(math.radians(a))) for i, a in enumerate(angles)]
    assert noding.true_intersections(segments(arms)).count() == hit


def test_split_at_nodes(spark, segments):
    line = segments([(1, 0, 0, 0, 50, 0), (1, 1, 50, 0, 100, 0)])
    at_50 = spark.range(1).selectExpr("struct(50L AS kx, 0L AS ky) AS node")
    assert rows(vertices.split_at_nodes(line, at_50), "piece", "seg_idx", "x1") == [(0, 0, 0.0), (1, 0, 50.0)]
    assert rows(vertices.split_at_nodes(line, at_50.filter("false")), "piece", "seg_idx") == [(0, 0), (0, 1)]


def test_crossing_and_overlap(segments):
    got = noding.crossings(segments([(1, 0, 0, 0, 10, 10), (2, 0, 0, 10, 10, 0)]))
    assert rows(got, "line_id", "t", "x", "y") == [(1, 0.5, 5.0, 5.0), (2, 0.5, 5.0, 5.0)]
    # Overlap along a line: one end point; neighbours on one line are not compared.
    got = noding.crossings(segments([(1, 0, 0, 0, 10, 0), (2, 0, 4, 0, 20, 0)]))
    assert rows(got, "line_id", "x") == [(1, 4.0)]
    back = [(1, 0, 4, 0, 10, 0), (1, 1, 10, 0, 0, 0)]
    assert noding.crossings(segments(back)).count() == 0
    # ... but a copy of the neighbour on another line is.
    assert rows(noding.crossings(segments([*back, (2, 0, 4, 0, 10, 0)])), "line_id", "seg_idx", "x") == [(1, 1, 4.0)]


def test_closest_point(spark):
    d = spark.createDataFrame([(5.0, 3.0), (-4.0, 3.0)], "px double, py double")
    t = geo.closest_t("px", "py", F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(0.0))
    assert [r[0] for r in d.select(t * 10).collect()] == [5.0, 0.0]


@pytest.mark.parametrize("sources, want", [([("A", 1.0)], {"A": 1, "B": 31, "C": 71}), ([("A", 1.0), ("C", 5.0)], {"A": 1, "B": 31, "C": 5})])
def test_network_distance(spark, sources, want):
    e = spark.createDataFrame([("A", "B", 30.0), ("B", "A", 30.0), ("B", "C", 40.0), ("C", "B", 40.0)], "src string, dst string, len double")
    s = spark.createDataFrame(sources, "node string, d0 double")
    assert {r["node"]: r["d"] for r in graph.network_distance(e, s).collect()} == want


@pytest.mark.parametrize("da, db, want", [(0.0, 100.0, {25: 25, 50: 25, 75: 25, 0: 25}), (0.0, 0.0, {25: 50, 50: 50})])
def test_color_edge(spark, segments, da, db, want):
    e = graph.build_edges(segments([(1, 0, 0, 0, 100, 0)]), geodesic=False)
    dist = e.filter("fwd").selectExpr(f"inline(array(struct(src AS node, {da}D AS d), struct(dst AS node, {db}D AS d)))")
    got = coloring.color_edges(e, dist).groupBy("color").agg(F.expr("round(sum(x2 - x1), 9) AS l"))
    assert {r["color"]: r["l"] for r in got.collect()} == want


def test_unreachable_edge(spark, segments):
    e = graph.build_edges(segments([(1, 0, 0, 0, 100, 0)]))
    none = e.selectExpr("src AS node", "0D AS d").filter("false")
    got = coloring.color_edges(e, none).collect()
    assert [(r["color"], r["rank"], r["road_type"]) for r in got] == [(0, 10, None)]


def test_merge_runs(spark):
    cols = "line_id int, seg_idx int, t0 double, t1 double, x1 double, y1 double, x2 double, y2 double, color int, rank int, road_type string"
    d = spark.createDataFrame([(1, i, 0.0, 1.0, float(i), 0.0, i + 1.0, 0.0, c, k, "path") for i, (c, k) in enumerate(
        [(25, 40), (25, 40), (50, 30), (25, 40)])], cols)
    runs = coloring.merge_runs(d)
    assert rows(coloring.run_attributes(runs), "color", "run", "pieces") == [(25, 1, 2), (25, 2, 1), (50, 1, 1)]
    assert rows(coloring.run_vertices(runs), "color", "run", "idx", "x") == [
        (25, 1, 0, 0.0), (25, 1, 1, 1.0), (25, 1, 2, 2.0), (25, 2, 0, 3.0), (25, 2, 1, 4.0), (50, 1, 0, 2.0), (50, 1, 1, 3.0)]


RINGS = [(1, 0, [(500, 500), (3500, 500), (3500, 1500), (2050, 1550), (3450, 3500), (500, 3500), (500, 500)]),
         (1, 1, [(1020, 1020), (1020, 1480), (1480, 1480), (1480, 1020), (1020, 1020)])]


def ring_table(spark, rings=RINGS):
    data = [(a, r, i, float(x), float(y)) for a, r, pts in rings for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(data, "area_id int, ring int, idx int, x double, y double")


@pytest.mark.parametrize("line, want", [
    ((0, 2000, 4000, 2000), [(500, 2373.076923)]), ((3000, 0, 3000, 4000), [(500, 1517.241379), (2873.214286, 3500)]),
    ((0, 1200, 4000, 1200), [(500, 1020), (1480, 3500)])])
def test_clip(spark, segments, line, want):
    got = clip.clip_lines(segments([(1, 0, *line)]), clip.area_edges(ring_table(spark)))
    axis = ("x1", "x2") if line[1] == line[3] else ("y1", "y2")
    assert [tuple(round(v, 6) for v in r) for r in rows(got, *axis)] == want


def test_clip_policy(spark, segments):
    line = segments([(1, 0, 0, 0, 10, 0)])
    assert clip.clip_lines(line, None).count() == 1
    with pytest.raises(ValueError):
        clip.clip_lines(line, None, strict=True)


def test_two_discs(points):
    assert discs.union_area(points([(0, 0), (30, 0), (0, 0)]), [25]).first()["area"] == pytest.approx(3367.871794, abs=1e-6)


def test_grid_numbers(spark):
    d = spark.createDataFrame([(600.0, 10.0), (10.0, 550.0)], "x double, y double")
    cell = F.expr(cells.grid_cell("x", "y", "0", "0", "600"))
    assert [r[0] for r in d.select(cell).collect()] == [3, 2]


@pytest.mark.parametrize("lon, lat, crs, x, y, eps", [
    (16.37, 48.21, 3857, 1822300.064286, 6141862.730877, 1e-5), (16.171875, 48.1074311884804, 3857, 1800244.890172, 6124746.202435, 1e-5),
    (16.59375, 48.34164617237459, 3857, 1847207.800351, 6163881.960917, 1e-5),
    (16.3731, 48.2085, 31256, 3044.761, 341122.703, 0.05), (16.3731, 48.2085, 31257, 598837.827, 358794.565, 0.05)])
def test_projection(spark, lon, lat, crs, x, y, eps):
    d = reproject(spark.createDataFrame([(lon, lat)], "x double, y double"), 4326, crs)
    got = d.first()
    assert (got["x"], got["y"]) == (pytest.approx(x, abs=eps), pytest.approx(y, abs=eps))
    back = reproject(d, crs, 4326).first()
    assert (back["x"], back["y"]) == (pytest.approx(lon, abs=1e-7), pytest.approx(lat, abs=1e-7))


def test_geodesic(spark):
    x, y = 1822300.064286, 6141862.730877
    d = spark.range(1).select(geo.geodesic_length(F.lit(x), F.lit(y), F.lit(x + 100), F.lit(y)).alias("e"),
                              geo.geodesic_length(F.lit(x), F.lit(y), F.lit(x), F.lit(y + 100)).alias("n")).first()
    assert (d["e"], d["n"]) == (pytest.approx(66.565758, abs=1e-6), pytest.approx(66.565369, abs=1e-6))


def test_text_and_keys(spark):
    d = spark.range(1).select(
        at.district_code(F.lit("AT90300")), at.district_code(F.lit("AT")), at.crop_leading_number(F.lit("3 - Hauptstraße")),
        geo.snap_key(F.lit(-0.5), 1.0)).first()
    assert tuple(d) == ("3", "0", "Hauptstraße", 0)


def test_merge_lines_chain_and_loop(segments):
    chain = [(1, 0, 0, 0, 10, 0), (2, 0, 20, 0, 10, 0), (3, 0, 20, 0, 30, 0), (3, 1, 30, 0, 40, 0)]
    loop = [(11, 0, 0, 50, 5, 55), (12, 0, 10, 50, 5, 55), (13, 0, 10, 50, 0, 50)]
    got = chains.merge_lines(segments([*chain, *loop])).collect()
    parts = {}
    for r in got:
        parts.setdefault(r["chain_id"], []).append(r)
    assert sorted(parts) == [1, 11]
    for segs in parts.values():
        segs.sort(key=lambda r: r["seg_idx"])
        assert [r["seg_idx"] for r in segs] == list(range(len(segs)))
        assert all((a["x2"], a["y2"]) == (b["x1"], b["y1"]) for a, b in zip(segs, segs[1:]))
    assert (parts[11][0]["x1"], parts[11][0]["y1"]) == (parts[11][-1]["x2"], parts[11][-1]["y2"])


def test_rank_arcs_moves_unfinished_arcs_only(spark, monkeypatch):
    """Arcs of short chains leave the rounds: what is written stays near the arcs, however many rounds one long chain takes."""
    from geonet.session import Scratch

    written = []
    cut = Scratch.cut

    def counted(self, df, name):
        out = cut(self, df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "cut", counted)
    # One chain of 32 arcs, 500 single arcs and one loop of three.
    nexts = {**{i: i + 1 for i in range(31)}, 31: None, **{100 + i: None for i in range(500)}, 700: 701, 701: 702, 702: 700}
    arc = lambda i: None if i is None else (i, 0)
    d = spark.createDataFrame([(arc(a), 1, arc(n)) for a, n in nexts.items()],
                              "arc struct<line:bigint,dir:int>, w bigint, next struct<line:bigint,dir:int>")
    got = {r["arc"]["line"]: r for r in chains.rank_arcs(d, Scratch(spark, "test"), "rank").collect()}
    assert len(got) == len(nexts)
    assert all(got[i]["done"] and got[i]["ptr"]["line"] == 31 and got[i]["cnt"] == 31 - i for i in range(32))
    assert all(got[100 + i]["done"] and got[100 + i]["ptr"]["line"] == 100 + i for i in range(500))
    assert all(not got[i]["done"] and got[i]["low"]["line"] == 700 for i in (700, 701, 702))
    assert sum(written) < 3 * len(nexts) and len(written) >= 6


def test_merge_lines_stops_at_junction_and_type(segments):
    star = [(1, 0, 0, 0, 10, 0), (2, 0, 10, 0, 20, 0), (3, 0, 10, 0, 10, 10), (4, 0, 20, 0, 30, 0, "road")]
    assert rows(chains.merge_lines(segments(star)), "chain_id", "line_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_merge_lines_with_repeated_points(segments):
    got = chains.merge_lines(segments([(1, 0, 0, 0, 0, 0), (1, 1, 0, 0, 5, 0), (1, 2, 5, 0, 5, 0), (1, 3, 5, 0, 9, 0), (2, 0, 9, 0, 12, 0)]))
    assert rows(got, "seg_idx", "x1", "x2") == [(0, 0.0, 5.0), (1, 5.0, 9.0), (2, 9.0, 12.0)]


def test_extent_needs_area():
    with pytest.raises(ValueError):
        geo.extent_filter((1.0, 2.0, 1.0, 5.0))
