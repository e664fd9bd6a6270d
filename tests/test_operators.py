"""Operators against brute force, with the hot-key, hot-cell and block paths forced on small data."""

import heapq
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from geonet.operators import cells, chains, clip, cover, discs, dissolve, graph, intervals, noding, simplify, vertices
from geonet.operators.grid import any_box_pairs, box_pairs
from geonet.operators.scan import next_row, ordered_scan
from geonet.operators.skew import salted_join
from geonet.sources import geojson, manifest, tiles
from test_worked_values import ring_table, rows


def test_salted_join_equals_join(spark):
    many = spark.range(300).selectExpr("CASE WHEN id < 200 THEN 0 ELSE id % 40 END AS k", "id")
    few = spark.range(30).selectExpr("id AS k", "id * 2 AS v")
    for how in ("inner", "left"):
        want = rows(many.join(few, "k", how).fillna(-1), "k", "id", "v")
        assert rows(salted_join(many, few, ["k"], how, hot_rows=20).fillna(-1), "k", "id", "v") == want


def test_scan_equals_window(spark, forced_splits):
    d = spark.range(400).selectExpr("CASE WHEN id < 300 THEN 1 ELSE id % 5 + 2 END AS k", "CAST(id * 7919 % 401 AS INT) AS o", "id * 31 % 17 AS v")
    w = W.partitionBy("k").orderBy("o")
    above = w.rowsBetween(W.unboundedPreceding, -1)
    want = d.select("k", "o", F.coalesce(F.sum("v").over(above), F.lit(0)).alias("s"), F.max("v").over(above).alias("m"), F.lag("v").over(w).alias("p"))
    got = ordered_scan(d, ["k"], ["o"], F.floor(F.col("o") / 7), sums={"s": F.col("v")}, maxes={"m": F.col("v")}, previous={"p": "v"})
    cols = ("k", "o", "s", "m", "p")
    assert rows(got.fillna(-1), *cols) == rows(want.fillna(-1), *cols)


def test_next_row_across_blocks(spark):
    d = spark.range(50).selectExpr("id % 2 AS k", "CAST(floor(id / 2) AS INT) AS idx", "id AS v")
    got = rows(next_row(d, ["k"], "idx", ["v"], rows=4).fillna(-1), "k", "idx", "v", "next_v")
    assert got == sorted((v % 2, v // 2, v, v + 2 if v + 2 < 50 else -1) for v in range(50))


@pytest.mark.parametrize("hot", [None, 3])
def test_box_pairs(spark, hot):
    rng = random.Random(5)
    box = lambda: (x := rng.uniform(-50, 300), y := rng.uniform(-50, 300) if rng.random() < .5 else 7 + rng.random(), x + rng.uniform(0, 60), y + rng.uniform(0, 60))
    a, b = [(i, *box()) for i in range(80)], [(i, *box()) for i in range(80)]
    da = spark.createDataFrame(a, "i int, a0 double, a1 double, a2 double, a3 double")
    db = spark.createDataFrame(b, "j int, b0 double, b1 double, b2 double, b3 double")
    got = rows(box_pairs(da, db, ["a0", "a1", "a2", "a3"], ["b0", "b1", "b2", "b3"], 40.0, hot_rows=hot), "i", "j")
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert got == want
    assert rows(any_box_pairs(da, db, ["a0", "a1", "a2", "a3"], ["b0", "b1", "b2", "b3"], 5.0), "i", "j") == want


def test_merge_intervals_hot_key(spark, forced_splits):
    rng = random.Random(1)
    data = [("hot" if i < 150 else f"k{i % 7}", float(a := rng.randint(0, 400)), float(a + rng.randint(0, 6))) for i in range(220)]
    d = spark.createDataFrame(data, "k string, lo double, hi double")
    want = []
    for key in {r[0] for r in data}:
        cur = None
        for lo, hi in sorted((r[1], r[2]) for r in data if r[0] == key):
            if cur and lo <= cur[2]:
                cur[2] = max(cur[2], hi)
            else:
                want.append(cur := [key, lo, hi])
    want = sorted(map(tuple, want))
    assert rows(intervals.merge_intervals(d, ["k"], "lo", "hi", 16), "k", "lo", "hi") == want
    total = {r["k"]: r["measure"] for r in intervals.union_measure(d, ["k"], "lo", "hi", width=16).collect()}
    assert total == {k: pytest.approx(sum(h - l for kk, l, h in want if kk == k)) for k in total}


def test_covered_length_by_sampling(spark, segments, forced_splits):
    rng = random.Random(3)
    pt = lambda: (rng.uniform(0, 300), rng.uniform(0, 300))
    lines = [(i, 0, *pt(), *pt()) for i in range(8)]
    masks = [(*pt(), *pt(), rng.choice([5.0, 20.0])) for _ in range(25)] + [(10.0, 10.0, 10.0, 10.0, 30.0)] * 5
    m = spark.createDataFrame(masks, "x1 double, y1 double, x2 double, y2 double, r double")
    got = {r["line_id"]: r["rest"] for r in cover.covered_length(segments(lines), m, cell=50.0).collect()}
    ts = (np.arange(20_000) + 0.5) / 20_000
    for i, _, x1, y1, x2, y2 in lines:
        px, py = x1 + ts * (x2 - x1), y1 + ts * (y2 - y1)
        near = np.zeros(len(ts), bool)
        for a, b, c, d, r in masks:
            l2 = (c - a) ** 2 + (d - b) ** 2
            u = np.clip(((px - a) * (c - a) + (py - b) * (d - b)) / l2, 0, 1) if l2 else 0 * ts
            near |= np.hypot(px - a - u * (c - a), py - b - u * (d - b)) <= r
        assert got[i] == pytest.approx(1 - near.mean(), abs=2e-3)


def test_disc_union_dense(spark, points, monkeypatch):
    rng = random.Random(2)
    pts = [(100 + rng.random(), 100 + rng.random()) for _ in range(300)] + [(rng.uniform(0, 400), rng.uniform(0, 400)) for _ in range(60)]
    thin = discs.union_area(points(pts), [25, 60]).collect()
    kept = discs.thin_discs(points(pts), [25]).count()
    assert kept < len(pts) / 2
    monkeypatch.setattr(discs, "thin_discs", lambda p, radii: p.distinct().selectExpr(f"explode(array({', '.join(f'{float(r)}D' for r in radii)})) AS r", "x", "y"))
    full = {r["radius"]: r for r in discs.union_area(points(pts), [25, 60]).collect()}
    for r in thin:
        assert r["area"] == pytest.approx(full[r["radius"]]["area"], rel=1e-12) and r["arcs"] == full[r["radius"]]["arcs"]


def test_cell_area_tends_to_exact(points):
    pts = points([(x * 37 % 500, x * 91 % 500) for x in range(60)])
    exact = discs.union_area(pts, [45]).first()["area"]
    fine = cells.run_area(cells.disc_runs(pts, [45], 0.5), 0.5).first()["area"]
    assert fine == pytest.approx(exact, rel=1e-3)


def dijkstra(edges, sources, one_way=False):
    graph_, dist, heap = {}, {}, [(d, n) for n, d in sources.items()]
    for a, b, w in edges:
        graph_.setdefault(a, []).append((b, w))
        if not one_way:
            graph_.setdefault(b, []).append((a, w))
    heapq.heapify(heap)
    while heap:
        d, n = heapq.heappop(heap)
        if n in dist:
            continue
        dist[n] = d
        for m, w in graph_.get(n, []):
            if m not in dist:
                heapq.heappush(heap, (d + w, m))
    return dist


def test_graph_with_hub(spark, forced_splits):
    rng = random.Random(9)
    edges = [(0, i, float(rng.randint(1, 40))) for i in range(1, 40)] + [(rng.randint(1, 60), rng.randint(1, 60), float(rng.randint(1, 9))) for _ in range(60)]
    edges += [(100 + i, 101 + i, 1.0) for i in range(20)]
    edges = [e for e in edges if e[0] != e[1]]
    both = edges + [(b, a, w) for a, b, w in edges]
    d = spark.createDataFrame(both, "src long, dst long, len double")
    sources = {3: 2.0, 17: 0.5}
    s = spark.createDataFrame([*sources.items(), (3, 9.0)], "node long, d0 double")
    want = dijkstra(edges, sources)
    got = {r["node"]: r["d"] for r in graph.network_distance(d, s).collect()}
    assert got == pytest.approx(want)
    cut = {r["node"]: r["d"] for r in graph.network_distance(d, s, cutoff=12).collect()}
    assert cut == pytest.approx({n: v for n, v in want.items() if v <= 12})
    got = {r["node"]: r["d"] for r in graph.chain_distance(d, s).collect()}
    assert got == pytest.approx(want)
    cut = {r["node"]: r["d"] for r in graph.chain_distance(d, s, cutoff=12).collect()}
    assert cut == pytest.approx({n: v for n, v in want.items() if v <= 12})
    comp = {r["node"]: r["component"] for r in graph.connected_components(d).collect()}
    parent = {n: n for e in edges for n in e[:2]}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b, _ in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert comp == {n: root(n) for n in parent}


def test_distance_one_way_and_round(spark):
    """One-way streets, unequal lengths, cycles with and without a source, loops and a source without streets."""
    rng = random.Random(4)
    edges = [(i, i + 1, 1.0) for i in range(30)] + [(i + 1, i, 1.0 + (i == 12)) for i in range(30) if i != 7]
    edges += [(40 + i, 40 + (i + 1) % 9, 2.0) for i in range(9)] + [(40 + (i + 1) % 9, 40 + i, 2.0) for i in range(9)]
    edges += [(60 + i, 60 + (i + 1) % 5, 2.0) for i in range(5)] + [(60 + (i + 1) % 5, 60 + i, 2.0) for i in range(5)]
    edges += [(30, 70, 3.0), (70, 30, 3.0), (70, 71, 1.0), (71, 70, 1.0), (71, 30, 9.0), (30, 71, 9.0), (3, 3, 0.5)]
    rng.shuffle(edges)
    sources = {20: 0.25, 43: 1.0, 99: 4.0}
    d = spark.createDataFrame(edges, "src long, dst long, len double")
    s = spark.createDataFrame([*sources.items()], "node long, d0 double")
    want = dijkstra(edges, sources, one_way=True)
    for cutoff in (None, 6.0):
        got = {r["node"]: r["d"] for r in graph.chain_distance(d, s, cutoff).collect()}
        assert got == pytest.approx({n: v for n, v in want.items() if cutoff is None or v <= cutoff})
    assert graph.chain_distance(d.limit(0), s.limit(0)).count() == 0


def peucker(pts, tol):
    keep, todo = {0, len(pts) - 1}, [(0, len(pts) - 1)]
    while todo:
        i, j = todo.pop()
        best, at = 0.0, None
        for k in range(i + 1, j):
            (ax, ay), (bx, by), (x, y) = pts[i], pts[j], pts[k]
            l2 = (bx - ax) ** 2 + (by - ay) ** 2
            t = min(1, max(0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / l2)) if l2 else 0
            d = (ax + t * (bx - ax) - x) ** 2 + (ay + t * (by - ay) - y) ** 2
            if d > best:
                best, at = d, k
        if at is not None and best > tol * tol:
            keep.add(at)
            todo += [(i, at), (at, j)]
    return sorted(keep)


def test_simplify(spark, forced_splits):
    rng = random.Random(4)
    lines = {1: [(i * 10.0, rng.uniform(0, 40)) for i in range(40)], 2: [(0.0, 0.0), (5.0, 1.0)], 3: [(0.0, 0.0), (50.0, 50.0), (0.0, 0.0)]}
    d = spark.createDataFrame([(k, i, x, y) for k, pts in lines.items() for i, (x, y) in enumerate(pts)], "line_id int, idx int, x double, y double")
    got = rows(simplify.simplify_lines(d, 8.0), "line_id", "idx")
    assert got == sorted((k, i) for k, pts in lines.items() for i in peucker(pts, 8.0))


def test_merge_lines_random(segments, forced_splits):
    rng = random.Random(8)
    n = 60
    segs, x = [], 0.0
    order = rng.sample(range(n), n)
    for line in order:  # one long chain of lines in random order and direction, with several segments each
        pts = [(x + k, 0.0) for k in range(rng.randint(2, 4))]
        x = pts[-1][0]
        pts = pts[::-1] if rng.random() < 0.5 else pts
        segs += [(line, k, *a, *b) for k, (a, b) in enumerate(zip(pts, pts[1:]))]
    got = sorted(chains.merge_lines(segments(segs)).collect(), key=lambda r: r["seg_idx"])
    assert {r["chain_id"] for r in got} == {min(order[0], order[-1])}
    assert [r["seg_idx"] for r in got] == list(range(len(segs)))
    assert all(a["x2"] == b["x1"] for a, b in zip(got, got[1:]))


def winding_brute(px, py, rings):
    inside = False
    for pts in rings:
        c = False
        for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
            if (y1 > py) != (y2 > py) and px < x1 + (py - y1) / (y2 - y1) * (x2 - x1):
                c = not c
        inside ^= c
    return inside


def test_points_in_overlapping_areas(spark, forced_splits):
    rng = random.Random(6)

    def blob(cx, cy, r):
        pts = [(cx + rng.uniform(.3, 1) * r * math.cos(a / 20 * 2 * math.pi), cy + rng.uniform(.3, 1) * r * math.sin(a / 20 * 2 * math.pi)) for a in range(20)]
        return [*pts, pts[0]]

    areas = [[blob(rng.uniform(0, 500), rng.uniform(0, 500), 150), ] for _ in range(5)]
    rings = [(a, i, pts) for a, rs in enumerate(areas) for i, pts in enumerate(rs[:1])]
    pts = [(rng.uniform(-100, 700), rng.uniform(-100, 700)) for _ in range(400)]
    d = spark.createDataFrame(pts, "px double, py double")
    got = {(r["px"], r["py"]): r["wind"] for r in clip.winding(d, clip.area_edges(ring_table(spark, rings)), 60.0).collect()}
    for p in pts:
        assert got[p] == sum(winding_brute(*p, rs[:1]) for rs in areas)


def test_clip_inside_plus_outside_is_whole(spark, segments, forced_splits):
    rng = random.Random(7)
    lines = []
    for i in range(12):
        pts = [(rng.uniform(0, 4000), rng.uniform(0, 4000)) for _ in range(5)]
        lines += [(i, k, *a, *b) for k, (a, b) in enumerate(zip(pts, pts[1:]))]
    edges = clip.area_edges(ring_table(spark))
    pieces = clip.cut_pieces(segments(lines), edges).selectExpr("inside", "sqrt(pow(x2-x1, 2) + pow(y2-y1, 2)) AS l").groupBy("inside").sum("l").collect()
    whole = sum(math.dist(r[2:4], r[4:6]) for r in lines)
    assert sum(r[1] for r in pieces) == pytest.approx(whole)
    clipped = clip.clip_lines(segments(lines), edges)
    assert clipped.selectExpr("sum(sqrt(pow(x2-x1, 2) + pow(y2-y1, 2)))").first()[0] == pytest.approx(next(r[1] for r in pieces if r[0]))
    parts = clipped.groupBy("line_id", "part").agg(F.min("seg_idx"), F.count("*")).count()
    assert parts >= clipped.select("line_id").distinct().count()


def test_line_on_the_boundary_is_kept(spark, segments):
    got = clip.clip_lines(segments([(1, 0, 0, 500, 4000, 500)]), clip.area_edges(ring_table(spark)))
    assert rows(got, "x1", "x2") == [(500.0, 3500.0)]


def test_insert_vertices_blocks(spark, forced_splits):
    v = spark.createDataFrame([(1, i, float(i * 10), 0.0) for i in range(12)], "line_id int, idx int, x double, y double")
    s = spark.createDataFrame([(1, i % 11, round(.1 + .07 * (i // 11), 3)) for i in range(40)], "line_id int, seg_idx int, t double").selectExpr("*", "(seg_idx + t) * 10 AS x", "0D AS y")
    got = rows(vertices.insert_vertices(v, s, ["line_id"]), "idx", "x")
    assert [g[0] for g in got] == list(range(52)) and [g[1] for g in got] == sorted(g[1] for g in got)


def test_crossings_brute(segments, forced_splits):
    rng = random.Random(10)
    pt = lambda: (rng.uniform(0, 200), rng.uniform(0, 200))
    lines = [(i, 0, *pt(), *pt()) for i in range(25)]
    lines += [(100 + i, 0, *lines[3][2:]) for i in range(6)]  # copies
    want = set()
    for a in lines:
        for b in lines:
            r, s, q = (a[4] - a[2], a[5] - a[3]), (b[4] - b[2], b[5] - b[3]), (b[2] - a[2], b[3] - a[3])
            den = r[0] * s[1] - r[1] * s[0]
            if a[0] != b[0] and den:
                t, u = (q[0] * s[1] - q[1] * s[0]) / den, (q[0] * r[1] - q[1] * r[0]) / den
                if 1e-9 < t < 1 - 1e-9 and 0 <= u <= 1:
                    want.add((a[0], round(t, 6)))
    got = noding.crossings(segments(lines), cell=30.0)
    assert {(r["line_id"], round(r["t"], 6)) for r in got.collect()} == want


def test_nearest_brute(spark, segments, points, forced_splits):
    rng = random.Random(12)
    pts = [(rng.uniform(0, 200), rng.uniform(0, 200)) for _ in range(40)] + [(50.0, 50.0)] * 20
    lines = [(i // 2, i % 2, rng.uniform(0, 200), rng.uniform(0, 200), rng.uniform(0, 200), rng.uniform(0, 200)) for i in range(20)]
    got = {(r["px"], r["py"], r["line_id"]): (r["seg_idx"], r["raw_dist"]) for r in noding.nearest_on_each_line(points(pts), segments(lines), 20.0).collect()}
    k = 6371008.8 / 6378137.0  # near the equator a map unit is this many metres
    for x, y in set(pts):
        for line in range(10):
            best = None
            for _, seg, a, b, c, d in (r for r in lines if r[0] == line):
                t = min(1, max(0, ((x - a) * (c - a) + (y - b) * (d - b)) / ((c - a) ** 2 + (d - b) ** 2)))
                dist = math.hypot(a + t * (c - a) - x, b + t * (d - b) - y) * k
                if best is None or dist < best[1]:
                    best = (seg, dist)
            hit = got.get((x, y, line))
            assert (hit is not None) == (best[1] <= 20) or abs(best[1] - 20) < 1e-4
            if hit:
                assert hit[0] == best[0] and hit[1] == pytest.approx(best[1], abs=1e-4)


def test_dissolve_keeps_length(spark, segments, forced_splits):
    segs = segments([(i, 0, i * 10, 0, i * 10 + 10, 0) for i in range(30)] + [(90, 0, 0, 0, 10, 0)])
    attrs = segs.selectExpr("line_id", "CASE WHEN line_id BETWEEN 10 AND 14 THEN NULL ELSE 'a' END AS name", "line_id AS no")
    merged, lines = dissolve.dissolve_lines(segs, attrs, ["name"])
    assert rows(merged.fillna("-"), "component", "n_lines", "name", "no") == [(0, 11, "a", 0), (10, 5, "-", 10), (15, 15, "a", 15)]
    # The copy of line 0 lies on it and is kept once.
    assert lines.selectExpr("sum(abs(x2 - x1))").first()[0] == 300.0


def test_seating_against_dijkstra(spark, segments, points):
    from geonet.plans import seating

    roads = segments([(r * 100 + c, 0, c * 40, r * 40, c * 40 + 40, r * 40, "footway") for r in range(4) for c in range(4)]
                     + [(1000 + c * 100 + r, 0, c * 40, r * 40, c * 40, r * 40 + 40, "path") for c in range(5) for r in range(3)]
                     + [(5000, 0, 20, -10, 20, 130, "track"), (6000, 0, 900, 900, 950, 900, "service")])
    seats = points([(61, 3), (0, 118)])
    got = seating.seating_from(seats, roads, None)
    dist = {(r["node"]["kx"], r["node"]["ky"]): r["d"] for r in got.dist.collect()}
    e = [((r["src"]["kx"], r["src"]["ky"]), (r["dst"]["kx"], r["dst"]["ky"]), r["len"]) for r in got.edges.filter("fwd").collect()]
    snaps = noding.nearest_on_each_line(seats, got.edges.filter("fwd").selectExpr("line_id", "seg_idx", "road_type", "ax AS x1", "ay AS y1", "bx AS x2", "by AS y2"))
    sources = {}
    for r in graph.source_offsets(snaps).collect():
        sources[(r["node"]["kx"], r["node"]["ky"])] = r["d0"]
    want = dijkstra(e, sources)
    limit = 75 + max(w for _, _, w in e)
    assert dist == pytest.approx({n: d for n, d in want.items() if d <= limit}, abs=1e-6)
    # Every metre of road is coloured once; the far island has no road type.
    total = roads.selectExpr("sum(sqrt(pow(x2-x1, 2) + pow(y2-y1, 2)))").first()[0]
    assert got.pieces.selectExpr("sum(sqrt(pow(x2-x1, 2) + pow(y2-y1, 2)))").first()[0] == pytest.approx(total)
    island = got.lines.filter("x1 >= 900").collect()
    assert [(r["color"], r["road_type"], r["minzoom"]) for r in island] == [(0, None, 30)]


def test_files(spark, tmp_path):
    ok = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "w1", "properties": {"a": "x", "n": 3}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 2]], [[5, 5], [6, 6], [7, 7]]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [9, 8]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "GeometryCollection", "geometries": [
            {"type": "Point", "coordinates": [1, 1]}, {"type": "LineString", "coordinates": [[2, 2], [3, 3]]}]}}]}
    for name in ("b.geojson", "a_example.geojson", "RenderTest.geojson", "c.txt"):
        (tmp_path / name).write_text(json.dumps(ok))
    got = geojson.read_feature_files(spark, str(tmp_path), "routes").collect()
    assert len(got) == 4 and {r["feature_id"] for r in got} == {"w1", "b.geojson#1", "b.geojson#2", "b.geojson#3"}
    by = {r["geom_type"]: r["parts"] for r in got}
    assert [[tuple(p) for p in part] for part in by["MultiLineString"]] == [[(0.0, 0.0), (1.0, 2.0)], [(5.0, 5.0), (6.0, 6.0), (7.0, 7.0)]]
    assert [[tuple(p) for p in part] for part in by["GeometryCollection"]] == [[(1.0, 1.0)], [(2.0, 2.0), (3.0, 3.0)]]
    assert vertices.explode_lines(geojson.read_features(spark, str(tmp_path / "b.geojson"), "r")).groupBy("geom_type").count().count() == 3
    out = str(tmp_path / "out")
    geojson.write_features(geojson.read_features(spark, str(tmp_path / "b.geojson"), "r").filter("geom_type <> 'GeometryCollection'"), out)
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    want = {f["geometry"]["type"]: f["geometry"] for f in ok["features"]}
    assert len(lines) == 3 and all(f["geometry"] == want[f["geometry"]["type"]] for f in lines)
    assert geojson.read_features(spark, out, "r", by_line=True).count() == 3


def test_osm_file(spark, tmp_path):
    doc = {"elements": [{"type": "node", "id": 1, "lat": 48.2, "lon": 16.3, "tags": {"amenity": "bench"}},
                        {"type": "way", "id": 2, "tags": {"highway": "path"}, "geometry": [{"lat": 1, "lon": 2}, {"lat": 3, "lon": 4}]},
                        {"type": "way", "id": 3, "geometry": [{"lat": 0, "lon": 0}, {"lat": 0, "lon": 1}, {"lat": 1, "lon": 1}, {"lat": 0, "lon": 0}]}]}
    (tmp_path / "o.json").write_text(json.dumps(doc, indent=1))
    got = {r["osm_id"]: r for r in geojson.read_osm_elements(spark, str(tmp_path / "o.json")).collect()}
    assert [got[i]["geom_type"] for i in (1, 2, 3)] == ["Point", "LineString", "Polygon"]
    assert tuple(got[2]["parts"][0][1]) == (4.0, 3.0) and got[1]["tags"] == {"amenity": "bench"}


def test_check_documents(spark):
    bad = ["", "{nope", '{"type":"FeatureCollection"}', '{"type":"Feature"}', '{"features":[]}',
           '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":null}]}', '{"type":"FeatureCollection","features":[]}']
    d = geojson.check_documents(spark.createDataFrame([(i, t) for i, t in enumerate(bad)], "i int, text string"))
    assert [r["reason"] for r in d.orderBy("i").collect()] == [
        "empty", "invalid json", "no features", "not a collection", "no type", "feature without geometry", None]
    good, rest = geojson.good_and_bad(d)
    assert (good.count(), rest.count()) == (1, 6)


def test_unchanged_sync(spark):
    from geonet.plans import sync

    files = spark.createDataFrame([("a.geojson", "1"), ("b.geojson", "2")], "name string, etag string")
    features = spark.range(1).selectExpr("'a.geojson' AS file", "id AS feature_id", "array(array(struct(0D AS x, 0D AS y), struct(9D AS x, 9D AS y))) AS parts")
    assert sync.changed_file_sync(files, files, features) is None
    assert sync.changed_file_sync(files, files, features, published=False).count() > 0
    gone = manifest.manifest_diff(files, files.filter("name = 'a.geojson'"))
    assert rows(gone, "name", "status") == [("a.geojson", "unchanged"), ("b.geojson", "removed")]


def test_tile_cap_with_hot_tile(spark, forced_splits):
    t = spark.range(60).selectExpr("id", "1 AS z", "CASE WHEN id < 50 THEN 0 ELSE id END AS tx", "0 AS ty")
    assert rows(tiles.tile_feature_cap(t, 4, ["id"]).filter("tx = 0"), "id") == [(0,), (1,), (2,), (3,)]
    assert tiles.tile_feature_cap(t, None, ["id"]).count() == 60


def test_crowded_features_leave_a_tile_first(spark, forced_splits):
    """Forty points on one spot and nine far from it: the nine and one of the forty stay."""
    side = 2 * tiles.HALF / 2 ** 10
    pts = [(i, 0.3, 0.3) for i in range(40)] + [(100 + i, 0.1 + i % 3 * 0.35, 0.1 + i // 3 * 0.35) for i in range(9)]
    d = spark.createDataFrame([(i, x * side, -y * side) for i, x, y in pts], "id int, x double, y double")
    t = tiles.tile_features(d.selectExpr("id", "x AS minx", "y AS miny", "x AS maxx", "y AS maxy"), 10, 10)
    assert rows(tiles.tile_thin(t, 10, ["id"]), "id") == [(0,)] + [(100 + i,) for i in range(9)]
    assert tiles.tile_thin(t, None, ["id"]).count() == 49 and tiles.tile_thin(t.limit(0), 3, ["id"]).count() == 0


@pytest.mark.parametrize("name", ["classify_coverage", "merge_runs", "union_boundary", "clip_lines"])
def test_same_result_under_any_partitioning(spark, name):
    from geonet.queries import registry

    seen = []
    for n in ("1", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            d = registry()[name][0](spark, "/root/testdata/sf0.001")
            seen.append(sorted(map(str, d.select(*sorted(d.columns)).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]
