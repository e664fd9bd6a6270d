"""Areas cut by tiles: hand-worked squares, holes, touching rings, far zoom levels; every ring is closed and in order."""

import math

import pytest

from geonet.sources import tiles

HALF = tiles.HALF


def ring(area_id, points):
    return [(area_id, *map(float, p), *map(float, q)) for p, q in zip(points, points[1:] + points[:1])]


def cut(spark, rows, zmin, zmax):
    d = spark.createDataFrame(rows, "area_id bigint, x1 double, y1 double, x2 double, y2 double")
    return tiles.tile_areas(d, ["area_id"], zmin, zmax)


def shoelace(rows):
    return sum(r[1] * r[4] - r[3] * r[2] for r in rows) / 2


def test_square_over_four_tiles(spark):
    rows = ring(1, [(-30, -10), (10, -10), (10, 20), (-30, 20)])
    d = tiles.tile_area_size(cut(spark, rows, 1, 1), ["area_id"])
    got = {(r.tx, r.ty): round(r.area, 4) for r in d.collect()}
    assert got == {(0, 0): 600.0, (1, 0): 200.0, (0, 1): 300.0, (1, 1): 100.0}


def test_border_on_tile_border(spark):
    """A square that is exactly one tile lies in that tile; the parts without area leave no ring."""
    s = 2 * HALF / 4
    rows = ring(1, [(0, 0), (s, 0), (s, s), (0, s)])
    parts = cut(spark, rows, 2, 2)
    area = {(r.tx, r.ty): r.area for r in tiles.tile_area_size(parts, ["area_id"]).collect()}
    assert math.isclose(area[(2, 1)], s * s, rel_tol=1e-12)
    assert all(abs(a) < 1e-12 * s * s for t, a in area.items() if t != (2, 1))
    assert {(r.tx, r.ty) for r in tiles.tile_rings(parts, ["area_id"]).collect()} == {(2, 1)}


@pytest.mark.parametrize("zoom", [3, 17])
def test_areas_sum_up(spark, zoom):
    """A star with a hole, and a copy of it moved over it: per zoom level the parts make the whole."""
    def star(r, n=9, turn=0.1, way=1):
        return [((r if i % 2 else r / 3) * math.cos(turn + way * i * math.pi / n) + 17, (r if i % 2 else r / 3) * math.sin(turn + way * i * math.pi / n) - 5)
                for i in range(2 * n)]
    rows = ring(1, star(400.0)) + ring(1, star(90.0, way=-1)) + ring(2, [(x + 33, y - 8) for x, y in star(400.0)])
    parts = cut(spark, rows, zoom, zoom)
    sizes = tiles.tile_area_size(parts, ["area_id"]).collect()
    for area_id in (1, 2):
        whole = shoelace([r for r in rows if r[0] == area_id])
        assert math.isclose(sum(r.area for r in sizes if r.area_id == area_id), whole, rel_tol=1e-7)
    size = 2 * HALF / 2 ** zoom
    assert all(-1e-3 <= r.area <= size * size * (1 + 1e-9) for r in sizes)
    rings = {}
    for r in tiles.tile_rings(parts, ["area_id"]).collect():
        rings.setdefault((r.area_id, r.tx, r.ty, r.ring), []).append(r)
    for rows_of in rings.values():
        rows_of.sort(key=lambda r: r.seq)
        assert [r.seq for r in rows_of] == list(range(len(rows_of)))
        assert all((p.x2, p.y2) == (q.x1, q.y1) for p, q in zip(rows_of, rows_of[1:] + rows_of[:1]))


def test_inner_tiles_and_touching_rings(spark):
    """Tiles wholly inside have four sides; rings that touch in a point keep the area."""
    rows = ring(1, [(-1000, -1000), (1000, -1000), (1000, 1000), (-1000, 1000)])
    parts = cut(spark, rows, 18, 18)
    rings = tiles.tile_rings(parts, ["area_id"]).groupBy("tx", "ty").count().collect()
    size = 2 * HALF / 2 ** 18
    side = 2 * math.ceil(1000 / size)
    assert len(rings) == side * side and all(r["count"] == 4 for r in rings)
    two = ring(1, [(10, 10), (20, 10), (20, 20), (10, 20)]) + ring(1, [(20, 20), (30, 20), (30, 30), (20, 30)])
    parts = cut(spark, two, 5, 5)
    assert parts.count() == 8 and tiles.tile_rings(parts, ["area_id"]).count() == 8


def test_empty_null_and_repeated(spark):
    assert cut(spark, [], 3, 5).count() == 0
    assert tiles.tile_rings(cut(spark, [], 3, 5), ["area_id"]).count() == 0
    square = ring(1, [(10, 10), (20, 10), (20, 20), (10, 20)])
    with_null = square + [(1, None, 0.0, 1.0, 1.0)]
    assert tiles.tile_area_size(cut(spark, with_null, 4, 4), ["area_id"]).first().area == pytest.approx(100)
    assert tiles.tile_area_size(cut(spark, square + square, 4, 4), ["area_id"]).first().area == pytest.approx(200)
