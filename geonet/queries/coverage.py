"""Raster and exact disc coverage, and clipping to an area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.fixtures import layer, with_layers
from geonet.operators import capsules, cells, clip, discs
from geonet.queries.lines import r, street_segments
from geonet.session import settle

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


# Cells of 5 m whose centre is within a radius of a point, by brute enumeration around each point.
DISC_CELLS = """near AS (SELECT cx, cy, min(pow((cx + 0.5) * 5 - x, 2) + pow((cy + 0.5) * 5 - y, 2)) AS d2 FROM (
  SELECT x, y, CAST(floor(x / 5) AS BIGINT) + dx AS cx, CAST(floor(y / 5) AS BIGINT) + dy AS cy
  FROM (SELECT DISTINCT x, y FROM fx_points), range(-15, 16) a(dx), range(-15, 16) b(dy)) GROUP BY 1, 2),
disc AS (SELECT radius, cx, cy FROM near, (VALUES (25), (45), (60), (70)) t(radius) WHERE d2 <= radius * radius)"""
ROAD_CELLS = """road AS (SELECT DISTINCT cx, cy FROM (
  SELECT x1, y1, x2, y2, unnest(range(CAST(floor((x1 - 15) / 5) AS BIGINT), CAST(floor((x2 + 15) / 5) AS BIGINT) + 1)) AS cx,
    CAST(floor((y1 - 15) / 5) AS BIGINT) AS c0, CAST(floor((y2 + 15) / 5) AS BIGINT) AS c1 FROM fx_streets) e, unnest(range(c0, c1 + 1)) u(cy)
  WHERE pow(greatest(x1 - (cx + 0.5) * 5, 0, (cx + 0.5) * 5 - x2), 2) + pow(greatest(y1 - (cy + 0.5) * 5, 0, (cy + 0.5) * 5 - y2), 2) <= 225)"""


def parking_runs(spark, sf) -> DataFrame:
    return cells.disc_runs(layer(spark, sf, "fx_points"))


@query("coverage_cells", with_layers("fx_points", f"WITH {DISC_CELLS} SELECT radius, count(*) AS cells, count(*) * 25.0 AS area FROM disc GROUP BY 1"))
def _(spark, sf):
    return cells.run_area(parking_runs(spark, sf))


@query("coverage_runs", with_layers("fx_points", f"""
WITH {DISC_CELLS} SELECT radius, cy, min(cx) AS c0, max(cx) + 1 AS c1 FROM (SELECT *, cx - row_number() OVER (PARTITION BY radius, cy ORDER BY cx) AS g FROM disc) GROUP BY radius, cy, g"""))
def _(spark, sf):
    return parking_runs(spark, sf)


@query("road_buffer", with_layers("fx_streets", f"WITH {ROAD_CELLS} SELECT cy, count(*) AS cells, min(cx) AS first, max(cx) AS last FROM road GROUP BY 1"))
def _(spark, sf):
    d = cells.road_runs(layer(spark, sf, "fx_streets"))
    return d.groupBy("cy").agg(F.expr("sum(c1 - c0) AS cells"), F.expr("min(c0) AS first"), F.expr("max(c1) - 1 AS last"))


def road_cover(spark, sf) -> DataFrame:
    return cells.intersect_runs(parking_runs(spark, sf), cells.road_runs(layer(spark, sf, "fx_streets")))


@query("cover_intersect", with_layers("fx_points fx_streets", f"""
WITH {DISC_CELLS}, {ROAD_CELLS} SELECT radius, count(*) AS cells, count(*) * 25.0 AS area FROM disc JOIN road USING (cx, cy) GROUP BY 1"""))
def _(spark, sf):
    return cells.run_area(road_cover(spark, sf))


@query("split_by_grid", with_layers("fx_points fx_streets", f"""
WITH {DISC_CELLS}, {ROAD_CELLS}, i AS (SELECT radius, cx, cy FROM disc JOIN road USING (cx, cy)),
box AS (SELECT radius, min(cx) * 5 AS minx, min(cy) * 5 AS miny, (max(cy) + 1) * 5 AS maxy FROM i GROUP BY 1)
SELECT concat('i', radius) AS layer, radius, CAST(floor(((cx + 0.5) * 5 - minx) / 512) * ceil((maxy - miny) / 512.0) + floor(((cy + 0.5) * 5 - miny) / 512) + 1 AS BIGINT) AS cell, count(*) AS cells
FROM i JOIN box USING (radius) GROUP BY 1, 2, 3"""))
def _(spark, sf):
    d = cells.split_by_grid(settle(road_cover(spark, sf), "cover"))
    return d.groupBy("layer", "radius", "cell").agg(F.expr("sum(c1 - c0) AS cells"))


def arcs_sql(radius: int) -> str:
    return f"""
p AS (SELECT DISTINCT x, y FROM fx_points),
iv AS (SELECT a.x, a.y, atan2(b.y - a.y, b.x - a.x) AS m, acos(sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) / {2 * radius}) AS h FROM p a JOIN p b
  ON b.x BETWEEN a.x - {2 * radius} AND a.x + {2 * radius} AND b.y BETWEEN a.y - {2 * radius} AND a.y + {2 * radius}
  AND (a.x <> b.x OR a.y <> b.y) AND pow(b.x - a.x, 2) + pow(b.y - a.y, 2) < {4 * radius * radius}),
un AS (SELECT x, y, m - h + 2 * pi() * k AS lo, m + h + 2 * pi() * k AS hi FROM iv, range(-1, 3) t(k)),
cut AS (SELECT x, y, greatest(lo, 0) AS lo, least(hi, 2 * pi()) AS hi FROM un WHERE hi > 0 AND lo < 2 * pi()
  UNION ALL SELECT x, y, 0, 0 FROM p UNION ALL SELECT x, y, 2 * pi(), 2 * pi() FROM p),
sc AS (SELECT *, max(hi) OVER (PARTITION BY x, y ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cut),
arcs AS (SELECT x, y, reach AS a0, lo AS a1 FROM sc WHERE lo > reach)"""


ARC_SUM = "sum((pow({r}, 2) * (a1 - a0) + {r} * x * (sin(a1) - sin(a0)) - {r} * y * (cos(a1) - cos(a0))) / 2)"


@query("union_boundary", with_layers("fx_points", f"WITH {arcs_sql(70)} SELECT x, y, round(a0, 6) + 0.0 AS a0, round(a1, 6) + 0.0 AS a1 FROM arcs WHERE a1 - a0 > 1e-6"))
def _(spark, sf):
    return discs.union_boundary(layer(spark, sf, "fx_points"), [70]).filter("a1 - a0 > 1e-6").selectExpr("x", "y", *r("a0", "a1"))


@query("union_area", with_layers("fx_points", " UNION ALL ".join(
    f"SELECT {radius} AS radius, round(area, 2) + 0.0 AS area, round(outline, 2) + 0.0 AS outline FROM (WITH {arcs_sql(radius)} "
    f"SELECT {ARC_SUM.format(r=radius)} AS area, sum({radius} * (a1 - a0)) AS outline FROM arcs)" for radius in cells.RADII)))
def _(spark, sf):
    return discs.union_area(layer(spark, sf, "fx_points"), cells.RADII).selectExpr("radius", "round(area, 2) + 0D AS area", "round(outline, 2) + 0D AS outline")


EDGES = """edges AS (SELECT * FROM (SELECT x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM fx_area WINDOW w AS (PARTITION BY area_id, ring ORDER BY idx)) WHERE x2 IS NOT NULL)"""
# Crossing parity of a ray to the right; the polygons do not overlap, so all edges count together.
PARITY = """{name} AS (SELECT id, count(e.x1) % 2 = 1 AS inside FROM {points} p LEFT JOIN edges e
  ON p.py >= least(e.y1, e.y2) AND p.py < greatest(e.y1, e.y2) AND p.px < e.x1 + (p.py - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) GROUP BY 1)"""
CLIP = f"""{EDGES},
hit AS (SELECT street_id, s.x1, s.y1, s.x2 - s.x1 AS rx, s.y2 - s.y1 AS ry, e.x1 AS ex, e.y1 AS ey, e.x2 - e.x1 AS sx, e.y2 - e.y1 AS sy FROM fx_streets s JOIN edges e
  ON s.x1 <= greatest(e.x1, e.x2) AND s.x2 >= least(e.x1, e.x2) AND s.y1 <= greatest(e.y1, e.y2) AND s.y2 >= least(e.y1, e.y2)),
tt AS (SELECT street_id, ((ex - x1) * sy - (ey - y1) * sx) / (rx * sy - ry * sx) AS t, ((ex - x1) * ry - (ey - y1) * rx) / (rx * sy - ry * sx) AS u FROM hit WHERE rx * sy - ry * sx <> 0),
ts AS (SELECT DISTINCT street_id, t FROM tt WHERE u BETWEEN 0 AND 1 AND t > 1e-9 AND t < 1 - 1e-9 UNION ALL SELECT street_id, 0 FROM fx_streets UNION ALL SELECT street_id, 1 FROM fx_streets),
pc AS (SELECT * FROM (SELECT street_id, t AS t0, lead(t) OVER (PARTITION BY street_id ORDER BY t) AS t1 FROM ts) WHERE t1 IS NOT NULL),
mid AS (SELECT street_id * 1000 + row_number() OVER (PARTITION BY street_id ORDER BY t0) AS id, street_id, t0, t1, x1, y1, x2, y2,
  x1 + (t0 + t1) / 2 * (x2 - x1) AS px, y1 + (t0 + t1) / 2 * (y2 - y1) AS py FROM pc JOIN fx_streets USING (street_id)),
{PARITY.format(name='inn', points='mid')},
clipped AS (SELECT street_id, t0, t1, x1 + t0 * (x2 - x1) AS x1, y1 + t0 * (y2 - y1) AS y1, x1 + t1 * (x2 - x1) AS x2, y1 + t1 * (y2 - y1) AS y2,
  row_number() OVER (PARTITION BY street_id ORDER BY t0) - 1 AS part FROM mid JOIN inn USING (id) WHERE inside)"""


def area(spark, sf) -> DataFrame:
    return clip.area_edges(layer(spark, sf, "fx_area"))


@query("inside_points", with_layers("fx_points fx_area", f"WITH {EDGES}, pts AS (SELECT point_id AS id, x AS px, y AS py FROM fx_points), {PARITY.format(name='inn', points='pts')} SELECT id AS point_id, inside FROM inn"))
def _(spark, sf):
    points = layer(spark, sf, "fx_points").selectExpr("point_id", "x AS px", "y AS py")
    return clip.inside_points(points, area(spark, sf)).select("point_id", "inside")


@query("clip_lines", with_layers("fx_streets fx_area", f"""
WITH {CLIP} SELECT street_id AS line_id, CAST(part AS INTEGER) AS part, round(x1, 6) + 0.0 AS x1, round(y1, 6) + 0.0 AS y1, round(x2, 6) + 0.0 AS x2, round(y2, 6) + 0.0 AS y2 FROM clipped"""))
def _(spark, sf):
    return clip.clip_lines(street_segments(spark, sf), area(spark, sf)).selectExpr("line_id", "part", *r("x1", "y1", "x2", "y2"))


@query("inside_area", with_layers("fx_streets fx_area", f"WITH {CLIP} SELECT street_id AS line_id FROM clipped GROUP BY 1 HAVING sum(t1 - t0) > 1 - 1e-9"))
def _(spark, sf):
    return clip.inside_lines(street_segments(spark, sf), area(spark, sf))


@query("clip_counts", with_layers("fx_streets fx_area", f"""
WITH {CLIP}, n AS (SELECT street_id, count(*) AS parts FROM clipped GROUP BY 1)
SELECT (SELECT count(*) FROM fx_streets) AS lines_before, count(*) AS lines_kept, (SELECT count(*) FROM fx_streets) - count(*) AS lines_dropped, sum(parts) AS parts_after, sum(parts - 1) AS split_parts FROM n"""))
def _(spark, sf):
    segs = street_segments(spark, sf)
    return clip.clip_counts(segs, clip.clip_lines(segs, area(spark, sf)))


@query("union_area_rings", with_layers("fx_points fx_area", f"""
WITH two AS (SELECT * FROM fx_area UNION ALL SELECT area_id + 1000000, ring, idx, x + 150, y + 200 FROM fx_area),
edges AS (SELECT * FROM (SELECT area_id, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM two WINDOW w AS (PARTITION BY area_id, ring ORDER BY idx)) WHERE x2 IS NOT NULL),
par AS (SELECT point_id, area_id, count(*) % 2 = 1 AS inside FROM fx_points JOIN edges ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) GROUP BY 1, 2)
SELECT point_id FROM par GROUP BY 1 HAVING bool_or(inside)"""))
def _(spark, sf):
    """Points inside the union of overlapping polygons: the boundaries and a shifted copy of each."""
    rings = layer(spark, sf, "fx_area")
    both = rings.unionByName(rings.selectExpr("area_id + 1000000 AS area_id", "ring", "idx", "x + 150 AS x", "y + 200 AS y"))
    points = layer(spark, sf, "fx_points").selectExpr("point_id", "x AS px", "y AS py")
    return clip.inside_points(points, clip.area_edges(both)).filter("inside").select("point_id")


# Every street is an edge of the 100 m lattice, so its buffer is 70 m between nodes and, in the four quarters around a
# node, a square where a street lies beside the quarter and a quarter disc where none does.
ROAD_QUARTERS = """ends AS (SELECT x1 AS x, y1 AS y, CASE WHEN x2 > x1 THEN 0 ELSE 1 END AS way FROM fx_streets
  UNION ALL SELECT x2, y2, CASE WHEN x2 > x1 THEN 2 ELSE 3 END FROM fx_streets),
nodes AS (SELECT x, y, bool_or(way = 0) AS e, bool_or(way = 1) AS n, bool_or(way = 2) AS w, bool_or(way = 3) AS s FROM ends GROUP BY 1, 2),
quarters AS (SELECT unnest([e::INT + n::INT, n::INT + w::INT, w::INT + s::INT, s::INT + e::INT]) AS beside FROM nodes)"""


@query("road_outline", with_layers("fx_streets", f"""
WITH {ROAD_QUARTERS}, q AS (SELECT sum(CASE WHEN beside > 0 THEN 225 ELSE pi() * 225 / 4 END) AS area,
  sum(CASE beside WHEN 0 THEN pi() * 15 / 2 WHEN 1 THEN 15 ELSE 0 END) AS outline FROM quarters)
SELECT round(area + (SELECT count(*) * 2100 FROM fx_streets), 2) + 0.0 AS area, round(outline + (SELECT count(*) * 140 FROM fx_streets), 2) + 0.0 AS outline FROM q"""))
def _(spark, sf):
    d = capsules.outline_measure(*capsules.buffer_outline(layer(spark, sf, "fx_streets"), cells.STREET_BUFFER))
    return d.selectExpr("round(area, 2) + 0D AS area", "round(outline, 2) + 0D AS outline")


def exact_cover(spark, sf) -> tuple[DataFrame, DataFrame]:
    return capsules.cover_outline(layer(spark, sf, "fx_points"), layer(spark, sf, "fx_streets"), cells.RADII, cells.STREET_BUFFER)


@query("cover_outline")
def _(spark, sf):
    """Road space within each radius of a point, exactly; tested against rasters, as its outline has no plain SQL form."""
    d = capsules.outline_measure(*exact_cover(spark, sf), ["radius"])
    return d.selectExpr("radius", "round(area, 2) + 0D AS area", "round(outline, 2) + 0D AS outline")


@query("cover_cells")
def _(spark, sf):
    """The same by grid cell."""
    d = capsules.cell_areas(*exact_cover(spark, sf), cells.GRID)
    return d.selectExpr("concat('i', radius) AS layer", "radius", "cell", "round(area, 2) + 0D AS area")
