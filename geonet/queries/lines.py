"""Vertex, interval, box-join, coverage and matching operators over whole layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.fixtures import layer, with_layers
from geonet.functions import attributes as at
from geonet.operators import cover, intervals, match, noding, vertices as vx
from geonet.operators.grid import any_box_pairs, box_pairs, with_box

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


def r(*names: str) -> list[str]:
    """Six-decimal versions of columns; a negative zero becomes zero."""
    return [f"round({n}, 6) + 0D AS {n}" for n in names]


def q(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def oneway_segments(spark, sf, key: str = "line_id") -> DataFrame:
    return layer(spark, sf, "fx_oneway").selectExpr(f"oneway_id AS {key}", "0 AS seg_idx", "x1", "y1", "x2", "y2")


def street_segments(spark, sf, key: str = "line_id") -> DataFrame:
    return layer(spark, sf, "fx_streets").selectExpr(f"street_id AS {key}", "0 AS seg_idx", "x1", "y1", "x2", "y2", "road_type")


def path_segments(spark, sf) -> DataFrame:
    return vx.to_segments(layer(spark, sf, "fx_paths"))


PATH_SEGS = """path_segs AS (SELECT * FROM (SELECT line_id, part, idx AS seg_idx, x AS x1, y AS y1,
  lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM fx_paths WINDOW w AS (PARTITION BY line_id, part ORDER BY idx)) WHERE x2 IS NOT NULL)"""

# Part of segment a within r of segment b, by clipping the slab and the two discs; columns a1.. b1.. in, lo / hi out.
CAPSULE = """
SELECT *, least(CASE WHEN sl <= sh THEN sl END, CASE WHEN pl <= ph THEN pl END, CASE WHEN ql <= qh THEN ql END) AS lo,
  greatest(CASE WHEN sl <= sh THEN sh END, CASE WHEN pl <= ph THEN ph END, CASE WHEN ql <= qh THEN qh END) AS hi FROM (
SELECT *, greatest(0, ul, vl) AS sl, least(1, uh, vh) AS sh,
  CASE WHEN kp < 0 THEN 2 ELSE greatest(0, (-mp - sqrt(greatest(kp, 0))) / ee) END AS pl, CASE WHEN kp < 0 THEN -1 ELSE least(1, (-mp + sqrt(greatest(kp, 0))) / ee) END AS ph,
  CASE WHEN kq < 0 THEN 2 ELSE greatest(0, (-mq - sqrt(greatest(kq, 0))) / ee) END AS ql, CASE WHEN kq < 0 THEN -1 ELSE least(1, (-mq + sqrt(greatest(kq, 0))) / ee) END AS qh
FROM (SELECT *, mp * mp - ee * (u0 * u0 + v0 * v0 - r * r) AS kp, mq * mq - ee * ((u0 - bl) * (u0 - bl) + v0 * v0 - r * r) AS kq,
  CASE WHEN abs(du) < 1e-12 THEN CASE WHEN u0 >= 0 AND u0 <= bl THEN 0 ELSE 2 END ELSE least(-u0 / du, (bl - u0) / du) END AS ul,
  CASE WHEN abs(du) < 1e-12 THEN CASE WHEN u0 >= 0 AND u0 <= bl THEN 1 ELSE -1 END ELSE greatest(-u0 / du, (bl - u0) / du) END AS uh,
  CASE WHEN abs(dv) < 1e-12 THEN CASE WHEN abs(v0) <= r THEN 0 ELSE 2 END ELSE least((-r - v0) / dv, (r - v0) / dv) END AS vl,
  CASE WHEN abs(dv) < 1e-12 THEN CASE WHEN abs(v0) <= r THEN 1 ELSE -1 END ELSE greatest((-r - v0) / dv, (r - v0) / dv) END AS vh
FROM (SELECT *, du * du + dv * dv AS ee, u0 * du + v0 * dv AS mp, (u0 - bl) * du + v0 * dv AS mq
FROM (SELECT *, (ax1 - bx1) * ex + (ay1 - by1) * ey AS u0, (ay1 - by1) * ex - (ax1 - bx1) * ey AS v0,
  (ax2 - ax1) * ex + (ay2 - ay1) * ey AS du, (ay2 - ay1) * ex - (ax2 - ax1) * ey AS dv
FROM (SELECT *, (bx2 - bx1) / bl AS ex, (by2 - by1) / bl AS ey FROM (SELECT *, sqrt(pow(bx2 - bx1, 2) + pow(by2 - by1, 2)) AS bl FROM {pairs}))))))
"""


def capsule_sql(pairs: str) -> str:
    return CAPSULE.format(pairs=pairs).strip()


def near_sql(a: str, akey: str, b: str, bkey: str, r: str, grow: float = 25.0) -> str:
    """Pairs of segments whose boxes, grown, meet."""
    return f"""(SELECT a.{akey} AS ak, b.{bkey} AS bk, {r} AS r, a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2
FROM {a} a JOIN {b} b ON least(a.x1, a.x2) <= greatest(b.x1, b.x2) + {grow} AND least(b.x1, b.x2) <= greatest(a.x1, a.x2) + {grow}
  AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) + {grow} AND least(b.y1, b.y2) <= greatest(a.y1, a.y2) + {grow})"""


def cover_sql(ivs: str, keys: str) -> str:
    """Length of the union of [lo, hi] per key."""
    return f"""SELECT {keys}, sum(greatest(0, hi - greatest(lo, coalesce(reach, lo)))) AS m FROM (
  SELECT *, max(hi) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {ivs}) GROUP BY {keys}"""


MASK_R = """widths AS (SELECT x1, y1, x2, y2, mask_id, CASE WHEN feature_id NOT LIKE 'RADWEGE%' THEN 5.0 WHEN submerkmal = 'Baulicher Radweg' THEN 20.0 ELSE 5.0 END AS r
FROM fx_masks WHERE feature_id NOT LIKE 'RADWEGE%' OR submerkmal IN ('Baulicher Radweg', 'Radfahren gegen die Einbahn'))"""
COVERED = f"""WITH {MASK_R}, ivs AS (SELECT ak, lo, hi FROM ({capsule_sql(near_sql('fx_oneway', 'oneway_id', 'widths', 'mask_id', 'b.r'))}) WHERE lo <= hi),
cov AS ({cover_sql('ivs', 'ak')}),
lens AS (SELECT oneway_id, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM fx_oneway),
res AS (SELECT oneway_id AS line_id, len AS length, len * coalesce(m, 0) AS covered, 1 - coalesce(m, 0) AS rest FROM lens LEFT JOIN cov ON ak = oneway_id)
"""


@query("explode_lines", with_layers("fx_streets", """
SELECT street_id, 0 AS part, 0 AS idx, x1 AS x, y1 AS y FROM fx_streets UNION ALL SELECT street_id, 0, 1, x2, y2 FROM fx_streets"""))
def _(spark, sf):
    parts = "array(array(struct(x1 AS x, y1 AS y), struct(x2 AS x, y2 AS y)), array(struct(x1 AS x, y1 AS y)))"
    return vx.explode_lines(layer(spark, sf, "fx_streets").selectExpr("street_id", f"{parts} AS parts"))


@query("explode_points", with_layers("fx_points", "SELECT point_id, 0 AS part, 0 AS idx, x, y FROM fx_points"))
def _(spark, sf):
    return vx.explode_points(layer(spark, sf, "fx_points").selectExpr("point_id", "array(array(struct(x, y))) AS parts"))


@query("feature_segments", with_layers("fx_streets", "SELECT street_id, 0 AS part, 0 AS seg_idx, x1, y1, x2, y2 FROM fx_streets"))
def _(spark, sf):
    return vx.feature_segments(layer(spark, sf, "fx_streets").selectExpr("street_id", "array(array(struct(x1 AS x, y1 AS y), struct(x2 AS x, y2 AS y))) AS parts"))


@query("to_segments", with_layers("fx_paths", f"""
WITH {PATH_SEGS} SELECT line_id, part, seg_idx, x1, y1, x2, y2, round(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 6) + 0.0 AS len,
  least(x1, x2) - 5 AS minx, least(y1, y2) - 5 AS miny, greatest(x1, x2) + 5 AS maxx, greatest(y1, y2) + 5 AS maxy FROM path_segs"""))
def _(spark, sf):
    d = vx.to_segments(layer(spark, sf, "fx_paths"), grow=5.0)
    return d.selectExpr("line_id", "part", "seg_idx", "x1", "y1", "x2", "y2", *r("len"), "minx", "miny", "maxx", "maxy")


@query("bbox", with_layers("fx_paths", "SELECT line_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM fx_paths GROUP BY 1"))
def _(spark, sf):
    return vx.bbox(layer(spark, sf, "fx_paths"), ["line_id"])


@query("representative_point", with_layers("fx_paths", "SELECT line_id, (min(x) + max(x)) / 2 AS x, (min(y) + max(y)) / 2 AS y FROM fx_paths GROUP BY 1"))
def _(spark, sf):
    return vx.representative_point(layer(spark, sf, "fx_paths"), "line_id")


@query("ring_area", with_layers("fx_area", """
SELECT area_id, ring, round(sum(x * ny - nx * y) / 2, 4) + 0.0 AS area FROM (
  SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM fx_area WINDOW w AS (PARTITION BY area_id, ring ORDER BY idx)) GROUP BY 1, 2"""))
def _(spark, sf):
    d = vx.ring_area(layer(spark, sf, "fx_area"), ["area_id", "ring"])
    return d.selectExpr("area_id", "ring", "round(area, 4) + 0D AS area")


@query("close_rings", with_layers("fx_paths", """
SELECT line_id, idx, x, y FROM fx_paths UNION ALL
SELECT p.line_id, m.n + 1, p.x, p.y FROM fx_paths p JOIN (SELECT line_id, max(idx) AS n FROM fx_paths GROUP BY 1) m USING (line_id) WHERE p.idx = 0 AND m.n >= 2"""))
def _(spark, sf):
    """Paths turned into rings by going back to their start."""
    return vx.close_rings(layer(spark, sf, "fx_paths").select("line_id", "idx", "x", "y"), ["line_id"])


@query("orient_rings", with_layers("fx_area", """
WITH a AS (SELECT area_id, ring, sum(x * ny - nx * y) AS area FROM (
  SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM fx_area WINDOW w AS (PARTITION BY area_id, ring ORDER BY idx)) GROUP BY 1, 2),
n AS (SELECT area_id, ring, max(idx) AS n FROM fx_area GROUP BY 1, 2)
SELECT f.area_id, f.ring, CASE WHEN (a.area > 0) = (1 - f.ring = 0) THEN f.idx ELSE n.n - f.idx END AS idx, x, y
FROM fx_area f JOIN a USING (area_id, ring) JOIN n USING (area_id, ring)"""))
def _(spark, sf):
    """Boundary rings with the roles of outline and hole swapped, so that both must turn."""
    return vx.orient_rings(layer(spark, sf, "fx_area"), ["area_id", "ring"], hole="ring = 0")


@query("bbox_tests", with_layers("fx_masks fx_area", """
WITH b AS (SELECT area_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM fx_area GROUP BY 1),
m AS (SELECT mask_id, least(x1, x2) AS ax, least(y1, y2) AS ay, greatest(x1, x2) AS ux, greatest(y1, y2) AS uy FROM fx_masks)
SELECT mask_id, area_id, ax >= minx AND ay >= miny AND ux <= maxx AND uy <= maxy AS covered
FROM m JOIN b ON ax <= maxx AND ux >= minx AND ay <= maxy AND uy >= miny"""))
def _(spark, sf):
    """Masks against boundary boxes: overlapping pairs, and whether the boundary's box covers the mask's."""
    a, a_box = with_box(layer(spark, sf, "fx_masks").select("mask_id", "x1", "y1", "x2", "y2"), "m_")
    b = vx.bbox(layer(spark, sf, "fx_area"), ["area_id"])
    d = any_box_pairs(a, b, a_box, ["minx", "miny", "maxx", "maxy"], 100.0)
    return d.selectExpr("mask_id", "area_id", "m_minx >= minx AND m_miny >= miny AND m_maxx <= maxx AND m_maxy <= maxy AS covered")


@query("spatial_grid_join", with_layers("fx_points fx_streets", """
SELECT point_id, street_id FROM fx_points p JOIN fx_streets s ON p.x - 20 <= greatest(x1, x2) AND p.x + 20 >= least(x1, x2)
  AND p.y - 20 <= greatest(y1, y2) AND p.y + 20 >= least(y1, y2)"""))
def _(spark, sf):
    a = layer(spark, sf, "fx_points").selectExpr("point_id", "x - 20 AS a0", "y - 20 AS a1", "x + 20 AS a2", "y + 20 AS a3")
    b, box = with_box(layer(spark, sf, "fx_streets").select("street_id", "x1", "y1", "x2", "y2"))
    return box_pairs(a, b, ["a0", "a1", "a2", "a3"], box, 100.0).select("point_id", "street_id")


@query("capsule_interval", with_layers("fx_oneway fx_masks", f"""
WITH {MASK_R}, c AS ({capsule_sql(near_sql('fx_oneway', 'oneway_id', 'widths', 'mask_id', 'b.r'))})
SELECT ak AS line_id, round(min(lo), 6) + 0.0 AS first, round(max(hi), 6) + 0.0 AS last, count(*) AS n FROM c WHERE lo <= hi GROUP BY 1"""))
def _(spark, sf):
    """Per one-way the first and last covered position and the number of masks in reach."""
    masks = at.lookup_width(layer(spark, sf, "fx_masks"))
    d = cover.near_intervals(oneway_segments(spark, sf), masks, ["line_id"])
    return d.groupBy("line_id").agg(F.min("t0").alias("first"), F.max("t1").alias("last"), F.count(F.lit(1)).alias("n")).selectExpr(
        "line_id", *r("first", "last"), "n")


@query("covered_length", with_layers("fx_oneway fx_masks", COVERED + f"SELECT line_id, {q('length', 'covered', 'rest')} FROM res"))
def _(spark, sf):
    masks = at.lookup_width(layer(spark, sf, "fx_masks"))
    return cover.covered_length(oneway_segments(spark, sf), masks).selectExpr("line_id", *r("length", "covered", "rest"))


@query("classify_coverage", with_layers("fx_oneway fx_masks", COVERED + """
SELECT line_id, round(rest, 6) + 0.0 AS rest, CASE WHEN round(rest, 9) <= 0.36 THEN 'ja' ELSE 'nein' END AS rge FROM res"""))
def classify(spark, sf):
    masks = at.lookup_width(layer(spark, sf, "fx_masks"))
    return cover.classify_coverage(oneway_segments(spark, sf), masks).selectExpr("line_id", *r("rest"), "rge")


MATCH = f"""WITH near AS {near_sql('fx_oneway', 'oneway_id', 'fx_streets', 'street_id', '2', 2)},
fwd AS (SELECT ak, bk, lo, hi FROM ({capsule_sql('near')}) WHERE lo <= hi),
rev AS (SELECT bk AS ak, ak AS bk, r, bx1 AS ax1, by1 AS ay1, bx2 AS ax2, by2 AS ay2, ax1 AS bx1, ay1 AS by1, ax2 AS bx2, ay2 AS by2 FROM near),
bwd AS (SELECT bk AS ak, ak AS bk, lo, hi FROM ({capsule_sql('rev')}) WHERE lo <= hi),
pairs AS (SELECT fwd.ak AS oneway_id, fwd.bk AS street_id, 100 * (bwd.hi - bwd.lo) AS overlap, bwd.hi - bwd.lo AS street_share, fwd.hi - fwd.lo AS oneway_share
  FROM fwd JOIN bwd USING (ak, bk)),
matched AS (SELECT p.* FROM pairs p JOIN fx_streets s USING (street_id) JOIN fx_oneway o USING (oneway_id)
  WHERE round(street_share, 9) >= 0.6 AND round(oneway_share, 9) >= 0.85 AND
  sqrt(pow(least(greatest(s.x1, s.x2), greatest(o.x1, o.x2) + 2) - greatest(least(s.x1, s.x2), least(o.x1, o.x2) - 2), 2)
  + pow(least(greatest(s.y1, s.y2), greatest(o.y1, o.y2) + 2) - greatest(least(s.y1, s.y2), least(o.y1, o.y2) - 2), 2)) / 100 + 0.05 >= 0.6),
best AS (SELECT oneway_id, min_by(street_id, (-round(overlap, 9), street_id)) AS street_id, max(overlap) AS overlap FROM matched GROUP BY 1)
"""


@query("match_lines", with_layers("fx_oneway fx_streets", MATCH + f"SELECT oneway_id, street_id, {q('overlap', 'street_share', 'oneway_share')} FROM matched"))
def _(spark, sf):
    d = match.match_lines(oneway_segments(spark, sf, "oneway_id"), street_segments(spark, sf, "street_id"))
    return d.selectExpr("oneway_id", "street_id", *r("overlap", "street_share", "oneway_share"))


@query("best_match", with_layers("fx_oneway fx_streets", MATCH + f"SELECT oneway_id, street_id, {q('overlap')} FROM best"))
def _(spark, sf):
    d = match.match_best(oneway_segments(spark, sf, "oneway_id"), street_segments(spark, sf, "street_id"))
    return d.selectExpr("oneway_id", "street_id", *r("overlap"))


@query("distinct_matched", with_layers("fx_oneway fx_streets", MATCH + "SELECT DISTINCT street_id FROM matched"))
def _(spark, sf):
    streets = street_segments(spark, sf, "street_id")
    pairs = match.match_lines(oneway_segments(spark, sf, "oneway_id"), streets)
    return streets.select("street_id").join(pairs, "street_id", "left_semi")


@query("merge_intervals", """
WITH v AS (SELECT l_suppkey AS k, CAST(l_partkey AS DOUBLE) AS lo, l_partkey + l_quantity AS hi FROM lineitem),
s AS (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS isle FROM s)
SELECT k, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY k, isle""")
def _(spark, sf):
    return intervals.merge_intervals(part_ranges(spark, sf), ["k"], "lo", "hi", 64)


def part_ranges(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_suppkey AS k", "CAST(l_partkey AS DOUBLE) AS lo", "l_partkey + l_quantity AS hi")


@query("interval_gaps", """
WITH v AS (SELECT l_suppkey AS k, CAST(l_partkey AS DOUBLE) AS lo, l_partkey + l_quantity AS hi FROM lineitem),
s AS (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v)
SELECT k, coalesce(reach, -10) AS lo, lo AS hi FROM s WHERE lo > coalesce(reach, -10)
UNION ALL SELECT k, max(hi), 1e9 FROM v GROUP BY k""")
def _(spark, sf):
    return intervals.gaps(part_ranges(spark, sf), ["k"], "lo", "hi", F.lit(-10.0), F.lit(1e9), 64)


@query("dedupe_splits", """
WITH RECURSIVE v AS (SELECT DISTINCT l_suppkey AS line_id, CAST(floor(l_partkey / 100) AS BIGINT) AS seg_idx, l_extendedprice / 100000 AS t FROM lineitem),
k AS (SELECT line_id, seg_idx, min(t) AS t FROM v GROUP BY 1, 2
  UNION ALL SELECT k.line_id, k.seg_idx, min(v.t) FROM k JOIN v ON v.line_id = k.line_id AND v.seg_idx = k.seg_idx AND v.t - k.t >= 0.01 GROUP BY 1, 2)
SELECT * FROM k""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_suppkey AS line_id", "CAST(floor(l_partkey / 100) AS BIGINT) AS seg_idx", "l_extendedprice / 100000 AS t")
    return intervals.dedupe_splits(d, ["line_id", "seg_idx"], "t", 0.01)


SPLITS = """splits AS (SELECT DISTINCT CAST(floor(l_orderkey / 8) AS BIGINT) AS line_id, l_orderkey % 8 AS seg_idx, l_discount AS t
FROM lineitem JOIN fx_paths n ON n.line_id = CAST(floor(l_orderkey / 8) AS BIGINT) AND n.idx = l_orderkey % 8 + 1 WHERE l_discount > 0),
cuts AS (SELECT s.line_id, s.seg_idx, s.t, a.x + s.t * (b.x - a.x) AS x, a.y + s.t * (b.y - a.y) AS y FROM splits s
JOIN fx_paths a ON a.line_id = s.line_id AND a.idx = s.seg_idx JOIN fx_paths b ON b.line_id = s.line_id AND b.idx = s.seg_idx + 1)"""


def path_splits(spark, sf) -> DataFrame:
    """Cut points on the paths, placed by the discounts of the orders' lines."""
    seg = path_segments(spark, sf).select("line_id", "seg_idx", "x1", "y1", "x2", "y2")
    d = spark.read.parquet(f"{sf}/lineitem.parquet").filter("l_discount > 0").selectExpr(
        "CAST(floor(l_orderkey / 8) AS BIGINT) AS line_id", "CAST(l_orderkey % 8 AS INT) AS seg_idx", "l_discount AS t").distinct()
    return d.join(seg, ["line_id", "seg_idx"]).selectExpr("line_id", "seg_idx", "t", "x1 + t * (x2 - x1) AS x", "y1 + t * (y2 - y1) AS y")


@query("insert_vertices", with_layers("fx_paths", f"""
WITH {SPLITS}, u AS (SELECT line_id, idx AS seg_idx, 0 AS t, x, y FROM fx_paths UNION ALL SELECT * FROM cuts)
SELECT line_id, row_number() OVER (PARTITION BY line_id ORDER BY seg_idx, t) - 1 AS idx, {q('x', 'y')} FROM u"""))
def _(spark, sf):
    d = vx.insert_vertices(layer(spark, sf, "fx_paths").select("line_id", "idx", "x", "y"), path_splits(spark, sf), ["line_id"])
    return d.selectExpr("line_id", "idx", *r("x", "y"))


@query("split_lines", with_layers("fx_paths", f"""
WITH {SPLITS}, u AS (SELECT line_id, idx AS seg_idx, 0 AS t, x, y, 0 AS cut FROM fx_paths UNION ALL SELECT *, 1 FROM cuts),
s AS (SELECT line_id, seg_idx, t, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, sum(cut) OVER w AS piece FROM u WINDOW w AS (PARTITION BY line_id ORDER BY seg_idx, t))
SELECT line_id, CAST(piece AS INTEGER) AS piece, row_number() OVER (PARTITION BY line_id, piece ORDER BY seg_idx, t) - 1 AS seg_idx, {q('x1', 'y1', 'x2', 'y2')} FROM s WHERE x2 IS NOT NULL"""))
def _(spark, sf):
    seg = path_segments(spark, sf).select("line_id", "seg_idx", "x1", "y1", "x2", "y2")
    d = vx.split_lines(seg, path_splits(spark, sf))
    return d.selectExpr("line_id", "piece", "seg_idx", *r("x1", "y1", "x2", "y2"))


@query("split_at_nodes", with_layers("fx_paths fx_points", f"""
WITH {PATH_SEGS}, nodes AS (SELECT DISTINCT floor(x / 50.0 + 0.5) AS kx, floor(y / 50.0 + 0.5) AS ky FROM fx_points),
f AS (SELECT line_id, seg_idx, x1, y1, x2, y2, CASE WHEN seg_idx > 0 AND kx IS NOT NULL THEN 1 ELSE 0 END AS cut
  FROM path_segs LEFT JOIN nodes ON kx = floor(x1 / 50.0 + 0.5) AND ky = floor(y1 / 50.0 + 0.5)),
p AS (SELECT *, sum(cut) OVER (PARTITION BY line_id ORDER BY seg_idx) AS piece FROM f)
SELECT line_id, CAST(piece AS INTEGER) AS piece, row_number() OVER (PARTITION BY line_id, piece ORDER BY seg_idx) - 1 AS seg_idx, x1, y1, x2, y2 FROM p"""))
def _(spark, sf):
    seg = path_segments(spark, sf).select("line_id", "seg_idx", "x1", "y1", "x2", "y2")
    nodes = layer(spark, sf, "fx_points").selectExpr(f"{vx.node_key('x', 'y', 50.0)} AS node")
    return vx.split_at_nodes(seg, nodes, 50.0)


SYNC = """
proj AS (SELECT DISTINCT s.street_id, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS t, x1, y1, x2, y2, px, py
  FROM (SELECT DISTINCT px, py FROM (SELECT x1 AS px, y1 AS py FROM fx_oneway UNION ALL SELECT x2, y2 FROM fx_oneway)) e
  JOIN fx_streets s ON px BETWEEN least(x1, x2) - 1.5 AND greatest(x1, x2) + 1.5 AND py BETWEEN least(y1, y2) - 1.5 AND greatest(y1, y2) + 1.5),
cut AS (SELECT DISTINCT street_id, t, x1 + t * (x2 - x1) AS x, y1 + t * (y2 - y1) AS y FROM proj WHERE t BETWEEN 0 AND 1
  AND pow(px - x1 - t * (x2 - x1), 2) + pow(py - y1 - t * (y2 - y1), 2) <= 2.25 AND t * 100 >= 0.01 AND (1 - t) * 100 >= 0.01)"""


@query("sync_nodes", with_layers("fx_oneway fx_streets", f"""
WITH {SYNC}, u AS (SELECT street_id, 0.0 AS t, x1 AS x, y1 AS y FROM fx_streets UNION ALL SELECT street_id, 1.0, x2, y2 FROM fx_streets UNION ALL SELECT * FROM cut)
SELECT * FROM (SELECT street_id AS line_id, CAST(row_number() OVER w - 1 AS INTEGER) AS piece, {q('x', 'y').replace(' AS x', ' AS x1').replace(' AS y', ' AS y1')},
  round(lead(x) OVER w, 6) + 0.0 AS x2, round(lead(y) OVER w, 6) + 0.0 AS y2 FROM u WINDOW w AS (PARTITION BY street_id ORDER BY t)) WHERE x2 IS NOT NULL"""))
def _(spark, sf):
    """Streets split where one-way ends lie within 1.5 of them."""
    d = noding.sync_nodes(oneway_segments(spark, sf), street_segments(spark, sf), 1.5)
    return d.selectExpr("line_id", "piece", *r("x1", "y1", "x2", "y2"))


@query("node_degree", with_layers("fx_streets fx_paths", f"""
WITH {PATH_SEGS}, v AS (SELECT 2 * street_id AS line_id, 0 AS i, x1 AS x, y1 AS y FROM fx_streets UNION ALL SELECT 2 * street_id, 1, x2, y2 FROM fx_streets
  UNION ALL SELECT 2 * line_id + 1, idx, x, y FROM fx_paths WHERE line_id IN (SELECT line_id FROM path_segs))
SELECT CAST(floor(x / 1.5 + 0.5) AS BIGINT) AS kx, CAST(floor(y / 1.5 + 0.5) AS BIGINT) AS ky, count(DISTINCT line_id) AS degree,
  min_by(x, (line_id, i)) AS x, min_by(y, (line_id, i)) AS y FROM v GROUP BY 1, 2"""))
def _(spark, sf):
    d = noding.node_degree(network_segments(spark, sf))
    return d.selectExpr("node.kx AS kx", "node.ky AS ky", "degree", "x", "y")


def network_segments(spark, sf) -> DataFrame:
    """Streets and footpaths in one layer; streets get even, paths odd ids."""
    a = layer(spark, sf, "fx_streets").selectExpr("2 * street_id AS line_id", "0 AS seg_idx", "road_type", "x1", "y1", "x2", "y2")
    b = path_segments(spark, sf).selectExpr("2 * line_id + 1 AS line_id", "seg_idx", "'path' AS road_type", "x1", "y1", "x2", "y2")
    return a.unionByName(b)


NETWORK = """net AS (SELECT 2 * street_id AS line_id, 0 AS seg_idx, road_type, x1, y1, x2, y2 FROM fx_streets
  UNION ALL SELECT 2 * line_id + 1, seg_idx, 'path', x1, y1, x2, y2 FROM path_segs)"""


@query("true_intersections", with_layers("fx_streets", """
WITH v AS (SELECT street_id, x1 AS x, y1 AS y, x2 AS fx, y2 AS fy FROM fx_streets UNION ALL SELECT street_id, x2, y2, x1, y1 FROM fx_streets)
SELECT x, y FROM v GROUP BY x, y HAVING count(DISTINCT atan2(fy - y, fx - x)) >= 3"""))
def _(spark, sf):
    """Lattice nodes: directions are right angles apart, so distinct directions can be counted."""
    return noding.true_intersections(street_segments(spark, sf)).select("x", "y")


CROSS = """
pairs AS (SELECT a.line_id AS al, a.seg_idx AS ai, b.line_id AS bl, b.seg_idx AS bi, a.x1 AS ax, a.y1 AS ay, b.x1 AS cx, b.y1 AS cy,
  a.x2 - a.x1 AS rx, a.y2 - a.y1 AS ry, b.x2 - b.x1 AS sx, b.y2 - b.y1 AS sy FROM net a JOIN net b ON (a.line_id, a.seg_idx) < (b.line_id, b.seg_idx)
  AND least(a.x1, a.x2) <= greatest(b.x1, b.x2) AND least(b.x1, b.x2) <= greatest(a.x1, a.x2) AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND least(b.y1, b.y2) <= greatest(a.y1, a.y2)),
met AS (SELECT *, ((cx - ax) * sy - (cy - ay) * sx) / (rx * sy - ry * sx) AS t, ((cx - ax) * ry - (cy - ay) * rx) / (rx * sy - ry * sx) AS u FROM pairs WHERE rx * sy - ry * sx <> 0),
both_ AS (SELECT al AS line_id, ai AS seg_idx, t, ax + t * rx AS x, ay + t * ry AS y FROM met WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1
  UNION ALL SELECT bl, bi, u, ax + t * rx, ay + t * ry FROM met WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1)"""


@query("crossings", with_layers("fx_streets fx_paths", f"""
WITH {PATH_SEGS}, {NETWORK}, {CROSS}
SELECT DISTINCT line_id, seg_idx, round(t, 9) + 0.0 AS t, round(x, 9) + 0.0 AS x, round(y, 9) + 0.0 AS y FROM both_ WHERE t > 1e-9 AND t < 1 - 1e-9"""))
def _(spark, sf):
    return noding.crossings(network_segments(spark, sf)).selectExpr("line_id", "seg_idx", *[f"round({c}, 9) + 0D AS {c}" for c in "txy"])


@query("nearest_on_each_line", with_layers("fx_points fx_streets", """
WITH c AS (SELECT x AS px, y AS py, street_id, road_type, x1, y1, x2, y2, least(1, greatest(0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / 10000)) AS t
  FROM (SELECT DISTINCT x, y FROM fx_points) p JOIN fx_streets s ON x BETWEEN least(x1, x2) - 40 AND greatest(x1, x2) + 40 AND y BETWEEN least(y1, y2) - 40 AND greatest(y1, y2) + 40),
d AS (SELECT *, x1 + t * (x2 - x1) AS x, y1 + t * (y2 - y1) AS y FROM c),
e AS (SELECT *, %s AS raw_dist, CASE road_type WHEN 'footway' THEN 2.0 WHEN 'service' THEN 3.0 WHEN 'residential' THEN 3.0 WHEN 'primary' THEN 6.0 ELSE 2.5 END AS free_offset FROM d)
SELECT px, py, street_id AS line_id, round(t, 6) + 0.0 AS t, round(raw_dist, 6) + 0.0 AS raw_dist, free_offset, round(greatest(0, raw_dist - free_offset), 6) + 0.0 AS offset_dist
FROM e WHERE raw_dist <= 20 + 1e-6""" % (
    "2 * 6371008.8 * asin(sqrt(pow(sin((2 * atan(exp(y / 6378137.0)) - 2 * atan(exp(py / 6378137.0))) / 2), 2)"
    " + cos(2 * atan(exp(py / 6378137.0)) - pi() / 2) * cos(2 * atan(exp(y / 6378137.0)) - pi() / 2) * pow(sin((x - px) / 6378137.0 / 2), 2)))")))
def _(spark, sf):
    d = noding.nearest_on_each_line(layer(spark, sf, "fx_points"), street_segments(spark, sf))
    return d.selectExpr("px", "py", "line_id", *r("t", "raw_dist"), "free_offset", *r("offset_dist"))


@query("feature_counts", with_layers("fx_streets fx_oneway fx_masks", """
SELECT (SELECT count(*) FROM fx_masks) AS masks, (SELECT count(*) FROM fx_oneway) AS oneways, (SELECT count(*) FROM fx_streets) AS streets,
  (SELECT count(*) FROM fx_streets WHERE frc > 2 AND fow NOT IN (1, 2, 4) AND edge_category <> 'B') AS kept"""))
def _(spark, sf):
    """Layer counts in one aggregate over the stacked layers."""
    s = layer(spark, sf, "fx_streets").select(F.lit("s").alias("k"), at.street_class("frc", "fow", "edge_category").alias("keep"))
    o = layer(spark, sf, "fx_oneway").selectExpr("'o' AS k", "false AS keep")
    m = layer(spark, sf, "fx_masks").selectExpr("'m' AS k", "false AS keep")
    d = s.unionByName(o).unionByName(m)
    return d.agg(F.expr("count_if(k = 'm') AS masks"), F.expr("count_if(k = 'o') AS oneways"), F.expr("count_if(k = 's') AS streets"), F.expr("count_if(keep) AS kept"))


@query("stacked_masks", with_layers("fx_masks", """
SELECT layer, count(*) AS n, count(submerkmal) AS n_kind FROM (SELECT CASE WHEN feature_id LIKE 'RADWEGE%' THEN 'RADWEGE' WHEN feature_id LIKE 'WOHNSTRASSE%' THEN 'WOHNSTRASSE' ELSE 'RADGEGENEINBAHN' END AS layer, submerkmal FROM fx_masks) GROUP BY 1"""))
def _(spark, sf):
    """The three mask layers, with unlike columns, stacked again."""
    m = layer(spark, sf, "fx_masks").withColumn("layer", at.mask_layer("feature_id"))
    paths = m.filter("layer = 'RADWEGE'").select("mask_id", "layer", "submerkmal")
    home = m.filter("layer = 'WOHNSTRASSE'").select("mask_id", "layer")
    contra = m.filter("layer = 'RADGEGENEINBAHN'").select("mask_id", "layer")
    d = paths.unionByName(home, allowMissingColumns=True).unionByName(contra, allowMissingColumns=True)
    return d.groupBy("layer").agg(F.expr("count(1) AS n"), F.expr("count(submerkmal) AS n_kind"))
