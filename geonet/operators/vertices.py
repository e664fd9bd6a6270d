"""Vertex tables: parts, segments, boxes, rings, insertion of points, splitting of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from geonet.operators.intervals import UNIT_BLOCKS
from geonet.operators.scan import index_block, next_row, ordered_scan
from geonet.operators.skew import salted_join
from geonet.session import settle

XY = "array<struct<x:double,y:double>>"


def explode_lines(features: DataFrame, parts: str = "parts", min_points: int = 2) -> DataFrame:
    """Vertices (part, idx, x, y) of every part with at least two points, copied from the feature row."""
    rest = [c for c in features.columns if c != parts]
    d = features.selectExpr(*rest, f"posexplode({parts}) AS (part, _line)").filter(f"size(_line) >= {min_points}")
    d = d.selectExpr(*rest, "part", "posexplode(_line) AS (idx, _pt)")
    return d.selectExpr(*rest, "part", "idx", "_pt.x AS x", "_pt.y AS y")


def explode_points(features: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per coordinate of point features."""
    return explode_lines(features, parts, 1)


def feature_segments(features: DataFrame, parts: str = "parts") -> DataFrame:
    """Segments straight from the feature row, without a shuffle."""
    rest = [c for c in features.columns if c != parts]
    d = features.selectExpr(*rest, f"posexplode({parts}) AS (part, _l)").filter("size(_l) >= 2")
    d = d.selectExpr(*rest, "part", "_l", "explode(sequence(0, size(_l) - 2)) AS seg_idx")
    return d.selectExpr(*rest, "part", "seg_idx", "_l[seg_idx].x AS x1", "_l[seg_idx].y AS y1",
                        "_l[seg_idx + 1].x AS x2", "_l[seg_idx + 1].y AS y2")


def to_segments(vertices: DataFrame, keys: Sequence[str] = ("line_id", "part"), grow: float = 0.0) -> DataFrame:
    """Consecutive vertex pairs with length and box (grown by ``grow``)."""
    d = next_row(vertices, keys, "idx", ["x", "y"]).filter("next_x IS NOT NULL")
    rest = [c for c in vertices.columns if c not in ("idx", "x", "y")]
    return d.selectExpr(
        *rest, "idx AS seg_idx", "x AS x1", "y AS y1", "next_x AS x2", "next_y AS y2",
        "sqrt((next_x-x)*(next_x-x) + (next_y-y)*(next_y-y)) AS len",
        f"least(x, next_x) - {grow}D AS minx", f"least(y, next_y) - {grow}D AS miny",
        f"greatest(x, next_x) + {grow}D AS maxx", f"greatest(y, next_y) + {grow}D AS maxy")


def bbox(vertices: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Box per key, or of the whole layer; a group without finite coordinates gets nulls."""
    finite = "x BETWEEN -1.7976931348623157e308 AND 1.7976931348623157e308 AND y BETWEEN -1.7976931348623157e308 AND 1.7976931348623157e308"
    pick = lambda fn, c, n: F.expr(f"{fn}(CASE WHEN {finite} THEN {c} END) AS {n}")
    return vertices.groupBy(*keys).agg(pick("min", "x", "minx"), pick("min", "y", "miny"), pick("max", "x", "maxx"), pick("max", "y", "maxy"))


def usable_lines(features: DataFrame, min_points: int = 2, min_length: float = 0.0) -> DataFrame:
    """Features with the parts that can be drawn: at least ``min_points`` vertices, longer than ``min_length``.

    Null and empty geometry and parts with fewer vertices go; a feature without a part left goes as well.
    """
    length = ("aggregate(slice(p, 2, greatest(size(p) - 1, 0)), struct(0D AS l, p[0] AS at),"
              " (a, c) -> struct(a.l + sqrt(pow(c.x - a.at.x, 2) + pow(c.y - a.at.y, 2)) AS l, c AS at), a -> a.l)")
    fits = f"p IS NOT NULL AND size(p) >= {max(1, min_points)} AND {length} >= {float(min_length)}D"
    return features.withColumn("parts", F.expr(f"filter(parts, p -> {fits})")).filter("size(parts) > 0")


def layer_box(vertices: DataFrame) -> tuple[float, float, float, float]:
    """Box of a layer as four numbers; raises when no coordinate is finite."""
    row = bbox(vertices).first()
    if row is None or row["minx"] is None:
        raise ValueError("no finite coordinate")
    return row["minx"], row["miny"], row["maxx"], row["maxy"]


def representative_point(vertices: DataFrame, key: str = "feature_id") -> DataFrame:
    """Centre of the box of each feature; a point is its own centre."""
    return bbox(vertices, [key]).selectExpr(key, "(minx + maxx) / 2 AS x", "(miny + maxy) / 2 AS y")


def close_rings(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the first vertex where a ring of three or more vertices is open."""
    keys = list(keys)
    ends = vertices.groupBy(*keys).agg(
        F.expr("min_by(struct(x, y), idx) AS a"), F.expr("max_by(struct(x, y), idx) AS b"), F.expr("max(idx) AS n"))
    rest = [c for c in vertices.columns if c not in (*keys, "idx", "x", "y")]
    extra = ends.filter("n >= 2 AND (a.x <> b.x OR a.y <> b.y)").selectExpr(
        *keys, "CAST(n + 1 AS INT) AS idx", "a.x AS x", "a.y AS y")
    return vertices.drop(*rest).withColumn("idx", F.col("idx").cast("int")).unionByName(extra)


def ring_area(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed area per closed ring, positive when counter-clockwise."""
    seg = to_segments(vertices.select(*keys, "idx", "x", "y"), keys)
    return seg.groupBy(*keys).agg(F.expr("sum(x1*y2 - x2*y1) / 2 AS area"))


def orient_rings(vertices: DataFrame, keys: Sequence[str], hole: str = "ring > 0") -> DataFrame:
    """Turn outer rings counter-clockwise and holes clockwise by renumbering their vertices."""
    keys = list(keys)
    v = close_rings(vertices, keys)
    facts = ring_area(v, keys).join(v.groupBy(*keys).agg(F.max("idx").alias("_n")), keys)
    facts = facts.filter(f"CASE WHEN {hole} THEN area > 0 ELSE area < 0 END").selectExpr(*keys, "_n")
    d = salted_join(v, facts, keys, "left")
    return d.selectExpr(*keys, "CASE WHEN _n IS NULL THEN idx ELSE _n - idx END AS idx", "x", "y")


def insert_vertices(vertices: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put split points (keys, seg_idx, t, x, y) between the vertices and number the line anew."""
    keys = list(keys)
    ranked = ordered_scan(splits.select(*keys, "seg_idx", "t", "x", "y"), [*keys, "seg_idx"], ["t"],
                          F.floor(F.col("t") * UNIT_BLOCKS), sums={"_rank": F.lit(1)})
    counts = vertices.selectExpr(*keys, "CAST(idx AS BIGINT) AS _pos", "0 AS _n").unionByName(
        splits.selectExpr(*keys, "CAST(seg_idx AS BIGINT) AS _pos", "1 AS _n")).groupBy(*keys, "_pos").agg(F.sum("_n").alias("_n"))
    base = ordered_scan(counts, keys, ["_pos"], index_block("_pos"), sums={"_base": F.col("_n")}).drop("_n")
    own = vertices.selectExpr(*keys, "CAST(idx AS BIGINT) AS _pos", "0L AS _at", "x", "y")
    new = ranked.selectExpr(*keys, "CAST(seg_idx AS BIGINT) AS _pos", "_rank + 1 AS _at", "x", "y")
    d = salted_join(own.unionByName(new), base, [*keys, "_pos"])
    return d.selectExpr(*keys, "CAST(_pos + _base + _at AS INT) AS idx", "x", "y")


def cut_segments(segs: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cut segments at their split points.

    Output: ``keys``, seg_idx, ``before`` (splits of this segment before the piece), t0, t1, the
    piece's coordinates and the further columns of the segment.
    """
    keys = list(keys)
    on = [*keys, "seg_idx"]
    rest = [c for c in segs.columns if c not in (*on, "x1", "y1", "x2", "y2")]
    seg = f"struct(x1, y1{''.join(', ' + c for c in rest)})"
    ends = segs.selectExpr(*on, "1D AS t", "x2 AS x", "y2 AS y", "0 AS _cut", f"{seg} AS _seg")
    cuts = splits.selectExpr(*on, "CAST(t AS DOUBLE) AS t", "x", "y", "1 AS _cut")
    d = ends.unionByName(cuts, allowMissingColumns=True)
    d = ordered_scan(d, on, ["t", "_cut"], F.floor(F.col("t") * UNIT_BLOCKS), sums={"before": F.col("_cut")},
                     previous={"_pt": "t", "_px": "x", "_py": "y"})
    d = settle(d, "cuts")
    # The segment's own columns sit on its end row; whole segments need nothing more.
    whole = d.filter("_cut = 0 AND before = 0").selectExpr(
        *on, "before", "0D AS t0", "t AS t1", "_seg.x1 AS x1", "_seg.y1 AS y1", "x AS x2", "y AS y2", *[f"_seg.{c} AS {c}" for c in rest])
    parts = salted_join(d.filter("_cut = 1 OR before > 0").drop("_seg"), segs.selectExpr(*on, "x1 AS _x1", "y1 AS _y1", *rest), on)
    parts = parts.selectExpr(*on, "before", "coalesce(_pt, 0D) AS t0", "t AS t1", "coalesce(_px, _x1) AS x1",
                             "coalesce(_py, _y1) AS y1", "x AS x2", "y AS y2", *rest)
    return whole.unionByName(parts)


def split_lines(segs: DataFrame, splits: DataFrame, keys: Sequence[str] = ("line_id",)) -> DataFrame:
    """Cut lines at split points into pieces.

    Output: ``keys``, ``piece`` (0, 1, ... along the line), ``seg_idx`` (numbered from 0 in each
    piece), coordinates, further columns.
    """
    keys = list(keys)
    rest = [c for c in segs.columns if c not in (*keys, "seg_idx", "x1", "y1", "x2", "y2")]
    counts = segs.selectExpr(*keys, "seg_idx", "0 AS _n").unionByName(splits.selectExpr(*keys, "seg_idx", "1 AS _n"))
    counts = counts.groupBy(*keys, "seg_idx").agg(F.sum("_n").alias("_n"))
    base = ordered_scan(counts, keys, ["seg_idx"], index_block("seg_idx"), sums={"_base": F.col("_n")},
                        maxes={"_from": F.expr("CASE WHEN _n > 0 THEN seg_idx END")}).drop("_n")
    d = salted_join(cut_segments(segs, splits, keys), base, [*keys, "seg_idx"])
    return d.selectExpr(*keys, "CAST(_base + before AS INT) AS piece",
                        "CAST(CASE WHEN before > 0 THEN 0 ELSE seg_idx - coalesce(_from, 0) END AS INT) AS seg_idx",
                        "x1", "y1", "x2", "y2", *rest)


def node_key(x: str, y: str, tol: float) -> str:
    """Snapped position of a point as a struct (kx, ky); halves round up."""
    return f"struct(floor({x} / {tol}D + 0.5D) AS kx, floor({y} / {tol}D + 0.5D) AS ky)"


def split_at_nodes(segs: DataFrame, nodes: DataFrame, tol: float = 1.0, keys: Sequence[str] = ("line_id",)) -> DataFrame:
    """Cut lines at the vertices whose snapped position is in ``nodes`` (column ``node``).

    Line ends need no cut; the cut vertex ends one piece and starts the next.
    """
    keys = list(keys)
    rest = [c for c in segs.columns if c not in (*keys, "seg_idx", "x1", "y1", "x2", "y2")]
    d = segs.withColumn("node", F.expr(node_key("x1", "y1", tol)))
    known = nodes.select("node").distinct().withColumn("_hit", F.lit(1))
    d = salted_join(d, known, ["node"], "left")
    d = d.withColumn("_cut", F.expr("CASE WHEN seg_idx > 0 AND _hit = 1 THEN 1 ELSE 0 END")).drop("_hit", "node")
    d = ordered_scan(d, keys, ["seg_idx"], index_block("seg_idx"), sums={"_n": F.col("_cut")},
                     maxes={"_from": F.expr("CASE WHEN _cut = 1 THEN seg_idx END")})
    return d.selectExpr(*keys, "CAST(_n + _cut AS INT) AS piece",
                        "CAST(CASE WHEN _cut = 1 THEN 0 ELSE seg_idx - coalesce(_from, 0) END AS INT) AS seg_idx",
                        "x1", "y1", "x2", "y2", *rest)
