"""Assigning features to web map tiles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from geonet.functions.geometry import MERCATOR_RADIUS, let
from geonet.operators.scan import ordered_scan
from geonet.operators.skew import hot_keys
from geonet.session import Scratch

HALF = math.pi * MERCATOR_RADIUS
# Zoom ranges of the four published layers.
ZOOMS = {"oneway": (8, 17), "parking": (8, 14), "seating": (0, 14), "routes": (1, 14)}


def tile_features(boxes: DataFrame, zmin: int, zmax: int, minzoom: str | None = None) -> DataFrame:
    """One row per feature and tile its web-mercator box touches: columns of ``boxes`` + z, tx, ty.

    ``boxes`` has minx, miny, maxx, maxy; a feature appears from its own ``minzoom`` column on.
    """
    low = f"greatest({zmin}, {minzoom})" if minzoom else str(zmin)
    d = boxes.filter(f"{low} <= {zmax}").selectExpr("*", f"explode(sequence({low}, {zmax})) AS z")
    d = d.selectExpr("*", f"CAST(shiftleft(1L, z) AS DOUBLE) / {2 * HALF}D AS _k")
    clamp = lambda e: f"CAST(greatest(0, least(shiftleft(1L, z) - 1, {e})) AS BIGINT)"
    col = lambda x: clamp(f"floor(({x} + {HALF}D) * _k)")
    row = lambda y: clamp(f"floor(({HALF}D - {y}) * _k)")
    d = d.selectExpr("*", f"explode(sequence({col('minx')}, {col('maxx')})) AS tx")
    return d.selectExpr("*", f"explode(sequence({row('maxy')}, {row('miny')})) AS ty").drop("_k")


def tile_segments(segs: DataFrame, zmin: int, zmax: int, minzoom: str | None = None) -> DataFrame:
    """The part of every segment in every tile that it passes: columns of ``segs`` + z, tx, ty, t0, t1.

    ``segs`` has web-mercator x1, y1, x2, y2; t0 and t1 bound the part along the segment.  A segment is walked
    column by column and within a column row by row, so a long one makes as many rows as tiles it passes,
    not as many as its box holds.  A border belongs to the tile to its right and below; a part of no length
    is kept only where the segment has none.
    """
    low = f"greatest({zmin}, {minzoom})" if minzoom else str(zmin)
    d = segs.filter(f"{low} <= {zmax}").selectExpr("*", f"explode(sequence({low}, {zmax})) AS z")
    d = let(d, _k=f"CAST(shiftleft(1L, z) AS DOUBLE) / {2 * HALF}D")
    d = let(d, _c1=f"(x1 + {HALF}D) * _k", _c2=f"(x2 + {HALF}D) * _k", _r1=f"({HALF}D - y1) * _k", _r2=f"({HALF}D - y2) * _k")

    def walk(d: DataFrame, tile: str, a: str, b: str, t0: str, t1: str) -> DataFrame:
        """One row per tile number that a + t (b - a) passes for t from t0 to t1, with the part inside it."""
        p, q = f"({a} + {t0} * ({b} - {a}))", f"({a} + {t1} * ({b} - {a}))"
        clamp = lambda e: f"CAST(greatest(0, least(shiftleft(1L, z) - 1, floor({e}))) AS BIGINT)"
        d = d.selectExpr("*", f"explode(sequence({clamp(f'least({p}, {q})')}, {clamp(f'greatest({p}, {q})')})) AS {tile}")
        edge = lambda n: f"(({n}) - {a}) / nullif({b} - {a}, 0D)"
        first, last = f"CASE WHEN {b} >= {a} THEN {edge(tile)} ELSE {edge(tile + ' + 1')} END", f"CASE WHEN {b} >= {a} THEN {edge(tile + ' + 1')} ELSE {edge(tile)} END"
        return let(d, _s=f"greatest({t0}, coalesce({first}, {t0}))", _e=f"least({t1}, coalesce({last}, {t1}))")

    d = walk(d.selectExpr("*", "0D AS _t0", "1D AS _t1"), "tx", "_c1", "_c2", "_t0", "_t1")
    d = d.drop("_t0", "_t1").withColumnsRenamed({"_s": "_t0", "_e": "_t1"}).filter("_t0 < _t1 OR (_c1 = _c2 AND _r1 = _r2)")
    d = walk(d, "ty", "_r1", "_r2", "_t0", "_t1").filter("_s < _e OR (_c1 = _c2 AND _r1 = _r2)")
    return d.selectExpr(*segs.columns, "z", "tx", "ty", "_s AS t0", "_e AS t1")


def _cut_slabs(edges: DataFrame, keys: list[str], a: str, b: str, slab: str) -> DataFrame:
    """Closed outlines cut at the whole numbers of coordinate ``a``: one closed outline per slab between two of them.

    ``edges`` has ``keys``, z, a1, b1, a2, b2 and n, how often the edge counts.  Where an outline crosses a border it is
    closed along it: the crossings are summed up in the order of ``b``, and the sum is how often, and which way, the
    border belongs to the slab before it; the slab behind it gets the same the other way round.  A point on a border
    belongs to the slab behind it.
    """
    clamp = lambda e: f"CAST(greatest(0, least(shiftleft(1L, z) - 1, floor({e}))) AS BIGINT)"
    d = let(edges, _f1=clamp(f"{a}1"), _f2=clamp(f"{a}2"))
    # The place of a crossing is one expression of edge and border, so that both slabs and the border end in the same point.
    at = lambda c: f"CASE WHEN {c} = {a}2 THEN {b}2 ELSE {b}1 + ({c} - {a}1) / ({a}2 - {a}1) * ({b}2 - {b}1) END"
    inside = d.selectExpr("*", f"explode(sequence(least(_f1, _f2), greatest(_f1, _f2))) AS {slab}")
    inside = let(inside, _in=f"CAST(CASE WHEN _f2 > _f1 THEN {slab} ELSE {slab} + 1 END AS DOUBLE)",
                 _out=f"CAST(CASE WHEN _f2 > _f1 THEN {slab} + 1 ELSE {slab} END AS DOUBLE)")
    inside = inside.selectExpr(
        *keys, "z", slab, "n", f"CASE WHEN {slab} = _f1 THEN {a}1 ELSE _in END AS {a}1", f"CASE WHEN {slab} = _f1 THEN {b}1 ELSE {at('_in')} END AS {b}1",
        f"CASE WHEN {slab} = _f2 THEN {a}2 ELSE _out END AS {a}2", f"CASE WHEN {slab} = _f2 THEN {b}2 ELSE {at('_out')} END AS {b}2")
    cross = d.filter("_f1 <> _f2").selectExpr("*", f"explode(sequence(least(_f1, _f2) + 1, greatest(_f1, _f2))) AS {slab}")
    cross = cross.selectExpr(*keys, "z", slab, f"{at(f'CAST({slab} AS DOUBLE)')} AS _pos", "CASE WHEN _f2 > _f1 THEN n ELSE -n END AS _sign")
    on = [*keys, "z", slab]
    cross = cross.groupBy(*on, "_pos").agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
    runs = ordered_scan(cross, on, ["_pos"], F.floor(F.col("_pos") * 256), sums={"_flow": F.col("_sign")}, previous={"_from": "_pos"})
    runs = runs.filter("_flow <> 0 AND _from IS NOT NULL").selectExpr(
        *keys, "z", f"{slab} AS _c", f"inline(array(struct({slab} - 1 AS {slab}, _flow AS _n), struct({slab} AS {slab}, -_flow AS _n)))", "_from", "_pos")
    line = "CAST(_c AS DOUBLE)"
    border = runs.selectExpr(
        *keys, "z", slab, "abs(_n) AS n", f"{line} AS {a}1", f"CASE WHEN _n > 0 THEN _from ELSE _pos END AS {b}1",
        f"{line} AS {a}2", f"CASE WHEN _n > 0 THEN _pos ELSE _from END AS {b}2")
    return inside.unionByName(border).filter(f"{a}1 <> {a}2 OR {b}1 <> {b}2")


def tile_areas(edges: DataFrame, keys: list[str], zmin: int, zmax: int, minzoom: str | None = None) -> DataFrame:
    """Areas cut by tiles: the edges of each area's part in each tile, as ``keys`` + z, tx, ty, x1, y1, x2, y2, n.

    ``edges`` has the directed edges of closed rings in web-mercator x1, y1, x2, y2, holes the other way round than
    outlines.  The part in a tile is closed along the tile's border; ``n`` is how often an edge counts (1 in valid
    areas).  A tile wholly inside an area has its four sides.  Areas are cut into columns, then into rows; no task
    holds a whole ring, and a border is summed up in blocks.  Edges with a null coordinate are left out.
    """
    low = f"greatest({zmin}, {minzoom})" if minzoom else str(zmin)
    d = edges.filter(f"{low} <= {zmax} AND x1 + y1 + x2 + y2 IS NOT NULL").selectExpr(
        *keys, f"explode(sequence({low}, {zmax})) AS z", "x1", "y1", "x2", "y2")
    # The share of the world's side comes first: multiplying it by a power of two is exact at every zoom level.
    unit = lambda e: f"({e}) / {2 * HALF}D * shiftleft(1L, z)"
    d = d.selectExpr(*keys, "z", "1L AS n", f"{unit(f'x1 + {HALF}D')} AS u1", f"{unit(f'{HALF}D - y1')} AS v1",
                     f"{unit(f'x2 + {HALF}D')} AS u2", f"{unit(f'{HALF}D - y2')} AS v2")
    scratch = Scratch(edges.sparkSession, "tile-areas")
    columns = scratch.cut(_cut_slabs(d, keys, "u", "v", "tx"), "columns")
    d = _cut_slabs(columns, [*keys, "tx"], "v", "u", "ty")
    d = let(d, _s=f"{2 * HALF}D / CAST(shiftleft(1L, z) AS DOUBLE)")
    return d.selectExpr(*keys, "z", "tx", "ty", f"u1 * _s - {HALF}D AS x1", f"{HALF}D - v1 * _s AS y1",
                        f"u2 * _s - {HALF}D AS x2", f"{HALF}D - v2 * _s AS y2", "n")


def tile_area_size(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Signed area (outlines to the left: positive) per ``keys`` and tile of ``tile_areas``: keys, z, tx, ty, area.

    Each edge counts with the strip between it and the tile's upper border; differences of full web-mercator
    products would lose digits.
    """
    d = let(parts, _y=f"{HALF}D - ty * {2 * HALF}D / CAST(shiftleft(1L, z) AS DOUBLE)")
    return d.groupBy(*keys, "z", "tx", "ty").agg(F.expr("sum(n * (x1 - x2) * ((y1 - _y) + (y2 - _y))) / 2 AS area"))


def tile_rings(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The edges of ``tile_areas`` linked to rings: keys, z, tx, ty, ring, seq, x1, y1, x2, y2.

    Each edge is followed by one that starts where it ends; where several rings meet in a point they are paired by
    direction, so they may be joined there.  Followers are doubled in joins, and every edge looks for the smallest
    edge of its ring and the way to it; a tile leaves the loop once its steps exceed its edges, so the rounds are the
    logarithm of the edges in the fullest tile and later rounds hold the full tiles only.  ``ring`` is the smallest
    edge, ``seq`` the place after it.  Rings of two edges, there and back, are left out.
    """
    scratch = Scratch(parts.sparkSession, "tile-rings")
    tile = [*keys, "z", "tx", "ty"]
    d = parts.selectExpr("*", "explode(sequence(1L, n)) AS _copy").drop("n")
    d = d.selectExpr(*tile, "x1", "y1", "x2", "y2", "struct(x1, y1, x2, y2, _copy) AS _e", "atan2(y2 - y1, x2 - x1) AS _dir")
    d = scratch.cut(d, "edges")
    place = lambda end: F.row_number().over(W.partitionBy(*tile, f"x{end}", f"y{end}").orderBy("_dir", "_e"))
    outs = d.withColumn("_i", place(1)).selectExpr(*tile, "x1 AS x2", "y1 AS y2", "_i", "_e AS _to")
    nxt = d.withColumn("_i", place(2)).join(outs, [*tile, "x2", "y2", "_i"])
    many = d.groupBy(*tile).agg(F.count(F.lit(1)).alias("_n"))
    state = scratch.cut(nxt.join(many, tile).selectExpr(*tile, "_n", "_e", "_to", "struct(_e AS e, 0L AS way) AS _low"), "steps0")
    done, span = [], 1
    while True:
        done.append(state.filter(f"_n <= {span}"))
        state = state.filter(f"_n > {span}")
        onward = state.selectExpr(*tile, "_e AS _to", "_to AS _far", "_low AS _more")
        step = state.join(onward, [*tile, "_to"]).selectExpr(
            *tile, "_n", "_e", "_far AS _to", f"least(_low, struct(_more.e AS e, _more.way + {span}L AS way)) AS _low")
        span *= 2
        state, seen = scratch.cut_watched(step, f"steps{span}", n="count(1)")
        if not seen["n"]:
            break
    ranked = reduce(DataFrame.unionByName, done).selectExpr(*tile, "_e", "_low.e AS ring", "_low.way AS _way")
    size = ranked.groupBy(*tile, "ring").agg(F.count(F.lit(1)).alias("_len")).filter("_len > 2")
    return ranked.join(size, [*tile, "ring"]).selectExpr(
        *tile, "ring", "pmod(_len - _way, _len) AS seq", "_e.x1 AS x1", "_e.y1 AS y1", "_e.x2 AS x2", "_e.y2 AS y2")


def tile_feature_cap(tiles: DataFrame, k: int | None, order: list[str]) -> DataFrame:
    """The first ``k`` features of each tile by ``order``; without ``k`` everything stays.

    Over-full tiles are first cut to k per salt, then to k, so a tile never meets in one task whole.
    """
    if k is None:
        return tiles
    on = ["z", "tx", "ty"]
    hot = hot_keys(tiles, on)
    d = tiles.join(hot, on, "left").withColumn("_salt", F.expr(f"pmod(xxhash64({', '.join(order)}), coalesce(_salts, 1))"))
    first = F.row_number().over(W.partitionBy(*on, "_salt").orderBy(*order))
    d = d.withColumn("_rn", first).filter(F.col("_rn") <= k)
    last = F.row_number().over(W.partitionBy(*on).orderBy(*order))
    return d.withColumn("_rn", last).filter(F.col("_rn") <= k).select(*tiles.columns)


def tile_thin(tiles: DataFrame, k: int | None, order: list[str]) -> DataFrame:
    """At most ``k`` features of each tile, the most crowded left out first; without ``k`` everything stays.

    ``tiles`` comes from ``tile_features``.  The features of a tile are put along a Z curve through the centres of
    their boxes, 4,096 steps a side; ties go by ``order``.  A feature's gap is its way along the curve from the one
    before it, the first one's is the widest.  Those with the widest gaps stay, ties by curve and ``order``.
    """
    if k is None:
        return tiles
    on = ["z", "tx", "ty"]
    d = let(tiles, _k=f"CAST(shiftleft(1L, z) AS DOUBLE) / {2 * HALF}D")
    place = lambda e, tile: f"CAST(greatest(0, least(4095, floor({e} * _k * 4096) - {tile} * 4096)) AS BIGINT)"
    d = let(d, _u=place(f"((minx + maxx) / 2 + {HALF}D)", "tx"), _v=place(f"({HALF}D - (miny + maxy) / 2)", "ty"))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        d = d.withColumns({c: F.expr(f"({c} | shiftleft({c}, {shift})) & {mask}L") for c in ("_u", "_v")})
    d = d.withColumn("_curve", F.expr("_u | shiftleft(_v, 1)")).select(*tiles.columns, "_curve")
    d = ordered_scan(d, on, ["_curve", *order], F.expr("shiftright(_curve, 12)"), previous={"_before": "_curve"})
    d = d.withColumn("_near", F.expr(f"-coalesce(_curve - _before, {1 << 24}L)"))
    return tile_feature_cap(d, k, ["_near", "_curve", *order]).select(*tiles.columns)


def write_tiles(tiles: DataFrame, path: str, touched_only: bool = False) -> None:
    """Write tiles partitioned by zoom and column; rows of one tile lie together.

    Ranges also follow a hash of the row, so that a tile with much of the data is written by many tasks.
    ``touched_only`` replaces just the partitions that the rows lie in and leaves the others as they are.
    """
    order = ["z", "tx", "ty", F.xxhash64(*tiles.columns)]
    writer = tiles.repartitionByRange(*order).sortWithinPartitions("z", "tx", "ty").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic" if touched_only else "static").partitionBy("z", "tx").parquet(path)
