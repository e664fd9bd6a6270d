"""Files, manifests, checks, summaries and tiles, all on data derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.fixtures import layer, with_layers
from geonet.functions import attributes as at
from geonet.operators.scan import next_row
from geonet.operators.vertices import feature_segments, orient_rings, to_segments, usable_lines
from geonet.queries.attributes import osm_tags
from geonet.queries.lines import PATH_SEGS, path_segments
from geonet.session import scratch_path
from geonet.sources import geojson, large, manifest, tiles

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


def street_features(spark, sf) -> DataFrame:
    """Streets as features with coordinates moved off the 6-decimal grid."""
    pt = lambda x, y: f"struct({x} + street_id / 7 AS x, {y} AS y)"
    return layer(spark, sf, "fx_streets").selectExpr(
        "street_id AS feature_id", "map('road_type', road_type, 'name', street_name) AS props", "'LineString' AS geom_type",
        f"array(array({pt('x1', 'y1')}, {pt('x2', 'y2')})) AS parts")


@query("read_features", with_layers("fx_streets", """
SELECT CAST(street_id AS VARCHAR) AS feature_id, road_type, street_name AS name, round(x1 + street_id / 7, 6) + 0.0 AS x1, y1, round(x2 + street_id / 7, 6) + 0.0 AS x2, y2 FROM fx_streets"""))
def _(spark, sf):
    """Streets written as GeoJSON lines and read back as segments."""
    path = scratch_path(spark, "streets")
    geojson.write_features(street_features(spark, sf), path)
    d = feature_segments(geojson.read_features(spark, path, "streets", by_line=True))
    return d.selectExpr("feature_id", "props['road_type'] AS road_type", "props['name'] AS name", "x1", "y1", "x2", "y2")


@query("write_features", with_layers("fx_points", """
SELECT concat('{"type":"Feature","id":"', point_id, '","tippecanoe":{"minzoom":14},"properties":{"ANZAHL":"', anzahl, '"},"geometry":{"type":"Point","coordinates":[',
  CAST(x AS BIGINT), '.0,', CAST(y AS BIGINT), '.0]}}') AS value FROM fx_points"""))
def _(spark, sf):
    """Parking points as written GeoJSON lines."""
    d = layer(spark, sf, "fx_points").selectExpr("point_id AS feature_id", "map('ANZAHL', CAST(anzahl AS STRING)) AS props",
                                                 "'Point' AS geom_type", "array(array(struct(x, y))) AS parts")
    path = scratch_path(spark, "parking")
    geojson.write_features(d, path, extra=F.lit(f'"tippecanoe":{{"minzoom":{at.PARKING_MIN_ZOOM}}}'))
    return spark.read.text(path)


@query("large_documents", with_layers("fx_streets", """
SELECT CAST(street_id AS VARCHAR) AS feature_id, road_type, street_name AS name, round(x1 + street_id / 7, 6) + 0.0 AS x1, y1, round(x2 + street_id / 7, 6) + 0.0 AS x2, y2 FROM fx_streets"""))
def _(spark, sf):
    """Streets written as four whole documents and read back as segments, each document by as many tasks as it has splits."""
    path = scratch_path(spark, "documents")
    lines = geojson.feature_json(street_features(spark, sf).withColumn("doc", F.expr("feature_id % 4")), keep=("doc",)).selectExpr("doc", "1 AS k", "concat(value, ',') AS value")
    frame = lines.select("doc").distinct().selectExpr(
        "doc", """inline(array(struct(0 AS k, '{"type":"FeatureCollection","features":[' AS value), struct(2 AS k, '{"type":"Feature","properties":{},"geometry":null}]}' AS value)))""")
    lines.unionByName(frame).repartition("doc").sortWithinPartitions("doc", "k").select("doc", "value").write.partitionBy("doc").text(path)
    d = feature_segments(large.read_large_features(spark, path, "streets"))
    return d.selectExpr("feature_id", "props['road_type'] AS road_type", "props['name'] AS name", "x1", "y1", "x2", "y2")


@query("read_osm_elements", with_layers("fx_osm", "SELECT osm_id, osm_type, highway, amenity, x, y FROM fx_osm"))
def _(spark, sf):
    """OSM elements written one per line and read back."""
    path = scratch_path(spark, "osm")
    pt = "struct(y AS lat, x AS lon)"
    d = osm_tags(spark, sf).selectExpr(
        "osm_type AS type", "osm_id AS id", "tags", "CASE WHEN osm_type = 'node' THEN y END AS lat", "CASE WHEN osm_type = 'node' THEN x END AS lon",
        f"CASE WHEN osm_type = 'way' THEN array({pt}, struct(y + 10 AS lat, x AS lon)) END AS geometry")
    geojson.write_osm(d, path)
    e = geojson.read_osm_elements(spark, path, by_line=True)
    return e.selectExpr("osm_id", "osm_type", "tags['highway'] AS highway", "tags['amenity'] AS amenity", "parts[0][0].x AS x", "parts[0][0].y AS y")


@query("feature_files", with_layers("fx_manifest_curr", """
SELECT name FROM fx_manifest_curr WHERE name LIKE '%.geojson' AND lower(name) NOT LIKE '%example%' AND lower(name) NOT LIKE '%rendertest%'"""))
def _(spark, sf):
    return geojson.data_files(layer(spark, sf, "fx_manifest_curr")).select("name")


def documents_to_check(spark, sf) -> DataFrame:
    """One GeoJSON document per event; the event type decides what is wrong with it."""
    feature = '\'{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1,\', event_id, \']}}\''
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id", f"""CASE event_type
      WHEN 'view' THEN concat('{{"type":"FeatureCollection","features":[', {feature}, ']}}')
      WHEN 'click' THEN '  '
      WHEN 'error' THEN concat('{{"type":"FeatureCollection", ', event_id)
      WHEN 'signup' THEN '{{"type":"FeatureCollection"}}'
      WHEN 'purchase' THEN concat('{{"type":"FeatureCollection","features":[', {feature}, ',{{"type":"Feature","properties":{{}},"geometry":null}}]}}')
      ELSE '{{"features":[]}}' END AS text""")


@query("validate_features", """
SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'empty' WHEN 'error' THEN 'invalid json' WHEN 'signup' THEN 'no features'
  WHEN 'purchase' THEN 'feature without geometry' ELSE 'no type' END AS reason FROM events""")
def _(spark, sf):
    return geojson.check_documents(documents_to_check(spark, sf)).select("event_id", "reason")


MANIFEST = """curr AS (SELECT * FROM fx_manifest_curr WHERE name LIKE '%.geojson' AND lower(name) NOT LIKE '%example%' AND lower(name) NOT LIKE '%rendertest%'),
diff AS (SELECT coalesce(p.name, c.name) AS name, CASE WHEN p.name IS NULL THEN 'new' WHEN c.name IS NULL THEN 'removed' WHEN p.etag = c.etag THEN 'unchanged' ELSE 'changed' END AS status
  FROM fx_manifest_prev p FULL JOIN curr c ON p.name = c.name)"""


def file_diff(spark, sf) -> DataFrame:
    return manifest.manifest_diff(layer(spark, sf, "fx_manifest_prev"), geojson.data_files(layer(spark, sf, "fx_manifest_curr")))


@query("manifest_diff", with_layers("fx_manifest_prev fx_manifest_curr", f"WITH {MANIFEST} SELECT name, status FROM diff"))
def _(spark, sf):
    return file_diff(spark, sf)


@query("removed_files", with_layers("fx_manifest_prev fx_manifest_curr", f"WITH {MANIFEST} SELECT name FROM fx_manifest_prev EXCEPT SELECT name FROM curr"))
def _(spark, sf):
    return manifest.removed_files(layer(spark, sf, "fx_manifest_prev"), geojson.data_files(layer(spark, sf, "fx_manifest_curr")))


@query("sync_decision", with_layers("fx_manifest_prev fx_manifest_curr", f"""
WITH {MANIFEST} SELECT count(*) FILTER (status = 'new') AS n_new, count(*) FILTER (status = 'changed') AS n_changed, count(*) FILTER (status = 'unchanged') AS n_unchanged,
  count(*) FILTER (status = 'removed') AS n_removed, bool_or(status <> 'unchanged') AS rebuild FROM diff"""))
def _(spark, sf):
    return manifest.rebuild_needed(file_diff(spark, sf), published=True)


@query("build_summary", with_layers("fx_streets fx_points", """
SELECT (SELECT count(*) FROM fx_streets) AS streets, (SELECT count(*) FROM fx_points) AS parking, 15.0 AS street_buffer, '25,45,60,70' AS radii"""))
def _(spark, sf):
    counts = {"streets": layer(spark, sf, "fx_streets"), "parking": layer(spark, sf, "fx_points")}
    return manifest.build_summary(counts, {"street_buffer": 15.0, "radii": "25,45,60,70"})


TILE = f"""z AS (SELECT CAST(z AS INTEGER) AS z, pow(2, z) / {2 * tiles.HALF!r} AS k FROM range(12, 17) t(z)),
tiled AS (SELECT street_id, z, unnest(range(CAST(floor((x1 + {tiles.HALF!r}) * k) AS BIGINT), CAST(floor((x2 + {tiles.HALF!r}) * k) AS BIGINT) + 1)) AS tx, r0, r1 FROM (
  SELECT *, CAST(floor(({tiles.HALF!r} - y2) * k) AS BIGINT) AS r0, CAST(floor(({tiles.HALF!r} - y1) * k) AS BIGINT) AS r1 FROM fx_streets, z WHERE z >= CASE road_type WHEN 'footway' THEN 14 WHEN 'tertiary_link' THEN 30 ELSE 0 END)),
tile AS (SELECT street_id, z, tx, unnest(range(r0, r1 + 1)) AS ty FROM tiled)"""


def street_tiles(spark, sf) -> DataFrame:
    d = layer(spark, sf, "fx_streets").withColumn("mz", at.minzoom("road_type"))
    d = d.selectExpr("street_id", "mz", "x1 AS minx", "y1 AS miny", "x2 AS maxx", "y2 AS maxy")
    return tiles.tile_features(d, 12, 16, "mz").select("street_id", "z", "tx", "ty")


@query("tile_features", with_layers("fx_streets", f"WITH {TILE} SELECT * FROM tile"))
def _(spark, sf):
    return street_tiles(spark, sf)


@query("tile_sink", with_layers("fx_streets", f"WITH {TILE} SELECT z, tx, count(*) AS features, count(DISTINCT ty) AS tiles FROM tile GROUP BY 1, 2"))
def _(spark, sf):
    """The tiles written by zoom and column, and read back."""
    path = scratch_path(spark, "tiles")
    tiles.write_tiles(street_tiles(spark, sf), path)
    d = spark.read.parquet(path)
    return d.groupBy("z", F.col("tx").cast("long").alias("tx")).agg(F.count(F.lit(1)).alias("features"), F.countDistinct("ty").alias("tiles"))


# The part of a segment inside a tile by the slabs of its rectangle.
SLABS = f"""z AS (SELECT CAST(z AS INTEGER) AS z, pow(2, z) / {2 * tiles.HALF!r} AS k FROM range(14, 19) t(z)),
{PATH_SEGS},
s AS (SELECT line_id, seg_idx, z, (x1 + {tiles.HALF!r}) * k AS a1, (x2 + {tiles.HALF!r}) * k AS a2, ({tiles.HALF!r} - y1) * k AS b1, ({tiles.HALF!r} - y2) * k AS b2 FROM path_segs, z),
c AS (SELECT *, unnest(range(CAST(floor(least(a1, a2)) AS BIGINT), CAST(floor(greatest(a1, a2)) AS BIGINT) + 1)) AS tx FROM s),
t AS (SELECT *, unnest(range(CAST(floor(least(b1, b2)) AS BIGINT), CAST(floor(greatest(b1, b2)) AS BIGINT) + 1)) AS ty FROM c),
p AS (SELECT *, greatest(0.0, CASE WHEN a1 = a2 THEN 0 ELSE least((tx - a1) / (a2 - a1), (tx + 1 - a1) / (a2 - a1)) END, CASE WHEN b1 = b2 THEN 0 ELSE least((ty - b1) / (b2 - b1), (ty + 1 - b1) / (b2 - b1)) END) AS t0,
  least(1.0, CASE WHEN a1 = a2 THEN 1 ELSE greatest((tx - a1) / (a2 - a1), (tx + 1 - a1) / (a2 - a1)) END, CASE WHEN b1 = b2 THEN 1 ELSE greatest((ty - b1) / (b2 - b1), (ty + 1 - b1) / (b2 - b1)) END) AS t1 FROM t)"""


@query("tile_segments", with_layers("fx_paths", f"""
WITH {SLABS} SELECT z, tx, ty, count(*) AS parts, round(sum(t1 - t0), 6) + 0.0 AS share FROM p WHERE t1 - t0 > 1e-9 GROUP BY 1, 2, 3"""))
def _(spark, sf):
    """Oblique footpaths in the tiles that they really pass."""
    d = tiles.tile_segments(path_segments(spark, sf).select("line_id", "seg_idx", "x1", "y1", "x2", "y2"), 14, 18).filter("t1 - t0 > 1e-9")
    return d.groupBy("z", "tx", "ty").agg(F.count(F.lit(1)).alias("parts"), F.expr("round(sum(t1 - t0), 6) + 0D AS share"))


# The area of a ring under each tile's rows by edges: the integral of the edge's height, cut to the tile, over its way across the column.
TILE_AREA = f"""z AS (SELECT CAST(z AS INTEGER) AS z, pow(2, z) / {2 * tiles.HALF!r} AS k FROM range(12, 17) t(z)),
e AS (SELECT * FROM (SELECT area_id, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM fx_area WINDOW w AS (PARTITION BY area_id, ring ORDER BY idx)) WHERE x2 IS NOT NULL),
s AS (SELECT area_id, z, k, (x1 + {tiles.HALF!r}) * k AS u1, (x2 + {tiles.HALF!r}) * k AS u2, ({tiles.HALF!r} - y1) * k AS v1, ({tiles.HALF!r} - y2) * k AS v2 FROM e, z),
rows AS (SELECT area_id, z, unnest(range(CAST(floor(min(least(v1, v2))) AS BIGINT), CAST(floor(max(greatest(v1, v2))) AS BIGINT) + 1)) AS ty FROM s GROUP BY area_id, z),
c AS (SELECT *, unnest(range(CAST(floor(least(u1, u2)) AS BIGINT), CAST(floor(greatest(u1, u2)) AS BIGINT) + 1)) AS tx FROM s WHERE u1 <> u2),
w AS (SELECT *, greatest(tx, least(tx + 1, u1)) AS ua, greatest(tx, least(tx + 1, u2)) AS ub FROM c),
h AS (SELECT area_id, z, k, tx, ty, ub - ua AS way, v1 + (ua - u1) / (u2 - u1) * (v2 - v1) - ty AS a, v1 + (ub - u1) / (u2 - u1) * (v2 - v1) - ty AS b FROM w JOIN rows USING (area_id, z)),
i AS (SELECT *, CASE WHEN a <= 0 THEN 0 WHEN a <= 1 THEN a * a / 2 ELSE a - 0.5 END AS pa, CASE WHEN b <= 0 THEN 0 WHEN b <= 1 THEN b * b / 2 ELSE b - 0.5 END AS pb FROM h)
SELECT area_id, z, tx, ty, round(sum(way * CASE WHEN abs(b - a) < 1e-9 THEN greatest(0, least(1, (a + b) / 2)) ELSE (pb - pa) / (b - a) END / k / k), 2) + 0.0 AS area FROM i
GROUP BY 1, 2, 3, 4 HAVING round(sum(way * CASE WHEN abs(b - a) < 1e-9 THEN greatest(0, least(1, (a + b) / 2)) ELSE (pb - pa) / (b - a) END / k / k), 2) > 0"""


def area_parts(spark, sf) -> DataFrame:
    """The boundary polygons cut by the tiles of five zoom levels."""
    edges = to_segments(orient_rings(layer(spark, sf, "fx_area"), ["area_id", "ring"], "ring > 0"), ["area_id", "ring"])
    return tiles.tile_areas(edges, ["area_id"], 12, 16)


@query("tile_areas", with_layers("fx_area", f"WITH {TILE_AREA}"))
def _(spark, sf):
    """Area of every boundary polygon in every tile."""
    d = tiles.tile_area_size(area_parts(spark, sf), ["area_id"])
    return d.selectExpr("area_id", "z", "tx", "ty", "round(area, 2) + 0D AS area").filter("area > 0")


@query("tile_rings", with_layers("fx_area", f"WITH {TILE_AREA}"))
def _(spark, sf):
    """The same from linked rings: each edge runs from its point to the one of the next place in its ring."""
    on = ["area_id", "z", "tx", "ty", "ring"]
    rings = tiles.tile_rings(area_parts(spark, sf), ["area_id"])
    d = next_row(rings, on, "seq", ["x1", "y1"])
    first = rings.filter("seq = 0").select(*on, F.col("x1").alias("_x1"), F.col("y1").alias("_y1"))
    d = d.join(first, on).withColumns({"x2": F.coalesce("next_x1", "_x1"), "y2": F.coalesce("next_y1", "_y1"), "n": F.lit(1)})
    d = tiles.tile_area_size(d, ["area_id"])
    return d.selectExpr("area_id", "z", "tx", "ty", "round(area, 2) + 0D AS area").filter("area > 0")


@query("broken_parts", """
SELECT CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS invalid, CAST(count(*) FILTER (event_type NOT IN ('error', 'view', 'purchase', 'click')) AS BIGINT) AS unusable FROM events""")
def _(spark, sf):
    """Documents written one per line: the lines that the reader refuses."""
    path = scratch_path(spark, "documents")
    documents_to_check(spark, sf).select("text").write.text(path)
    kinds = geojson.read_lines(spark, path).filter("kind = 'broken'")
    return kinds.agg(F.count_if(F.col("doc._bad").isNotNull()).alias("invalid"), F.count_if(F.col("doc._bad").isNull()).alias("unusable"))


@query("usable_lines", with_layers("fx_paths", """
WITH p AS (SELECT line_id, idx, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM fx_paths WHERE idx < line_id % 4 WINDOW w AS (PARTITION BY line_id ORDER BY idx))
SELECT line_id AS feature_id, count(*) AS points FROM p GROUP BY 1 HAVING count(*) >= 2 AND sum(coalesce(sqrt(pow(x - px, 2) + pow(y - py, 2)), 0)) >= 50"""))
def _(spark, sf):
    """Footpaths cut to 0 to 3 vertices: those with two vertices and 50 units of length."""
    d = layer(spark, sf, "fx_paths").groupBy(F.col("line_id").alias("feature_id")).agg(
        F.expr("array_sort(collect_list(CASE WHEN idx < line_id % 4 THEN struct(idx, x, y) END)) AS v"))
    d = d.selectExpr("feature_id", "array(transform(v, c -> struct(c.x AS x, c.y AS y)), CAST(NULL AS array<struct<x:double,y:double>>)) AS parts")
    return usable_lines(d, 2, 50.0).selectExpr("feature_id", "CAST(size(parts[0]) AS BIGINT) AS points")


@query("tile_feature_cap", with_layers("fx_streets", f"""
WITH {TILE} SELECT street_id, z, tx, ty FROM tile QUALIFY row_number() OVER (PARTITION BY z, tx, ty ORDER BY street_id) <= 20"""))
def _(spark, sf):
    """The 20 first streets of each tile."""
    return tiles.tile_feature_cap(street_tiles(spark, sf), 20, ["street_id"])


@query("tile_thin", with_layers("fx_points", f"""
WITH z AS (SELECT CAST(z AS INTEGER) AS z, pow(2, z) / {2 * tiles.HALF!r} AS k FROM range(13, 17) t(z)),
g AS (SELECT point_id, z, CAST(floor((x + {tiles.HALF!r}) * k * 4096) AS BIGINT) AS gx, CAST(floor(({tiles.HALF!r} - y) * k * 4096) AS BIGINT) AS gy FROM fx_points, z),
c AS (SELECT point_id, z, gx >> 12 AS tx, gy >> 12 AS ty,
  CAST(list_sum(list_transform(range(12), lambda b: ((gx >> b) % 2) * CAST(pow(4, b) AS BIGINT) + ((gy >> b) % 2) * CAST(2 * pow(4, b) AS BIGINT))) AS BIGINT) AS curve FROM g),
w AS (SELECT *, coalesce(curve - lag(curve) OVER (PARTITION BY z, tx, ty ORDER BY curve, point_id), 16777216) AS gap FROM c)
SELECT point_id, z, tx, ty FROM w QUALIFY row_number() OVER (PARTITION BY z, tx, ty ORDER BY gap DESC, curve, point_id) <= 12"""))
def _(spark, sf):
    """Twelve parking points of each tile, the most crowded left out."""
    d = layer(spark, sf, "fx_points").selectExpr("point_id", "x AS minx", "y AS miny", "x AS maxx", "y AS maxy")
    return tiles.tile_thin(tiles.tile_features(d, 13, 16), 12, ["point_id"]).select("point_id", "z", "tx", "ty")
