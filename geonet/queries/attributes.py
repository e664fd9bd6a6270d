"""Attribute, tag and scalar geometry expressions over whole layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.fixtures import layer, with_layers
from geonet.functions import attributes as at, geometry as geo
from geonet.functions.crs import reproject
from geonet.operators.match import diag_ratio_ok, line_stats

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


TAG_KEYS = ["amenity", "bench", "leisure", "highway", "access", "foot", "level", "tunnel"]


def osm_tags(spark, sf_dir: str) -> DataFrame:
    """OSM layer with a tag map made of the non-null columns."""
    pairs = ", ".join(f"struct('{k}' AS key, {k} AS value)" for k in TAG_KEYS)
    return layer(spark, sf_dir, "fx_osm").selectExpr(
        "osm_id", "osm_type", "x", "y", f"map_from_entries(filter(array({pairs}), e -> e.value IS NOT NULL)) AS tags")


@query("mask_layer", with_layers("fx_masks", """
SELECT mask_id, CASE WHEN feature_id LIKE 'RADWEGE%' THEN 'RADWEGE' WHEN feature_id LIKE 'WOHNSTRASSE%' THEN 'WOHNSTRASSE'
  WHEN feature_id LIKE 'RADGEGENEINBAHN%' THEN 'RADGEGENEINBAHN' END AS layer FROM fx_masks"""))
def _(spark, sf):
    return layer(spark, sf, "fx_masks").select("mask_id", at.mask_layer("feature_id").alias("layer"))


@query("rename_attrs", with_layers("fx_streets", """
SELECT street_id, street_name AS "Straßenname", frc_name AS "Funktionale Straßenklasse", width_m AS "Straßenbreite_m",
  level_no AS "Ebene", bezirk AS "Bezirk" FROM fx_streets"""))
def _(spark, sf):
    d = layer(spark, sf, "fx_streets").selectExpr(
        "street_id", "street_name AS FEATURENAME", "frc_name AS FRC_NAME", "width_m AS DEDICATEDWIDTH",
        "level_no AS LEVELINTERMEDIATE", "bezirk AS BEZIRK")
    return at.rename_attrs(d)


@query("drop_attrs", with_layers("fx_oneway", "SELECT oneway_id, x1 FROM fx_oneway"))
def _(spark, sf):
    d = layer(spark, sf, "fx_oneway").selectExpr("oneway_id", "x1", "oneway_id AS OBJECTID", "'-' AS SE_ANNO_CAD_DATA")
    return at.drop_attrs(d)


@query("district_code", with_layers("fx_streets", """
SELECT street_id, CAST(TRY_CAST(substr(bezirk, 4, 2) AS INTEGER) AS VARCHAR) AS district, CAST(frc AS VARCHAR) AS plain,
  '0' AS bare, concat(substr(bezirk, 4, 2), ' Wien') AS named FROM fx_streets"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").select(
        "street_id", at.district_code("bezirk").alias("district"), at.district_code(F.col("frc").cast("string")).alias("plain"),
        at.district_code(F.substring("bezirk", 1, 2)).alias("bare"),
        at.district_code(F.concat(F.substring("bezirk", 4, 2), F.lit(" Wien"))).alias("named"))


@query("crop_leading_number", with_layers("fx_streets", r"""
SELECT street_id, regexp_replace(frc_name, '^\s*\d+\s*[-–—]\s*', '') AS frc_name, regexp_replace(concat('  7 – ', road_type), '^\s*\d+\s*[-–—]\s*', '') AS dashed
FROM fx_streets"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").select(
        "street_id", at.crop_leading_number("frc_name").alias("frc_name"),
        at.crop_leading_number(F.concat(F.lit("  7 – "), "road_type")).alias("dashed"))


@query("ui_relevant", with_layers("fx_streets", """
SELECT street_id, CASE WHEN width_m = -1 THEN NULL ELSE width_m END AS width, CASE WHEN level_no <> 0 THEN level_no END AS level FROM fx_streets"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").select("street_id", at.known_width("width_m").alias("width"), at.shown_level("level_no").alias("level"))


@query("fill_from", with_layers("fx_streets", """
SELECT street_id, CASE WHEN street_name IS NULL THEN frc_name ELSE street_name END AS label FROM fx_streets"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").select("street_id", at.fill_from("street_name", "frc_name").alias("label"))


@query("street_output", with_layers("fx_streets", """
SELECT street_id, concat('{', CASE WHEN street_name IS NOT NULL THEN concat('"name":"', street_name, '",') ELSE '' END, '"FRC":', frc, '}') AS properties FROM fx_streets"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").select("street_id", at.street_output("street_name", "frc").alias("properties"))


@query("parking_output", with_layers("fx_points", """
SELECT point_id, CASE WHEN anzahl = 1 THEN '{}' ELSE concat('{"ANZAHL":', anzahl, '}') END AS properties, 14 AS minzoom FROM fx_points"""))
def _(spark, sf):
    return layer(spark, sf, "fx_points").select(
        "point_id", at.parking_output(F.nullif("anzahl", F.lit(1))).alias("properties"), F.lit(at.PARKING_MIN_ZOOM).alias("minzoom"))


@query("tag", with_layers("fx_osm", """
SELECT osm_id, highway AS tagged, CASE WHEN osm_type = 'node' THEN access END AS flat FROM fx_osm"""))
def _(spark, sf):
    d = osm_tags(spark, sf)
    return d.select("osm_id", at.tag("highway", "tags", "tags").alias("tagged"),
                    at.tag("access", F.expr("CASE WHEN osm_type = 'way' THEN map('x', 'y') END"), "tags").alias("flat"))


@query("is_seat", with_layers("fx_osm", """
SELECT osm_id, coalesce(amenity IN ('bench', 'chair', 'lounger', 'seat'), false) OR coalesce(bench = 'yes', false)
  OR coalesce(leisure IN ('picnic_table', 'parklet'), false) AS seat FROM fx_osm"""))
def _(spark, sf):
    return osm_tags(spark, sf).select("osm_id", at.is_seat().alias("seat"))


@query("seat_filter", with_layers("fx_osm", r"""
SELECT osm_id FROM fx_osm WHERE NOT coalesce(access LIKE 'private%', false) AND (
  coalesce(amenity IN ('bench', 'chair', 'lounger', 'seat'), false)
  OR coalesce(bench = 'yes', false) AND NOT coalesce(regexp_matches(level, '^-?[1-9]'), false)
  OR coalesce(leisure = 'picnic_table', false)
  OR coalesce(leisure = 'parklet', false) AND NOT coalesce(regexp_matches(access, '^customers?$'), false))"""))
def _(spark, sf):
    return osm_tags(spark, sf).filter(at.seat_filter()).select("osm_id")


WALK_SQL = """(highway IN ('footway', 'path', 'track') OR highway = 'cycleway' AND foot = 'yes'
  OR osm_type = 'way' AND regexp_matches(highway, 'primary|secondary|tertiary|residential|pedestrian|living_street|service|unclassified'))"""
EXCL_SQL = "NOT coalesce(foot = 'no', false) AND NOT coalesce(access IN ('no', 'private'), false) AND NOT coalesce(tunnel = 'yes', false)"


@query("walkable_filter", with_layers("fx_osm", f"SELECT osm_id, highway FROM fx_osm WHERE coalesce({WALK_SQL}, false)"))
def _(spark, sf):
    return osm_tags(spark, sf).filter(at.walkable_filter()).select("osm_id", at.tag("highway").alias("highway"))


@query("tag_exclusion", with_layers("fx_osm", f"SELECT osm_id FROM fx_osm WHERE {EXCL_SQL}"))
def _(spark, sf):
    return osm_tags(spark, sf).filter(at.tag_exclusion()).select("osm_id")


@query("osm_elements_once", with_layers("fx_osm", f"""
SELECT osm_type, osm_id FROM fx_osm WHERE coalesce({WALK_SQL}, false) AND {EXCL_SQL} UNION SELECT osm_type, osm_id FROM fx_osm
WHERE coalesce(amenity = 'bench', false) OR coalesce(bench = 'yes', false)"""))
def _(spark, sf):
    d = osm_tags(spark, sf)
    seats = d.filter(F.coalesce((at.tag("amenity") == "bench") | (at.tag("bench") == "yes"), F.lit(False)))
    roads = d.filter(at.walkable_filter() & at.tag_exclusion())
    return roads.unionByName(seats).select("osm_type", "osm_id").dropDuplicates()


@query("road_type", with_layers("fx_osm", "SELECT osm_id, coalesce(highway, '') AS road_type FROM fx_osm"))
def _(spark, sf):
    return osm_tags(spark, sf).select("osm_id", at.road_type().alias("road_type"))


@query("road_type_values", with_layers("fx_osm", """
SELECT coalesce(highway, '') AS road_type, count(*) AS n,
  CASE coalesce(highway, '') WHEN 'footway' THEN 2.0 WHEN 'cycleway' THEN 2.0 WHEN 'residential' THEN 3.0 ELSE 2.5 END AS free_offset,
  CASE coalesce(highway, '') WHEN 'footway' THEN 14 WHEN 'cycleway' THEN 14 WHEN 'residential' THEN 0 ELSE 30 END AS minzoom
FROM fx_osm GROUP BY 1"""))
def _(spark, sf):
    d = osm_tags(spark, sf).groupBy(at.road_type().alias("road_type")).agg(F.count(F.lit(1)).alias("n"))
    return d.select("road_type", "n", at.free_offset("road_type").alias("free_offset"), at.minzoom("road_type").alias("minzoom"))


@query("distance_bucket", """
SELECT event_id, CASE WHEN value < 25 THEN 25 WHEN value < 50 THEN 50 WHEN value < 75 THEN 75 ELSE 0 END AS color,
  CASE WHEN value < 25 THEN 40 WHEN value < 50 THEN 30 WHEN value < 75 THEN 20 ELSE 10 END AS z FROM events""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/events.parquet")
    return d.select("event_id", at.distance_bucket("value").alias("color"), at.bucket_rank("value").alias("z"))


@query("street_class_filter", with_layers("fx_streets", """
SELECT street_id FROM fx_streets WHERE frc > 2 AND fow <> 1 AND fow <> 2 AND fow <> 4 AND edge_category <> 'B'"""))
def _(spark, sf):
    return layer(spark, sf, "fx_streets").filter(at.street_class("frc", "fow", "edge_category")).select("street_id")


@query("snap_key", with_layers("fx_points", """
SELECT point_id, CAST(floor((x - 2000) / 1.5 + 0.5) AS BIGINT) AS kx, CAST(floor(y / 1.5 + 0.5) AS BIGINT) AS ky,
  CAST(floor((2000 - x - 0.5) / 1.0 + 0.5) AS BIGINT) AS half FROM fx_points"""))
def _(spark, sf):
    return layer(spark, sf, "fx_points").select(
        "point_id", geo.snap_key(F.col("x") - 2000, 1.5).alias("kx"), geo.snap_key("y", 1.5).alias("ky"),
        geo.snap_key(2000 - F.col("x") - 0.5, 1.0).alias("half"))


LAT = "radians(degrees(2 * atan(exp({} / 6378137.0)) - pi() / 2))"
HAV = ("2 * 6371008.8 * asin(sqrt(pow(sin(({lat2} - {lat1}) / 2), 2) + cos({lat1}) * cos({lat2}) * pow(sin(({x2} - {x1}) / 6378137.0 / 2), 2)))")


def haversine_sql(x1: str, y1: str, x2: str, y2: str) -> str:
    return HAV.format(lat1=LAT.format(f"({y1})"), lat2=LAT.format(f"({y2})"), x1=f"({x1})", x2=f"({x2})")


@query("geodesic_length", with_layers("fx_streets", f"""
SELECT street_id, round({haversine_sql('x1 + 1822300', 'y1 + 6141862', 'x2 + 1822300', 'y2 + 6141862')}, 6) + 0.0 AS metres FROM fx_streets"""))
def _(spark, sf):
    x, y = 1822300, 6141862
    return layer(spark, sf, "fx_streets").select("street_id", geo.r6(geo.geodesic_length(
        F.col("x1") + x, F.col("y1") + y, F.col("x2") + x, F.col("y2") + y)).alias("metres"))


@query("coords_equal", with_layers("fx_oneway", """
SELECT oneway_id, abs(x1 - x2) <= 1e-9 AND abs(y1 - (y2 - 40)) <= 1e-9 AS same FROM fx_oneway"""))
def _(spark, sf):
    return layer(spark, sf, "fx_oneway").select("oneway_id", geo.coords_equal("x1", "y1", "x2", F.col("y2") - 40).alias("same"))


@query("closest_point", with_layers("fx_streets", """
SELECT street_id, round(least(1, greatest(0, t)), 6) + 0.0 AS t, round(x1 + least(1, greatest(0, t)) * (x2 - x1), 6) + 0.0 AS x
FROM (SELECT *, ((3 * frc * 40 - 60 - 0.0) * (x2 - x1) + (fow * 30 - 40 - 0.0) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS t FROM fx_streets)"""))
def _(spark, sf):
    px, py = F.expr("x1 + 3 * frc * 40 - 60"), F.expr("y1 + fow * 30 - 40")
    t = geo.closest_t(px, py)
    return layer(spark, sf, "fx_streets").select("street_id", geo.r6(t).alias("t"), geo.r6(geo.along("x1", "x2", t)).alias("x"))


@query("reproject_mercator", with_layers("fx_points", """
SELECT point_id, round(6378137.0 * radians(16.0 + x / 10000), 4) + 0.0 AS mx,
  round(6378137.0 * ln(tan(pi() / 4 + radians(48.0 + y / 1e6) / 2)), 4) + 0.0 AS my, round(16.0 + x / 10000, 6) + 0.0 AS lon,
  round(48.0 + y / 1e6, 6) + 0.0 AS lat FROM fx_points"""))
def _(spark, sf):
    d = layer(spark, sf, "fx_points").selectExpr("point_id", "16D + x / 10000 AS x", "48D + y / 1000000 AS y")
    m = reproject(d, 4326, 3857).withColumns({"mx": F.col("x"), "my": F.col("y")})
    return reproject(m, 3857, 4326).select("point_id", geo.rounded("mx", 4).alias("mx"), geo.rounded("my", 4).alias("my"), geo.r6("x").alias("lon"), geo.r6("y").alias("lat"))


@query("reproject_grid")
def _(spark, sf):
    """Parking points through both Austrian grids and back."""
    d = layer(spark, sf, "fx_points").selectExpr("point_id", "16D + x / 10000 AS x", "48D + y / 1000000 AS y")
    east = reproject(d, 4326, 31256).selectExpr("point_id", "31256 AS crs", "x", "y")
    west = reproject(d, 4326, 31257).selectExpr("point_id", "31257 AS crs", "x", "y")
    return east.unionByName(west).select("point_id", "crs", geo.r6("x").alias("x"), geo.r6("y").alias("y"))


@query("bbox_filter", with_layers("fx_osm", """
SELECT osm_id FROM fx_osm WHERE x >= 1000 - 50 AND x <= 3000 + 50 AND y >= 500 - 50 AND y <= 16000 + 50"""))
def _(spark, sf):
    return layer(spark, sf, "fx_osm").filter(geo.extent_filter((1000.0, 500.0, 3000.0, 16000.0))).select("osm_id")


@query("min_length", with_layers("fx_oneway", """
SELECT oneway_id, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM fx_oneway WHERE sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) > 40"""))
def _(spark, sf):
    return layer(spark, sf, "fx_oneway").select("oneway_id", geo.length().alias("len")).filter("len > 40")


@query("diag_ratio", with_layers("fx_streets fx_oneway", """
SELECT o.oneway_id, s.street_id FROM fx_oneway o JOIN fx_streets s ON s.street_id = o.oneway_id
WHERE sqrt(pow(least(greatest(s.x1, s.x2), greatest(o.x1, o.x2) + 2) - greatest(least(s.x1, s.x2), least(o.x1, o.x2) - 2), 2)
  + pow(least(greatest(s.y1, s.y2), greatest(o.y1, o.y2) + 2) - greatest(least(s.y1, s.y2), least(o.y1, o.y2) - 2), 2)) / 100 + 0.05 >= 0.6"""))
def _(spark, sf):
    o = line_stats(layer(spark, sf, "fx_oneway"), "oneway_id", "o_")
    s = line_stats(layer(spark, sf, "fx_streets"), "street_id", "s_")
    return o.join(s, F.expr("oneway_id = street_id")).filter(diag_ratio_ok()).select("oneway_id", "street_id")


@query("lookup_width", with_layers("fx_masks", """
SELECT mask_id, CASE WHEN feature_id NOT LIKE 'RADWEGE%' THEN 5.0 WHEN submerkmal = 'Baulicher Radweg' THEN 20.0 ELSE 5.0 END AS r
FROM fx_masks WHERE feature_id NOT LIKE 'RADWEGE%' OR submerkmal IN ('Baulicher Radweg', 'Radfahren gegen die Einbahn')"""))
def _(spark, sf):
    return at.lookup_width(layer(spark, sf, "fx_masks")).select("mask_id", "r")
