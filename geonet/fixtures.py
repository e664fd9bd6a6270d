"""Input layers derived from the given tables; the text of each runs in Spark SQL and in DuckDB.

Coordinates are metres on a plane.  Streets form a 100 m lattice 40 blocks wide that grows north
with the tables; one-ways and masks lie beside it, seats and parking points are spread over it,
footpaths cross it and one boundary polygon with a hole stands on it per supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Outline (ring 0) and hole (ring 1) of the boundary polygon, before scaling.
AREA_TEMPLATE = [
    (0, 0, 0.0, 0.0), (0, 1, 360.0, 0.0), (0, 2, 360.0, 500.0), (0, 3, 186.0, 525.0), (0, 4, 354.0, 1500.0),
    (0, 5, 0.0, 1500.0), (0, 6, 0.0, 0.0),
    (1, 0, 62.4, 260.0), (1, 1, 62.4, 490.0), (1, 2, 117.6, 490.0), (1, 3, 117.6, 260.0), (1, 4, 62.4, 260.0),
]
_TEMPLATE_SQL = ", ".join(f"({r}, {i}, {x}, {y})" for r, i, x, y in AREA_TEMPLATE)

FIXTURES = {
    "fx_streets": """
SELECT o_orderkey AS street_id, o_orderkey % 2 AS dir,
  CAST(floor(o_orderkey/2) % 40 * 100 AS DOUBLE) AS x1,
  CAST(floor(o_orderkey/80) * 100 AS DOUBLE) AS y1,
  CAST(floor(o_orderkey/2) % 40 * 100 + CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE 0 END AS DOUBLE) AS x2,
  CAST(floor(o_orderkey/80) * 100 + CASE WHEN o_orderkey % 2 = 1 THEN 100 ELSE 0 END AS DOUBLE) AS y2,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'primary' WHEN '2-HIGH' THEN 'residential'
    WHEN '3-MEDIUM' THEN 'footway' WHEN '4-NOT SPECIFIED' THEN 'service' ELSE 'tertiary_link' END AS road_type,
  CAST(o_custkey % 8 AS INT) AS frc, CAST(o_custkey % 6 AS INT) AS fow,
  CASE WHEN o_custkey % 9 = 0 THEN 'B' ELSE 'S' END AS edge_category,
  concat('AT9', CASE WHEN o_custkey % 23 < 9 THEN '0' ELSE '' END, CAST(o_custkey % 23 + 1 AS STRING), '00') AS bezirk,
  concat(CAST(o_custkey % 8 AS STRING), ' - Klasse ', CAST(o_custkey % 8 AS STRING)) AS frc_name,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE concat('Gasse ', CAST(o_custkey % 97 AS STRING)) END AS street_name,
  CAST(CASE WHEN o_custkey % 4 = 0 THEN -1 ELSE o_custkey % 12 END AS INT) AS width_m,
  CAST(o_custkey % 3 - 1 AS INT) AS level_no
FROM orders""",
    "fx_oneway": """
SELECT o_orderkey AS oneway_id,
  CAST(floor(o_orderkey/2) % 40 * 100 + o_orderkey % 2 AS DOUBLE) AS x1,
  CAST(floor(o_orderkey/80) * 100 + 1 - o_orderkey % 2 AS DOUBLE) AS y1,
  CAST(floor(o_orderkey/2) % 40 * 100 + CASE WHEN o_orderkey % 2 = 0 THEN 40 + o_custkey % 61 ELSE 1 END AS DOUBLE) AS x2,
  CAST(floor(o_orderkey/80) * 100 + CASE WHEN o_orderkey % 2 = 1 THEN 40 + o_custkey % 61 ELSE 1 END AS DOUBLE) AS y2
FROM orders WHERE o_orderstatus = 'F'""",
    "fx_masks": """
SELECT p_partkey AS mask_id,
  CASE p_size % 3 WHEN 0 THEN concat('RADWEGEOGD.', CAST(p_partkey AS STRING))
    WHEN 1 THEN concat('WOHNSTRASSEOGD.', CAST(p_partkey AS STRING))
    ELSE concat('RADGEGENEINBAHNOG.', CAST(p_partkey AS STRING)) END AS feature_id,
  CASE WHEN p_size % 3 <> 0 THEN NULL WHEN p_size % 2 = 0 THEN 'Baulicher Radweg'
    WHEN p_size % 5 = 0 THEN 'Sonstiges' ELSE 'Radfahren gegen die Einbahn' END AS submerkmal,
  CAST(floor(p_partkey/2) % 40 * 100 + CASE WHEN p_partkey % 2 = 0 THEN p_size % 30 ELSE 3 END AS DOUBLE) AS x1,
  CAST(floor(p_partkey/80) * 100 + CASE WHEN p_partkey % 2 = 1 THEN p_size % 30 ELSE 3 END AS DOUBLE) AS y1,
  CAST(floor(p_partkey/2) % 40 * 100 + CASE WHEN p_partkey % 2 = 0 THEN p_size % 30 + 20 + p_size ELSE 3 END AS DOUBLE) AS x2,
  CAST(floor(p_partkey/80) * 100 + CASE WHEN p_partkey % 2 = 1 THEN p_size % 30 + 20 + p_size ELSE 3 END AS DOUBLE) AS y2
FROM part""",
    "fx_points": """
SELECT c_custkey AS point_id, CAST((c_custkey * 7919) % 4001 AS DOUBLE) AS x,
  CAST((c_custkey * 104729) % 4003 + floor(c_custkey / 320) * 4000 AS DOUBLE) AS y, c_nationkey + 1 AS anzahl
FROM customer""",
    "fx_osm": """
SELECT event_id AS osm_id,
  CASE WHEN event_id % 5 = 0 THEN 'node' ELSE 'way' END AS osm_type,
  CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'bench'
    WHEN event_type = 'view' THEN 'chair' END AS amenity,
  CASE WHEN event_type = 'click' THEN 'yes' END AS bench,
  CASE WHEN event_type = 'signup' THEN 'parklet' END AS leisure,
  CASE WHEN event_type = 'error' THEN 'footway' WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN 'primary_link'
    WHEN event_type = 'purchase' AND user_id % 3 = 1 THEN 'cycleway' WHEN event_type = 'purchase' THEN 'residential' END AS highway,
  CASE event_id % 7 WHEN 0 THEN 'private' WHEN 1 THEN 'customers' WHEN 2 THEN 'no' WHEN 3 THEN 'yes' END AS access,
  CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS foot,
  CASE event_id % 6 WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN '-1' END AS level,
  CASE WHEN event_id % 11 = 0 THEN 'yes' END AS tunnel,
  CAST((event_id * 7919) % 4001 AS DOUBLE) AS x, CAST((event_id * 104729) % 4003 + floor(event_id / 2000) * 4000 AS DOUBLE) AS y
FROM events""",
    "fx_manifest_prev": """
SELECT concat('tile', CAST(o_orderkey AS STRING), CASE o_orderpriority WHEN '1-URGENT' THEN '_example' WHEN '2-HIGH' THEN '_RenderTest' ELSE '' END, '.geojson') AS name,
  concat('e', CAST(o_custkey AS STRING)) AS etag FROM orders WHERE o_orderstatus <> 'F'""",
    "fx_manifest_curr": """
SELECT concat('tile', CAST(o_orderkey AS STRING), CASE o_orderpriority WHEN '1-URGENT' THEN '_example' WHEN '2-HIGH' THEN '_RenderTest' ELSE '' END,
    CASE WHEN o_totalprice < 30000 THEN '.txt' ELSE '.geojson' END) AS name,
  concat('e', CAST(o_custkey AS STRING), CASE WHEN o_totalprice > 250000 THEN 'x' ELSE '' END) AS etag
FROM orders WHERE o_orderstatus <> 'P'""",
    "fx_area": f"""
SELECT s_suppkey AS area_id, t.ring AS ring, t.idx AS idx,
  CAST(s_suppkey % 10 * 400 + 17.5 + t.dx AS DOUBLE) AS x, CAST(floor(s_suppkey / 10) * 1870 + 13.5 + t.dy AS DOUBLE) AS y
FROM supplier JOIN (VALUES {_TEMPLATE_SQL}) AS t(ring, idx, dx, dy) ON t.idx >= 0""",
    "fx_paths": """
SELECT CAST(floor(o_orderkey / 8) AS BIGINT) AS line_id, 0 AS part, CAST(o_orderkey % 8 AS INT) AS idx,
  CAST(floor(o_orderkey / 8) % 40 * 100 + o_orderkey % 8 * 30 + o_custkey % 5 AS DOUBLE) AS x,
  CAST(floor(o_orderkey / 320) * 400 + 20 + o_custkey * 7 % 61 AS DOUBLE) AS y
FROM orders""",
    "fx_tracks": """
SELECT CAST(floor(event_id / 64) AS BIGINT) AS line_id, CAST(event_id % 64 AS INT) AS idx,
  CAST(event_id % 64 * 10 + floor(event_id / 64) * 7 AS DOUBLE) AS x, value / 4 AS y
FROM events""",
}
BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations"]


# Where the two engines write the same thing differently.
SPARK_TEXT = {
    "fx_area": FIXTURES["fx_area"].replace(
        f"JOIN (VALUES {_TEMPLATE_SQL}) AS t(ring, idx, dx, dy) ON t.idx >= 0",
        f"LATERAL VIEW inline(array({', '.join(f'struct({r}, {i}, {x}D, {y}D)' for r, i, x, y in AREA_TEMPLATE)})) t AS ring, idx, dx, dy"),
}


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture over the tables in ``sf_dir``."""
    sql = SPARK_TEXT.get(name, FIXTURES[name])
    for table in BASE:
        if f"FROM {table}" in sql:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(sql)


def with_layers(names: str, body: str) -> str:
    """Query text with the named fixtures as common table expressions."""
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n].strip()})" for n in names.split())
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    return f"WITH {ctes},\n{body[4:].lstrip()}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
