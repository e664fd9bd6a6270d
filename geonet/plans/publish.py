"""Last steps of the builds: coordinates, files, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from geonet.functions.crs import reproject
from geonet.sources import geojson, manifest

DECIMALS = 6


def line_features(segs: DataFrame, props: DataFrame, key: str, feature_id: Column, source: int = 3857, target: int = 3857) -> DataFrame:
    """One LineString feature per ``key`` of a segment table, with the columns of ``props`` (one row per key).

    The segments of one line are gathered in one row; lines are not joined to longer ones here.
    """
    d = reproject(reproject(segs.select(key, "seg_idx", "x1", "y1", "x2", "y2"), source, target, "x1", "y1"), source, target, "x2", "y2")
    d = d.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seg_idx", "x1", "y1", "x2", "y2"))).alias("_s"))
    d = d.withColumn("parts", F.expr("array(concat(array(struct(_s[0].x1 AS x, _s[0].y1 AS y)), transform(_s, v -> struct(v.x2 AS x, v.y2 AS y))))"))
    names = [c for c in props.columns if c != key]
    d = d.select(key, "parts").join(props, key)
    pairs = [x for c in names for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return d.select(feature_id.cast("string").alias("feature_id"), F.create_map(*pairs).alias("props"), F.lit("LineString").alias("geom_type"), "parts")


def publish(features: DataFrame, path: str, settings: dict, name: str = "features") -> DataFrame:
    """Write the features and return the summary row of what lies in the folder afterwards."""
    geojson.write_features(features, path, DECIMALS)
    written = geojson.read_features(features.sparkSession, path, name, by_line=True)
    return manifest.build_summary({name: written}, settings)
