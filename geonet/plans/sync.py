"""Rebuild the route map when its source files changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from geonet.functions.crs import reproject
from geonet.functions.geometry import let
from geonet.operators.skew import salted_join
from geonet.operators.vertices import bbox, explode_lines, feature_segments
from geonet.session import Scratch, drop_path
from geonet.sources import geojson, manifest, tiles


def changed_file_sync(prev: DataFrame, curr: DataFrame, features: DataFrame, published: bool = True,
                      zooms: tuple[int, int] = tiles.ZOOMS["routes"]) -> DataFrame | None:
    """Tiles (feature_id, file, z, tx, ty) of all current files, or None when nothing has changed.

    ``prev`` and ``curr`` list name and etag; ``features`` has file, feature_id and web-mercator parts.
    Files that are no longer listed drop out of the map.
    """
    listed = geojson.data_files(curr)
    decision = manifest.rebuild_needed(manifest.manifest_diff(prev, listed), published).first()
    if not decision["rebuild"]:
        return None
    if decision["n_new"] + decision["n_changed"] + decision["n_unchanged"] == 0:
        raise ValueError("no data files to build from")
    current = salted_join(features, listed.selectExpr("name AS file"), ["file"], "left_semi")
    boxes = bbox(explode_lines(current.select("file", "feature_id", "parts")), ["file", "feature_id"])
    return tiles.tile_features(boxes, *zooms).select("file", "feature_id", "z", "tx", "ty")


def tile_lines(features: DataFrame, zooms: tuple[int, int], source: int = 4326) -> DataFrame:
    """The lines of features (file, feature_id, parts) cut at tile borders: file, feature_id, part, seg_idx, x1, y1, x2, y2, z, tx, ty."""
    segs = feature_segments(features.select("file", "feature_id", "parts"))
    segs = reproject(reproject(segs, source, 3857, "x1", "y1"), source, 3857, "x2", "y2")
    d = tiles.tile_segments(segs.select("file", "feature_id", "part", "seg_idx", "x1", "y1", "x2", "y2"), *zooms)
    d = let(d, _dx="x2 - x1", _dy="y2 - y1")
    end = lambda t, x: f"{x}1 + {t} * _d{x} AS {x}{1 if t == 't0' else 2}"
    return d.selectExpr("file", "feature_id", "part", "seg_idx", end("t0", "x"), end("t0", "y"), end("t1", "x"), end("t1", "y"), "z", "tx", "ty")


def sync_tiles(prev: DataFrame, curr: DataFrame, read: Callable[[list[str]], DataFrame], out: str, published: bool = True,
               zooms: tuple[int, int] = tiles.ZOOMS["routes"], source: int = 4326) -> DataFrame | None:
    """Bring the tiles written at ``out`` up to date; the partitions (z, tx) written anew, or None when nothing has changed.

    ``prev`` and ``curr`` list name and etag; ``read`` returns file, feature_id and parts of the files named.
    Only new and changed files are read.  Only partitions are written that hold, or now get, a part of a file
    that is new, changed or removed; in them the rows of all other files are taken over from the tiles as they are.
    Partitions left without a row are removed.  With ``published`` false all files are read and all tiles written.

    New tiles are complete in a scratch table before the first partition is replaced, so an unreadable file
    leaves the map as it was.  A run that was interrupted while it replaced partitions is mended by running it
    again with the same lists.  Names of changed files go to the driver, which lists them for the reader anyway;
    so do removed partitions, at most 2 to the power of the last zoom level + 1.
    """
    spark = curr.sparkSession
    scratch = Scratch(spark, "sync")
    diff = scratch.cut(manifest.manifest_diff(prev, geojson.data_files(curr)), "diff")
    decision = manifest.rebuild_needed(diff, published).first()
    if not decision["rebuild"]:
        return None
    if decision["n_new"] + decision["n_changed"] + decision["n_unchanged"] == 0:
        raise ValueError("no data files to build from")
    wanted = "status <> 'removed'" if not published else "status IN ('new', 'changed')"
    names = sorted(r["name"] for r in diff.filter(wanted).collect())
    if not published:
        tiles.write_tiles(tile_lines(read(names), zooms, source), out)
        return spark.read.parquet(out).select("z", "tx").distinct()
    store = spark.read.parquet(out).withColumns({"z": F.col("z").cast("int"), "tx": F.col("tx").cast("long")})
    affected = diff.filter("status <> 'unchanged'").selectExpr("name AS file")
    fresh = scratch.cut(tile_lines(read(names), zooms, source).select(*store.columns), "fresh") if names else store.limit(0)
    stale = store.select("file", "z", "tx").distinct().join(affected, "file", "left_semi")
    touched = scratch.cut(stale.select("z", "tx").unionByName(fresh.select("z", "tx")).distinct(), "touched")
    kept = store.join(touched, ["z", "tx"], "left_semi").join(affected, "file", "left_anti")
    new = scratch.cut(kept.select(*store.columns).unionByName(fresh), "new")
    empty = touched.join(new.select("z", "tx").distinct(), ["z", "tx"], "left_anti").collect()
    tiles.write_tiles(new, out, touched_only=True)
    for row in empty:
        drop_path(spark, f"{out.rstrip('/')}/z={row['z']}/tx={row['tx']}")
    return touched
