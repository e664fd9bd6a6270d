"""Tiles brought up to date file by file: only the partitions touched are written, and the result is that of a full build."""

import json
import os
from pathlib import Path

import pytest

from geonet.plans import sync
from geonet.sources import geojson

ZOOMS = (13, 15)


def write(folder, files):
    """Files of name -> lines of map units; returns the manifest rows."""
    os.makedirs(folder, exist_ok=True)
    rows = []
    for name, lines in files.items():
        text = lines if isinstance(lines, str) else "\n".join(json.dumps({
            "type": "Feature", "id": f"{name}-{i}", "properties": {}, "geometry": {"type": "LineString", "coordinates": c}}) for i, c in enumerate(lines))
        Path(folder, name).write_text(text)
        rows.append((name, str(hash(text))))
    return rows


def run(spark, prev, curr, folder, out, published=True):
    frame = lambda rows: spark.createDataFrame(rows, "name string, etag string")
    read = lambda names: geojson.read_named_files(spark, str(folder), names, "roads", by_line=True)
    done = sync.sync_tiles(frame(prev), frame(curr), read, str(out), published, ZOOMS, source=3857)
    return None if done is None else {(r.z, r.tx) for r in done.collect()}


def content(spark, out):
    d = spark.read.parquet(str(out))
    return sorted(map(tuple, d.selectExpr("file", "feature_id", "part", "seg_idx", "x1", "y1", "x2", "y2", "z", "tx", "ty").collect()))


def stamps(out):
    return {str(p.relative_to(out)): p.stat().st_mtime_ns for p in Path(out).glob("z=*/tx=*/*.parquet")}


FIRST = {
    "a.geojson": [[[10, 10], [5000, 40]], [[20, 20], [20, 900]]],
    "b.geojson": [[[100_000, 10], [109_000, 2000], [101_000, 9000]]],
    "c.geojson": [[[300_000, 10], [300_000, 2000]]],
    "example.geojson": [[[0, 0], [1, 1]]],
    "notes.txt": "no data",
}


@pytest.fixture
def built(spark, tmp_path):
    rows = write(tmp_path / "v1", FIRST)
    assert run(spark, [], rows, tmp_path / "v1", tmp_path / "out", published=False)
    return rows


def test_only_touched_partitions(spark, tmp_path, built):
    out = tmp_path / "out"
    before = stamps(out)
    # b moves on, c goes, d comes to where a lies; a and its file's tiles elsewhere stay.
    second = {"a.geojson": FIRST["a.geojson"], "b.geojson": [[[120_000, 10], [121_000, 2000]]], "d.geojson": [[[30, 30], [60, 90]]]}
    rows = write(tmp_path / "v2", second)
    touched = run(spark, built, rows, tmp_path / "v2", out)
    after = stamps(out)
    same = {p for p, t in after.items() if before.get(p) == t}
    of = lambda p: tuple(int(x.split("=")[1]) for x in p.split("/")[:2])
    assert same and all(of(p) not in touched for p in same)
    assert {of(p) for p in before if of(p) not in touched} == {of(p) for p in same}
    assert all(of(p) in touched for p in after if p not in same)
    run(spark, [], rows, tmp_path / "v2", tmp_path / "whole", published=False)
    assert content(spark, out) == content(spark, tmp_path / "whole")
    assert not any(r[0] == "c.geojson" for r in content(spark, out))
    assert {of(p) for p in after} == {of(p) for p in stamps(tmp_path / "whole")}
    # An interrupted run is run again with the same lists; afterwards nothing has changed.
    assert run(spark, built, rows, tmp_path / "v2", out) is not None
    assert content(spark, out) == content(spark, tmp_path / "whole")
    assert run(spark, rows, rows, tmp_path / "v2", out) is None


def test_unreadable_file_leaves_the_map(spark, tmp_path, built):
    out = tmp_path / "out"
    before = stamps(out)
    rows = write(tmp_path / "v2", {**FIRST, "b.geojson": '{"type": "Feature", "geom'})
    with pytest.raises(Exception, match="broken GeoJSON line in b.geojson"):
        run(spark, built, rows, tmp_path / "v2", out)
    assert stamps(out) == before


def test_no_files_left(spark, tmp_path, built):
    with pytest.raises(ValueError, match="no data files"):
        run(spark, built, [("notes.txt", "1")], tmp_path / "v1", tmp_path / "out")


def test_only_removed(spark, tmp_path, built):
    rows = [r for r in built if r[0] != "b.geojson"]
    run(spark, built, rows, tmp_path / "v1", tmp_path / "out")
    assert {r[0] for r in content(spark, tmp_path / "out")} == {"a.geojson", "c.geojson"}
