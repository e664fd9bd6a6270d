"""One document read by many tasks gives the rows of the one-task reader, whatever the text around and inside features."""

import json
import random

import pytest

from geonet.sources import geojson, large


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def feature(rng, i):
    props = {rng.choice(["name", 'q"uote', "br}ace{", "back\\slash", "[list]"]): rng.choice(["}", "{", '"', "\\", '\\"}', "a}b{c", "", "ü}ß", "]}", "\n}"]) for _ in range(rng.randrange(3))}
    shape = rng.choice([
        {"type": "Point", "coordinates": [i, 1.5]}, {"type": "LineString", "coordinates": [[i, 0], [i, j]] if (j := rng.randrange(9)) else [[0, 0], [1, 1]]},
        {"type": "Polygon", "coordinates": [[[0, 0], [9, 0], [9, 9], [0, 0]]]}, None,
        {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [i, 2]}]}])
    f = {"type": "Feature", "properties": props, "geometry": shape}
    return {**f, "id": f"id{i}"} if rng.random() < 0.3 else f


def rows(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


def test_same_rows(spark, tmp_path, small_splits):
    rng = random.Random(5)
    docs = {
        "plain": json.dumps({"type": "FeatureCollection", "features": [feature(rng, i) for i in range(900)]}),
        "indented": json.dumps({"type": "FeatureCollection", "features": [feature(rng, i) for i in range(300)]}, indent=2) + "\n\n",
        "around": json.dumps({"name": "a \"}{ b", "crs": {"type": "name", "properties": {"name": "x}"}}, "others": [{"type": "Feature"}, {"a": {"b": []}}],
                              "features": [feature(rng, i) for i in range(50)], "more": [{"type": "Feature", "geometry": None}], "last": {"features": [1]}}, ensure_ascii=False),
        "empty": '{"type":"FeatureCollection","features":[]}', "spaced": ' { "features" : [ ] , "x" : { } } ',
        "one": json.dumps({"features": [feature(rng, 1)], "type": "FeatureCollection"}),
    }
    folder = tmp_path / "docs"
    (folder / "k=0").mkdir(parents=True)
    for name, text in docs.items():
        (folder / "k=0" / f"{name}.geojson").write_text(text)
    # Files of one name in two folders are two documents.
    for k in (1, 2):
        (folder / f"k={k}").mkdir()
        (folder / f"k={k}" / "same.geojson").write_text(json.dumps({"features": [{**feature(rng, i), "id": f"{k}-{i}"} for i in range(5 * k)]}))
    assert spark.read.option("lineSep", "}").text(str(folder / "k=0" / "plain.geojson")).rdd.getNumPartitions() > 3
    got, want = rows(large.read_large_features(spark, str(folder), "l")), rows(geojson.read_features(spark, str(folder), "l"))
    assert len(want) > 800 and got == want


@pytest.mark.parametrize("text, reason", [
    ('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":null}', "invalid json"), ('{"features":[]', "invalid json"),
    ('{"features":[{"type":"Feature","properties":{"a":"b}}]}', "invalid json"), ('{"type":"FeatureCollection"}', "no features"),
    ('{"features":[{"type":"Feature" "id":1}]}', "invalid json"), ('{"others":[{"a":1}]}', "no features")])
def test_broken(spark, tmp_path, text, reason):
    (tmp_path / "bad.geojson").write_text(text)
    with pytest.raises(ValueError, match=f"bad.geojson: {reason}"):
        large.read_large_features(spark, str(tmp_path), "l")
    (tmp_path / "good.geojson").write_text('{"features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}}]}')
    assert [r.feature_id for r in large.read_large_features(spark, str(tmp_path), "l", bad="skip").collect()] == ["good.geojson#0"]
