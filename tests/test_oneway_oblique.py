"""The one-way build on oblique lines of several segments, with worked results."""

import math

from geonet.plans import oneway


def test_cut_at_a_junction_on_an_inner_vertex(spark, segments):
    # Streets 1 and 4 run obliquely towards each other, streets 2 and 3 meet them at (100, 50).
    streets = segments([(1, 0, 0, 0, 40, 30), (1, 1, 40, 30, 100, 50), (4, 0, 100, 50, 150, 90), (4, 1, 150, 90, 200, 100), (2, 0, 60, 130, 100, 50), (2, 1, 100, 50, 150, -50),
                        (3, 0, 100, 50, 190, 0)])
    # The one-way runs along both, through the junction on its second inner vertex.
    oneways = segments([(10, 0, 0, 0, 40, 30), (10, 1, 40, 30, 100, 50), (10, 2, 100, 50, 150, 90), (10, 3, 150, 90, 200, 100)])
    attrs = spark.createDataFrame([(1, "Gasse", "AT90700", "4 - Klasse"), (4, "Weg", "AT90700", "4 - Klasse"), (2, "Quer", "AT90800", "4 - Klasse"), (3, "Dritte", None, None)],
                                  "street_id int, FEATURENAME string, BEZIRK string, FRC_NAME string")
    # A facility along the first part only.
    masks = spark.createDataFrame([(1, "RADGEGENEINBAHNOG.1", None, 0.0, 1.0, 40.0, 31.0), (2, "RADGEGENEINBAHNOG.2", None, 40.0, 31.0, 99.0, 50.0)],
                                  "mask_id int, feature_id string, submerkmal string, x1 double, y1 double, x2 double, y2 double")
    base = ["line_id", "seg_idx", "x1", "y1", "x2", "y2"]
    res = oneway.oneway_status(oneways.select(*base), streets.select(*base), attrs, masks)
    got = sorted((r["RgE"], round(r["length"], 6), r["Straßenname"], r["Bezirk"]) for r in res.pieces.collect())
    first, second = math.hypot(40, 30) + math.hypot(60, 20), math.hypot(50, 40) + math.hypot(50, 10)
    assert got == [("ja", round(first, 6), "Gasse", "7"), ("nein", round(second, 6), "Weg", "7")]
    # Both stay apart, as their status differs, and keep their bends.
    assert sorted(r["n_lines"] for r in res.merged.collect()) == [1, 1]
    assert sorted((r["x1"], r["x2"]) for r in res.lines.collect()) == [(0.0, 40.0), (40.0, 100.0), (100.0, 150.0), (150.0, 200.0)]


def test_own_attributes_win(spark, segments):
    streets = segments([(1, 0, 0, 0, 100, 50), (2, 0, 100, 50, 200, 100)])
    oneways = segments([(10, 0, 0, 0, 100, 50), (11, 0, 100, 50, 200, 100)])
    attrs = spark.createDataFrame([(1, "Gasse", "1010 Wien"), (2, "Gasse", "1010 Wien")], "street_id int, FEATURENAME string, BEZIRK string")
    masks = spark.createDataFrame([], "mask_id int, feature_id string, submerkmal string, x1 double, y1 double, x2 double, y2 double")
    own = spark.createDataFrame([(10, "Eigener Name", "x", 5), (11, None, None, 6)], "line_id int, `Straßenname` string, note string, OBJECTID int")
    base = ["line_id", "seg_idx", "x1", "y1", "x2", "y2"]
    res = oneway.oneway_status(oneways.select(*base), streets.select(*base), attrs, masks, own=own)
    got = sorted((r["Straßenname"], r["Bezirk"], r["note"] or "") for r in res.pieces.collect())
    assert got == [("Eigener Name", "1010 Wien", "x"), ("Gasse", "1010 Wien", "")]
    assert "OBJECTID" not in res.pieces.columns
