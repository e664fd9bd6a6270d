"""Counts of opening rows: equal to the plain window over blocks of any size, with each row moved once."""

import contextlib
import io
import random

from pyspark.sql import functions as F

from geonet.operators import coloring, scan


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def counted(spark, rows, block, **more):
    d = spark.createDataFrame(rows, "k string, i int, v int")
    d = scan.opened_scan(d, ["k"], ["i"], block, F.expr("_was IS NULL OR _was <> v"), "n", previous={"_was": "v"}, **more)
    assert d.columns == ["k", "i", "v", "n"]
    return sorted(map(tuple, d.collect()))


def expected(rows):
    out, last = [], {}
    for k, i, v in sorted(rows):
        was, n = last.get(k, (None, 0))
        last[k] = v, n + (was is None or was != v)
        out.append((k, i, v, last[k][1]))
    return out


def some_rows():
    draw = random.Random(3)
    # "one" stays in block 0, "late" in block 2, "gap" leaves blocks out, "long" has all.
    places = {"one": range(3), "late": range(6, 9), "gap": [0, 1, 9, 10, 11, 30], "long": range(40)}
    return [(k, i, draw.randint(0, 1)) for k, at in places.items() for i in at]


def test_counts_over_blocks(spark):
    for stored in (False, True):
        for size in (1, 3, 100):
            assert counted(spark, some_rows(), scan.index_block("i", size), stored=stored) == expected(some_rows())


def test_null_key_takes_nothing_from_other_blocks(spark):
    null = spark.createDataFrame([(None, 0), (None, 1), (None, 3)], "k string, i int")
    d = scan.opened_scan(null, ["k"], ["i"], scan.index_block("i", 3), F.lit(True), "n", previous={"_was": "i"})
    assert sorted((r.i, r.n) for r in d.collect()) == [(0, 1), (1, 2), (3, 1)]


def test_runs_of_short_lines_are_moved_once(spark):
    rows = [(k, s, 0.0, 25, float(s), 0.0, s + 1.0, 0.0) for k in range(3) for s in (0, 1, 3)]
    pieces = spark.createDataFrame(rows, "line_id int, seg_idx int, t0 double, color int, x1 double, y1 double, x2 double, y2 double")
    runs = coloring.merge_runs(pieces)
    assert plan(runs).count("Exchange hashpartitioning") == 1
    assert sorted((r.line_id, r.seg_idx, r.run) for r in runs.collect()) == [(k, s, 1 + (s == 3)) for k in range(3) for s in (0, 1, 3)]


def test_runs_joined_over_lines_in_several_blocks(spark):
    # Lines 0 to 9 follow each other, but for a gap before line 7.
    rows = [(k, 0, 0.0, 25, k + (k >= 7) / 2, 0.0, k + 1 + (k >= 7) / 2, 0.0, 1) for k in range(10)]
    runs = spark.createDataFrame(rows, "line_id int, seg_idx int, t0 double, color int, x1 double, y1 double, x2 double, y2 double, run int")
    d = coloring.merge_across(runs, block=scan.index_block("line_id", 3))
    assert sorted((r.line_id, r.joined) for r in d.collect()) == [(k, 1 + (k >= 7)) for k in range(10)]
