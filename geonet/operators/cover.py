"""How much of a line lies within a distance of other lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from geonet.functions.geometry import add_capsule_interval, length
from geonet.operators.grid import box_pairs, with_box
from geonet.operators.intervals import union_measure
from geonet.session import settle

CELL = 100.0
MAX_REST = 0.36
COORDS = ("x1", "y1", "x2", "y2")


def cut_long(df: DataFrame, limit: float, names: Sequence[str] = COORDS, prefix: str = "c") -> DataFrame:
    """Cut segments into equal parts no longer than ``limit``.

    Adds the part number ``{prefix}part`` and the coordinates ``{prefix}x1`` ... of the part.  Bounds
    the number of grid cells one row can touch, however long the segment.
    """
    x1, y1, x2, y2 = names
    p = prefix + "part"
    d = df.selectExpr("*", f"CAST(greatest(1, ceil(sqrt(({x2}-{x1})*({x2}-{x1}) + ({y2}-{y1})*({y2}-{y1})) / {limit}D)) AS INT) AS _n")
    d = d.selectExpr("*", f"explode(sequence(0, _n - 1)) AS {p}")
    at = lambda lo, hi, k: f"{lo} + ({hi} - {lo}) * (({k}) / _n)"
    return d.selectExpr(
        *df.columns, p, f"{at(x1, x2, p)} AS {prefix}x1", f"{at(y1, y2, p)} AS {prefix}y1",
        f"CASE WHEN {p} + 1 = _n THEN {x2} ELSE {at(x1, x2, p + ' + 1')} END AS {prefix}x2",
        f"CASE WHEN {p} + 1 = _n THEN {y2} ELSE {at(y1, y2, p + ' + 1')} END AS {prefix}y2")


def near_intervals(lines: DataFrame, others: DataFrame, keys: Sequence[str], cell: float = CELL) -> DataFrame:
    """Parts [t0, t1] of every line part within ``r`` of another segment.

    ``lines``: ``keys`` + seg_idx + coordinates.  ``others``: coordinates + r; equal rows count once,
    since a union does not change by repetition.
    """
    keys = list(keys)
    a = cut_long(lines.select(*keys, "seg_idx", *COORDS), 4 * cell)
    a = a.select(*keys, "seg_idx", "cpart", "cx1", "cy1", "cx2", "cy2")
    a, a_box = with_box(a, "a_", 0.0, ("cx1", "cy1", "cx2", "cy2"))
    b = cut_long(others.select(*COORDS, "r").distinct(), 4 * cell, prefix="o")
    b = b.select("ox1", "oy1", "ox2", "oy2", "r")
    b, b_box = with_box(b, "b_", "r", ("ox1", "oy1", "ox2", "oy2"))
    pairs = box_pairs(a, b, a_box, b_box, cell)
    d = add_capsule_interval(pairs, ("cx1", "cy1", "cx2", "cy2"), ("ox1", "oy1", "ox2", "oy2"), "r")
    plen = length("cx1", "cy1", "cx2", "cy2")
    return d.filter(F.col("t0") <= F.col("t1")).select(*keys, "seg_idx", "cpart", plen.alias("plen"), "t0", "t1")


def covered_length(lines: DataFrame, others: DataFrame, keys: Sequence[str] = ("line_id",), cell: float = CELL) -> DataFrame:
    """Per line: ``length``, ``covered`` within the others' distances, and ``rest`` = 1 - covered / length.

    ``rest`` is null for a line without length.
    """
    keys = list(keys)
    near = settle(near_intervals(lines, others, keys, cell), "near")
    found = union_measure(near, [*keys, "seg_idx", "cpart", "plen"], "t0", "t1")
    whole = lines.select(*keys, length().alias("length"), F.lit(0.0).alias("covered"))
    part = found.select(*keys, F.lit(0.0).alias("length"), (F.col("measure") * F.col("plen")).alias("covered"))
    d = whole.unionByName(part).groupBy(*keys).agg(F.sum("length").alias("length"), F.sum("covered").alias("covered"))
    return d.withColumn("rest", 1 - F.col("covered") / F.nullif(F.col("length"), F.lit(0.0)))


def open_or_closed(rest: Column | str) -> Column:
    """'ja' when at most 36 % of a line is uncovered, else 'nein'; also 'nein' without a ratio."""
    r = F.col(rest) if isinstance(rest, str) else rest
    return F.when(F.round(r, 9) <= MAX_REST, "ja").otherwise("nein")


def classify_coverage(lines: DataFrame, masks: DataFrame, keys: Sequence[str] = ("line_id",), cell: float = CELL) -> DataFrame:
    """Contra-flow status per one-way line against masks with their own width ``r``."""
    return covered_length(lines, masks, keys, cell).withColumn("rge", open_or_closed("rest"))
