"""Joining connected lines with equal attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from geonet.operators.graph import connected_components
from geonet.operators.skew import salted_join
from geonet.operators.vertices import node_key


def dissolve_groups(segs: DataFrame, attrs: DataFrame, same: Sequence[str], tol: float = 1.0, key: str = "line_id") -> DataFrame:
    """Component per line: lines that share a snapped end point and agree in ``same`` (nulls agree).

    ``attrs`` has one row per line.  At an end point every line is linked to the smallest line with
    its values there, so the number of links is linear in the number of ends.
    """
    ends = segs.groupBy(key).agg(F.expr("min_by(struct(x1 AS x, y1 AS y), seg_idx) AS s"), F.expr("max_by(struct(x2 AS x, y2 AS y), seg_idx) AS e"))
    sig = attrs.selectExpr(key, f"to_json(struct({', '.join(f'`{c}`' for c in same)})) AS sig")
    rows = ends.join(sig, key).selectExpr(
        key, "sig", f"explode(array({node_key('s.x', 's.y', tol)}, {node_key('e.x', 'e.y', tol)})) AS node").distinct()
    low = rows.groupBy("node", "sig").agg(F.min(key).alias("_low"))
    links = salted_join(rows, low, ["node", "sig"]).selectExpr(f"{key} AS src", "_low AS dst")
    found = connected_components(links)
    d = attrs.select(key).join(found.withColumnRenamed("node", key), key, "left")
    return d.selectExpr(key, f"coalesce(component, {key}) AS component")


def dissolve_lines(segs: DataFrame, attrs: DataFrame, same: Sequence[str], tol: float = 1.0, key: str = "line_id",
                   order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Multi-lines of connected equal lines.

    Returns one row per component (attributes of its first line by ``order``, number of lines) and the
    geometry as rows: component, line, seg_idx, coordinates.  A component may be as large as the
    network, so its lines stay rows; a piece of line that several members share is kept once.
    """
    groups = dissolve_groups(segs, attrs, same, tol, key)
    rest = [c for c in attrs.columns if c != key]
    rank = f"struct({order}, {key})" if order else key
    row = ", ".join(f"`{c}`" for c in rest)
    merged = attrs.join(groups, key).groupBy("component").agg(
        F.expr(f"min_by(struct({row}), {rank}) AS a"), F.expr("count(1) AS n_lines")).select("component", "n_lines", "a.*")
    geometry = salted_join(segs.select(key, "seg_idx", "x1", "y1", "x2", "y2"), groups, [key])
    a, b = "struct(x1 AS x, y1 AS y)", "struct(x2 AS x, y2 AS y)"
    lines = geometry.groupBy("component", F.expr(f"least({a}, {b}) AS p"), F.expr(f"greatest({a}, {b}) AS q")).agg(
        F.expr(f"min(struct({key}, seg_idx, x1, y1, x2, y2)) AS s")).select("component", "s.*")
    return merged, lines
