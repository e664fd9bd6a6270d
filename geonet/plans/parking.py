"""Road space within several distances of bike parking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from geonet.operators import cells, discs
from geonet.session import settle


@dataclass
class ParkingResult:
    """Areas per layer, the outline arcs of the k layers and the cell runs of the i layers."""

    areas: DataFrame
    arcs: DataFrame
    runs: DataFrame


def parking_coverage(points: DataFrame, streets: DataFrame, radii: Sequence[float] = cells.RADII,
                     street_buffer: float = cells.STREET_BUFFER, grid: float = cells.GRID, res: float = cells.RESOLUTION) -> ParkingResult:
    """Layers k (within a radius of parking, whole) and i (also within reach of a street, per grid cell).

    ``areas``: layer, radius, cell (null for k), area.  ``arcs``: r, x, y, a0, a1, the outline of each k region.
    ``runs``: layer, radius, cell, cy, c0, c1, the raster rows of each i region.  The k areas are exact; the i
    areas count raster cells.  Raises when a layer is empty, as there is nothing to build.
    """
    if points.isEmpty() or streets.isEmpty():
        raise ValueError("no usable streets or parking points")
    arcs = settle(discs.union_boundary(points, radii), "arcs")
    k = discs.outline_area(arcs).selectExpr("concat('k', radius) AS layer", "radius", "CAST(NULL AS BIGINT) AS cell", "area")
    within = settle(cells.intersect_runs(cells.disc_runs(points, radii, res), cells.road_runs(streets, street_buffer, res)), "within")
    runs = cells.split_by_grid(within, "i", res, grid)
    i = runs.groupBy("layer", "radius", "cell").agg(F.expr(f"sum(c1 - c0) * {res * res}D AS area"))
    return ParkingResult(k.unionByName(i), arcs, runs)
