"""Distance along the walking network to the next seat."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from geonet.functions import attributes as at
from geonet.operators import chains, clip, coloring, graph, noding, simplify
from geonet.operators.intervals import dedupe_splits
from geonet.operators.scan import index_block, ordered_scan
from geonet.operators.skew import salted_join
from geonet.operators.vertices import cut_segments, explode_lines, feature_segments, representative_point, to_segments
from geonet.session import settle

SEARCH_RADIUS = 20.0


@dataclass
class Seating:
    """Intermediate and final tables of the seating map."""

    seats: DataFrame
    edges: DataFrame
    dist: DataFrame
    pieces: DataFrame
    lines: DataFrame


def split_elements(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seats as points and roads as segments; an element with a seat tag is a seat, whatever else it is.

    Elements are kept by one filter, so none appears twice.  Rings count as lines, points are no roads.
    """
    kept = elements.filter(at.seat_filter() | (at.walkable_filter() & at.tag_exclusion()))
    kept = kept.withColumn("feature_id", F.struct("osm_type", "osm_id"))
    seats = representative_point(explode_lines(kept.filter(at.is_seat()).select("feature_id", "parts"), min_points=1))
    roads = kept.filter(~at.is_seat()).withColumn("road_type", at.road_type())
    roads = feature_segments(roads.select("feature_id", "road_type", "parts"))
    return seats, roads.selectExpr("struct(feature_id, part) AS line_id", "seg_idx", "road_type", "x1", "y1", "x2", "y2")


def dense(cut: DataFrame) -> DataFrame:
    """Cut segments with positions 0, 1, 2, ... along their line."""
    counts = cut.groupBy("line_id", "seg_idx").agg(F.expr("count(1) AS n"))
    base = ordered_scan(counts, ["line_id"], ["seg_idx"], index_block("seg_idx"), sums={"base": F.col("n")}).drop("n")
    d = salted_join(cut, base, ["line_id", "seg_idx"])
    return d.selectExpr("line_id", "CAST(base + before AS INT) AS seg_idx", "road_type", "x1", "y1", "x2", "y2")


def renumber(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Vertices with gaps in idx, numbered 0, 1, 2, ... again."""
    d = ordered_scan(vertices, keys, ["idx"], index_block("idx"), sums={"_i": F.lit(1)})
    return d.selectExpr(*keys, "CAST(_i AS INT) AS idx", "x", "y")


def seating_distance(elements: DataFrame, boundary: DataFrame | None, strict: bool = False, radius: float = SEARCH_RADIUS,
                     tolerance: float = simplify.TOLERANCE) -> Seating:
    """Road pieces coloured by the walking distance to the next seat, clipped to the boundary."""
    seats, roads = split_elements(elements)
    seats = settle(seats, "seats")
    return seating_from(seats, settle(roads, "roads"), boundary, strict, radius, tolerance)


def seating_from(seats: DataFrame, roads: DataFrame, boundary: DataFrame | None, strict: bool = False, radius: float = SEARCH_RADIUS,
                 tolerance: float = simplify.TOLERANCE) -> Seating:
    """The same from seat points (x, y) and road segments (line_id, seg_idx, road_type, coordinates)."""
    merged = settle(chains.merge_lines(roads).selectExpr("chain_id AS line_id", "seg_idx", "road_type", "x1", "y1", "x2", "y2"), "merged")
    # A crossing or a seat's snap point becomes a vertex of its line.
    noded = settle(dense(cut_segments(merged, noding.crossings(merged), ["line_id"])), "noded")
    snaps = settle(noding.nearest_on_each_line(seats, noded, radius), "snaps")
    inner = dedupe_splits(snaps.select("line_id", "seg_idx", "t", "x", "y").filter("t > 0 AND t < 1"), ["line_id", "seg_idx"])
    network = settle(dense(cut_segments(noded, inner, ["line_id"])), "network")
    edges = settle(graph.build_edges(network), "edges")
    # Beyond 75 m only reachability matters: an edge with an end nearer than 75 m has both within the cutoff.
    longest = edges.agg(F.max("len")).first()[0] or 0.0
    starts = settle(graph.source_offsets(snaps), "starts")
    dist = graph.network_distance(edges, starts, cutoff=max(coloring.THRESHOLDS) + longest)
    labels = settle(graph.connected_components(edges), "labels")
    served = labels.join(dist.select("node"), "node", "left_semi").select("component").distinct()
    reached = salted_join(labels, served, ["component"], "left_semi").select("node")
    pieces = settle(coloring.color_edges(edges, dist, reached=reached), "pieces")
    runs = settle(coloring.merge_runs(pieces), "runs")
    run = ["line_id", "color", "run"]
    facts = coloring.run_attributes(runs).select("line_id", "color", "run", "road_type")
    thin = simplify.simplify_lines(settle(coloring.run_vertices(runs), "shape"), tolerance, run)
    segs = to_segments(renumber(settle(thin, "thin"), run), run).select(*run, "seg_idx", "x1", "y1", "x2", "y2")
    segs = salted_join(segs, facts, run).withColumn("minzoom", at.minzoom(F.coalesce("road_type", F.lit(""))))
    lines = clip.clip_lines(settle(segs, "map"), boundary, run, strict)
    return Seating(seats, edges, dist, pieces, lines)
