"""Contra-flow status of one-way streets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from geonet.functions import attributes as at
from geonet.operators import cover, dissolve, match, noding, vertices
from geonet.operators.skew import salted_join
from geonet.session import settle

SYNC_TOLERANCE = 0.5
NODE_TOLERANCE = 1.5
SPLIT_TOLERANCE = 1.0


@dataclass
class OnewayResult:
    """Pieces with status and attributes, and the dissolved lines with their geometry rows."""

    pieces: DataFrame
    merged: DataFrame
    lines: DataFrame


def street_attributes(streets: DataFrame) -> DataFrame:
    """Display attributes of a street from its source attributes, one row per street_id."""
    d = at.rename_attrs(streets)
    clean = {
        "Straßenbreite_m": at.known_width, "Ebene": at.shown_level, "Bezirk": at.district_code,
        "Bezirk rechts": at.district_code, "Bezirk links": at.district_code,
        "Funktionale Straßenklasse": at.crop_leading_number, "Wegetyp": at.crop_leading_number,
    }
    return d.withColumns({name: fn(f"`{name}`") for name, fn in clean.items() if name in d.columns})


def with_own(pieces: DataFrame, own: DataFrame, names: list[str]) -> DataFrame:
    """Attributes of the one-way itself where it has them, else the street's; its other columns come along."""
    mine = at.drop_attrs(own)
    extra = [c for c in mine.columns if c != "line_id"]
    mine = mine.select(F.col("line_id").alias("_line"), *[F.col(f"`{c}`").alias(f"_own_{c}") for c in extra])
    d = pieces.join(mine, F.expr("oneway_id.line_id = _line"), "left").drop("_line")
    filled = {c: at.fill_from(f"`_own_{c}`", f"`{c}`") if c in names else F.col(f"`_own_{c}`") for c in extra}
    return d.withColumns(filled).drop(*[f"_own_{c}" for c in extra])


def oneway_status(oneways: DataFrame, streets: DataFrame, attrs: DataFrame, masks: DataFrame,
                  sync_tol: float = SYNC_TOLERANCE, own: DataFrame | None = None) -> OnewayResult:
    """Which pieces of one-way streets are open to contra-flow cycling.

    ``oneways`` / ``streets``: segments by line_id; ``attrs``: source attributes by street_id; ``masks``:
    segments with feature_id and submerkmal; ``own``: attributes of the one-ways by line_id under their display
    names, which win over the street's.  The layers are synchronised at each other's vertices,
    one-ways are cut at true intersections and matched to a street, covered shares decide the
    status, and connected pieces with equal attributes are dissolved, closed ones ('nein') first.
    """
    base = ["line_id", "seg_idx", *cover.COORDS]
    piece = lambda d, name: d.selectExpr(f"struct(line_id, piece) AS {name}", "seg_idx", *cover.COORDS)
    first = settle(noding.sync_nodes(oneways, streets.select(*base), sync_tol), "streets")
    second = noding.sync_nodes(first, oneways.select(*base), sync_tol)
    street_pieces = piece(first, "street_id")
    nodes = noding.true_intersections(street_pieces.withColumnRenamed("street_id", "line_id"), NODE_TOLERANCE)
    nodes = nodes.selectExpr(f"{vertices.node_key('x', 'y', SPLIT_TOLERANCE)} AS node")
    whole = second.withColumnRenamed("piece", "synced")
    cut = vertices.split_at_nodes(whole, nodes, SPLIT_TOLERANCE, ["line_id", "synced"])
    cut = cut.selectExpr("struct(line_id, synced, piece) AS oneway_id", "seg_idx", *cover.COORDS)
    cut = settle(cut, "oneways")
    best = settle(match.match_best(cut, street_pieces), "best")
    matched = settle(cut.join(best, "oneway_id", "left_semi"), "matched")
    status = cover.classify_coverage(matched, at.lookup_width(masks), ["oneway_id"])
    shown = street_attributes(attrs)
    names = [c for c in shown.columns if c != "street_id"]
    pieces = settle(status.join(best.selectExpr("oneway_id", "street_id.line_id AS street_id"), "oneway_id"), "status")
    pieces = salted_join(pieces, shown, ["street_id"])
    if own is not None:
        pieces = with_own(pieces, own, names)
        names += [c for c in at.drop_attrs(own).columns if c not in ("line_id", *names)]
    pieces = pieces.withColumnRenamed("rge", "RgE").withColumn("ord", F.when(F.col("RgE") == "nein", 0).otherwise(1))
    pieces = settle(pieces.select("oneway_id", "length", "rest", "RgE", "ord", *names), "pieces")
    same = [k for k in at.MERGE_KEYS if k in pieces.columns]
    merged, lines = dissolve.dissolve_lines(matched, pieces.drop("length", "rest"), same, SPLIT_TOLERANCE, "oneway_id", "ord")
    return OnewayResult(pieces, merged.withColumn("layername", F.lit("RgE-Analyse")), lines)
