"""Matching two line layers by mutual overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.functions.geometry import add_capsule_interval, length
from geonet.operators.cover import CELL, COORDS, cut_long
from geonet.operators.grid import box_pairs, with_box
from geonet.operators.intervals import union_measure
from geonet.operators.skew import salted_join
from geonet.session import settle

TOLERANCE = 2.0
MIN_STREET = 0.6
MIN_ONEWAY = 0.85


def collapse_copies(segs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Keep one line per geometry.  Returns its segments and the groups (key, rep).

    The signature is order-free and combined map-side: two 64-bit hashes over the segments, their
    number and the total length.
    """
    row = ["seg_idx", *COORDS]
    sig = segs.groupBy(key).agg(
        F.bit_xor(F.xxhash64(*row)).alias("_h1"), F.bit_xor(F.xxhash64(F.lit("b"), *row)).alias("_h2"),
        F.count(F.lit(1)).alias("_n"))
    sig = settle(sig, "signatures")
    same = ["_h1", "_h2", "_n"]
    reps = sig.groupBy(*same).agg(F.min(key).alias("rep"))
    groups = salted_join(sig, reps, same).select(key, "rep")
    keep = reps.select(F.col("rep").alias(key))
    return settle(salted_join(segs, keep, [key], "left_semi"), "distinct"), groups


def line_stats(segs: DataFrame, key: str, prefix: str) -> DataFrame:
    """Length and box of each line."""
    return segs.groupBy(key).agg(
        F.sum(length()).alias(prefix + "len"),
        F.min(F.least("x1", "x2")).alias(prefix + "minx"), F.min(F.least("y1", "y2")).alias(prefix + "miny"),
        F.max(F.greatest("x1", "x2")).alias(prefix + "maxx"), F.max(F.greatest("y1", "y2")).alias(prefix + "maxy"))


def box_diagonal(tol: float):
    """Diagonal of the street box cut with the one-way box grown by ``tol``; null when they do not meet."""
    w = F.least(F.col("s_maxx"), F.col("o_maxx") + tol) - F.greatest(F.col("s_minx"), F.col("o_minx") - tol)
    h = F.least(F.col("s_maxy"), F.col("o_maxy") + tol) - F.greatest(F.col("s_miny"), F.col("o_miny") - tol)
    return F.when((w >= 0) & (h >= 0), F.sqrt(w * w + h * h))


def diag_ratio_ok(tol: float = TOLERANCE, min_street: float = MIN_STREET):
    """Coarse test on the boxes.  It rejects winding streets that the exact test would keep."""
    return box_diagonal(tol) / F.col("s_len") + 0.05 >= min_street


def match_lines(oneways: DataFrame, streets: DataFrame, tol: float = TOLERANCE, min_street: float = MIN_STREET,
                min_oneway: float = MIN_ONEWAY, cell: float = CELL) -> DataFrame:
    """Pairs with enough of the street near the one-way and enough of the one-way near the street.

    Inputs are segments: oneway_id / street_id, seg_idx, coordinates; geometries should be distinct
    (``collapse_copies``).  Output: oneway_id, street_id, overlap (street length near the one-way),
    street_share, oneway_share.
    """
    part = ["seg", "part", "x1", "y1", "x2", "y2"]

    def parts(df, key, p):
        d = cut_long(df.select(key, "seg_idx", *COORDS), 4 * cell)
        return d.select(key, *[F.col(c).alias(p + n) for c, n in zip(("seg_idx", "cpart", "cx1", "cy1", "cx2", "cy2"), part)])

    o_xy, s_xy = tuple("o" + c for c in COORDS), tuple("s" + c for c in COORDS)
    a, a_box = with_box(parts(oneways, "oneway_id", "o"), "a_", tol, o_xy)
    b, b_box = with_box(parts(streets, "street_id", "s"), "b_", 0.0, s_xy)
    near = box_pairs(a, b, a_box, b_box, cell)
    near = add_capsule_interval(near, o_xy, s_xy, tol, "ot0", "ot1")
    near = add_capsule_interval(near, s_xy, o_xy, tol, "st0", "st1")
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(side + "seg").alias("seg"), F.col(side + "part").alias("part"),
                 length(*[side + c for c in COORDS]).alias("plen"),
                 F.col(side + "t0").alias("t0"), F.col(side + "t1").alias("t1"))
        for side in ("o", "s")])
    ivs = near.select("oneway_id", "street_id", F.explode(sides).alias("v")).select("oneway_id", "street_id", "v.*")
    ivs = settle(ivs.filter(F.col("t0") <= F.col("t1")), "overlaps")
    got = union_measure(ivs, ["oneway_id", "street_id", "side", "seg", "part", "plen"], "t0", "t1")
    on = lambda side: F.sum(F.when(F.col("side") == side, F.col("measure") * F.col("plen")).otherwise(0.0))
    pairs = got.groupBy("oneway_id", "street_id").agg(on("o").alias("o_cov"), on("s").alias("overlap"))
    pairs = salted_join(settle(pairs, "pairs"), line_stats(oneways, "oneway_id", "o_"), ["oneway_id"])
    pairs = salted_join(pairs, line_stats(streets, "street_id", "s_"), ["street_id"])
    pairs = pairs.filter((F.col("s_len") > 0) & (F.col("o_len") > 0)).filter(diag_ratio_ok(tol, min_street))
    pairs = pairs.withColumns({"street_share": F.col("overlap") / F.col("s_len"), "oneway_share": F.col("o_cov") / F.col("o_len")})
    enough = (F.round("street_share", 9) >= min_street) & (F.round("oneway_share", 9) >= min_oneway)
    return pairs.filter(enough).select("oneway_id", "street_id", "overlap", "street_share", "oneway_share")


def best_match(pairs: DataFrame) -> DataFrame:
    """Per one-way the street with the largest overlap; the lowest id wins a tie."""
    rank = F.struct(-F.round("overlap", 9), "street_id")
    return pairs.groupBy("oneway_id").agg(F.min_by(F.struct("street_id", "overlap"), rank).alias("b")).select("oneway_id", "b.*")


def match_best(oneways: DataFrame, streets: DataFrame, **options) -> DataFrame:
    """Best street per one-way with copies of a geometry matched once and handed the result back."""
    o, groups = collapse_copies(oneways, "oneway_id")
    s, _ = collapse_copies(streets, "street_id")
    best = best_match(match_lines(o, s, **options)).withColumnRenamed("oneway_id", "rep")
    return salted_join(groups, best, ["rep"]).drop("rep")
