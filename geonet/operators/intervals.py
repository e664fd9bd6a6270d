"""Interval algebra per key: union, measure of the union, gaps, near-equal cut points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.functions.geometry import let
from geonet.operators.scan import ordered_scan
from geonet.session import Scratch, settle

UNIT_BLOCKS = 256  # blocks of a [0, 1] axis
WALK_ROWS = 256  # points of a chain that are walked in one row


def compact(df: DataFrame, keys: Sequence[str], lo: str, hi: str, width: float) -> DataFrame:
    """Union of the intervals that start in the same block, after equal starts were combined map-side."""
    d = df.groupBy(*keys, lo).agg(F.max(hi).alias(hi)).withColumn("_blk", F.floor(F.col(lo) / width))
    w = W.partitionBy(*keys, "_blk").orderBy(lo)
    d = d.withColumn("_reach", F.max(hi).over(w.rowsBetween(W.unboundedPreceding, -1)))
    d = d.withColumn("_isle", F.count_if(F.col("_reach").isNull() | (F.col(lo) > F.col("_reach"))).over(w))
    return d.groupBy(*keys, "_blk", "_isle").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_blk", "_isle")


def _reach(df: DataFrame, keys: Sequence[str], lo: str, hi: str, width: float, once: bool = False) -> DataFrame:
    """Compacted intervals with the furthest end seen before each (``_reach``).

    A scan reads its input twice, and two scans four times; with ``once`` the compacted intervals are written.
    """
    d = compact(df, keys, lo, hi, width)
    d = settle(d, "compact") if once else d
    return ordered_scan(d, keys, [lo], F.floor(F.col(lo) / width), maxes={"_reach": F.col(hi)})


def merge_intervals(df: DataFrame, keys: Sequence[str], lo: str, hi: str, width: float = 1 / UNIT_BLOCKS) -> DataFrame:
    """Union of the intervals of each key; intervals that touch become one."""
    keys = list(keys)
    opens = F.when(F.col("_reach").isNull() | (F.col(lo) > F.col("_reach")), 1).otherwise(0)
    d = _reach(df, keys, lo, hi, width, once=True).withColumn("_open", opens).drop("_reach")
    d = ordered_scan(d, keys, [lo], F.floor(F.col(lo) / width), sums={"_isle": F.col("_open")})
    d = d.withColumn("_isle", F.col("_isle") + F.col("_open"))
    return d.groupBy(*keys, "_isle").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_isle")


def union_measure(df: DataFrame, keys: Sequence[str], lo: str, hi: str, out: str = "measure",
                  width: float = 1 / UNIT_BLOCKS) -> DataFrame:
    """Length of the union of the intervals of each key."""
    fresh = F.col(hi) - F.greatest(F.col(lo), F.col("_reach"))
    gain = F.greatest(F.lit(0.0), fresh.cast("double"))
    return _reach(df, keys, lo, hi, width).groupBy(*keys).agg(F.sum(gain).alias(out))


def gaps(df: DataFrame, keys: Sequence[str], lo: str, hi: str, start: Column, end: Column,
         width: float = 1 / UNIT_BLOCKS) -> DataFrame:
    """Parts of [start, end] that no interval of the key covers; keys without intervals do not appear."""
    keys = list(keys)
    d = _reach(df, keys, lo, hi, width, once=True)
    left = F.greatest(start, F.col("_reach"))
    right = F.least(end, F.col(lo))
    inner = d.select(*keys, left.alias(lo), right.alias(hi))
    ends = df.groupBy(*keys).agg(F.max(hi).alias("_end"))
    tail = ends.select(*keys, F.greatest(start, F.col("_end")).alias(lo), end.alias(hi))
    return inner.unionByName(tail).filter(F.col(lo) < F.col(hi))


def dedupe_splits(df: DataFrame, keys: Sequence[str], t: str = "t", eps: float = 1e-6,
                  scale: Column | None = None) -> DataFrame:
    """Drop cut points closer than ``eps`` to the last one kept before them on the same segment.

    ``scale`` turns the gap in ``t`` (0 or more) into another unit, for instance metres; it is one value per segment.
    Only points in a chain, each nearer than ``eps`` to the next, depend on each other.  A chain of up to
    ``WALK_ROWS`` points is walked in one row; the points of a longer one stay rows (``_by_jumps``).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in (*keys, t)]
    once = df.groupBy(*keys, t)
    once = once.agg(*[F.min(c).alias(c) for c in rest]).select(*df.columns) if rest else df.distinct()
    scratch = Scratch(df.sparkSession, "splits")
    d = ordered_scan(once, keys, [t], F.floor(F.col(t) * UNIT_BLOCKS), previous={"_before": t})
    unit = F.lit(1.0) if scale is None else scale.cast("double")
    d = d.withColumn("_unit", unit)
    gap = (F.col(t) - F.col("_before")) * F.col("_unit")
    d = d.withColumn("_open", F.when(F.col("_before").isNull() | (gap >= eps), 1).otherwise(0)).drop("_before")
    d = ordered_scan(d, keys, [t], F.floor(F.col(t) * UNIT_BLOCKS), sums={"_chain": F.col("_open")})
    d = scratch.cut(d.withColumn("_chain", F.col("_chain") + F.col("_open")).drop("_open"), "chains")
    on = [*keys, "_chain"]
    long, seen = scratch.cut_watched(d.groupBy(*on).agg(F.min(t).alias("_head"), F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > WALK_ROWS).drop("_n"), "long", n="count(1)")
    short = d.join(long, on, "left_anti") if seen["n"] else d
    row = F.struct(t, "_unit", *rest)
    chains = short.groupBy(*on).agg(F.array_sort(F.collect_list(row)).alias("_pts"))
    kept = F.aggregate(F.slice("_pts", 2, F.greatest(F.size("_pts") - 1, F.lit(0))), F.slice("_pts", 1, 1), lambda acc, x: F.when(
        (x[t] - F.element_at(acc, -1)[t]) * x["_unit"] >= eps, F.concat(acc, F.array(x))).otherwise(acc))
    walked = chains.select(*keys, F.inline(kept)).select(*df.columns)
    if not seen["n"]:
        return walked
    points = d.join(long, on, "left_semi")
    return walked.unionByName(points.join(_by_jumps(points, long, on, t, eps, scratch), [*on, t], "left_semi").select(*df.columns))


def _by_jumps(points: DataFrame, heads: DataFrame, on: list[str], t: str, eps: float, scratch: Scratch) -> DataFrame:
    """The points of each chain that a walk from its ``_head`` keeps, in steps to the next point ``eps`` on.

    Every point asks for the first point from its threshold on: points and questions are scanned together from the
    far end, in blocks that follow their rank.  Steps are then doubled: a round adds to the kept points those that
    lie as many steps further as the walk has points so far, so the rounds are the logarithm of the points kept.
    """
    # The least number that passes the test itself, (x - t) * unit >= eps, a few units in the last place around the quotient.
    guess = let(points, _x=f"{t} + {eps!r}D / nullif(_unit, 0D)")
    guess = let(guess, _ulp="pow(2D, floor(log2(greatest(_x, 1e-300D))) - 52)")
    asks = guess.selectExpr(*on, f"-array_min(filter(transform(sequence(-8, 8), k -> _x + k * _ulp), x -> (x - {t}) * _unit >= {eps!r}D)) AS _neg",
                            "1 AS _ask", t)
    rows = points.selectExpr(*on, f"-{t} AS _neg", "0 AS _ask", t).unionByName(asks)
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*on, "_neg", "_ask"]
    rows = scratch.cut(rows.repartitionByRange(tasks, *order).withColumn("_rank", F.spark_partition_id()), "asked")
    step = ordered_scan(rows, on, ["_neg", "_ask"], F.col("_rank"), maxes={"_next": F.when(F.col("_ask") == 0, F.col("_neg"))})
    step = scratch.cut(step.filter("_ask = 1").selectExpr(*on, t, "-_next AS _to"), "steps")
    # Only heads and points that some step leads to can be kept.
    heads = heads.withColumnRenamed("_head", t)
    reached = step.filter("_to IS NOT NULL").selectExpr(*on, f"_to AS {t}").unionByName(heads).distinct()
    jump = scratch.cut(step.join(reached, [*on, t], "left_semi").filter("_to IS NOT NULL"), "jumps")
    kept, rounds = [heads], 0
    while True:
        rounds += 1
        walk = reduce(DataFrame.unionByName, kept)
        more, seen = scratch.cut_watched(walk.join(jump, [*on, t]).selectExpr(*on, f"_to AS {t}"), f"kept{rounds}", n="count(1)")
        if not seen["n"]:
            return walk
        kept.append(more)
        onward = jump.selectExpr(*on, f"{t} AS _to", "_to AS _far")
        jump = scratch.cut(jump.join(onward, [*on, "_to"]).selectExpr(*on, t, "_far AS _to"), "jumps")
