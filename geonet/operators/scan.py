"""Ordered operators over groups of any size.

A window over a whole group puts that group into one task.  Here a group is cut into blocks
that follow its order; each block is one window partition, led by one summary row of what earlier
blocks contribute.  The result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.session import settle

BLOCK_ROWS = 4_096


def index_block(idx: str, rows: int | None = None) -> Column:
    """Block number of a dense integer position."""
    return F.floor(F.col(idx) / (rows or BLOCK_ROWS))


def next_row(df: DataFrame, keys: Sequence[str], idx: str, cols: Sequence[str],
             prefix: str = "next_", rows: int | None = None) -> DataFrame:
    """Columns of the row at ``idx + 1`` for groups numbered 0, 1, 2, ... without gaps.

    The first row of a block is also sent to the block before it, so one shuffle with bounded
    window partitions is enough.  The last row of a group gets nulls.
    """
    rows = rows or BLOCK_ROWS
    home = index_block(idx, rows)
    sent = F.when((F.col(idx) > 0) & (F.col(idx) % rows == 0), F.array(home, home - 1)).otherwise(F.array(home))
    w = W.partitionBy(*keys, "_blk").orderBy(idx)
    out = df.withColumn("_blk", F.explode(sent))
    for c in cols:
        out = out.withColumn(prefix + c, F.lead(c).over(w))
    return out.filter(F.col("_blk") == home).drop("_blk")


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
                 sums: dict[str, Column] | None = None, maxes: dict[str, Column] | None = None,
                 previous: dict[str, str] | None = None) -> DataFrame:
    """Exclusive prefix sums and maxima and previous-row values along ``order`` per ``keys``.

    ``block`` must not decrease along ``order``.  ``sums``/``maxes`` map an output column to the
    expression accumulated over earlier rows (0 / null before the first); ``previous`` maps an
    output column to the column whose value in the preceding row it takes.
    """
    sums, maxes, previous = sums or {}, maxes or {}, previous or {}
    out = _in_blocks(df, list(keys), list(order), block, sums, maxes, previous).filter(~F.col("_head"))
    return out.select(*df.columns, *sums, *maxes, *previous)


def opened_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, opens: Column, out: str,
                previous: dict[str, str], stored: bool = False) -> DataFrame:
    """Number of rows up to each, itself included, where ``opens`` holds, along ``order`` per ``keys``, as ``out``.

    ``opens`` may read the columns of ``previous``, which are those of ``ordered_scan``.  Rows are moved
    once and written with the count within their block; only rows of groups in several blocks are moved
    again, to add the counts of earlier blocks.  A ``stored`` table, cheap to read twice, is first searched for a
    second block; without one there is nothing to carry.
    """
    keys, order = list(keys), list(order)
    ends = df.agg(F.min(block).alias("lo"), F.max(block).alias("hi")).first() if stored else None
    single = ends is not None and ends["lo"] == ends["hi"]
    d = _in_blocks(df, keys, order, block, {}, {}, previous, firsts=True, single=single)
    upto = W.partitionBy(*keys, "_blk").orderBy(F.desc("_head"), *order).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns({out: F.count_if(~F.col("_head") & opens).over(upto), "_many": F.first("_head").over(upto)})
    if single:
        return d.select(*df.columns, out)
    d = settle(d.filter(~F.col("_head")).select(*df.columns, out, "_blk", "_many"), "opened")
    parts = d.filter("_many")
    over = W.partitionBy(*keys).orderBy("_blk")
    base = F.when(F.lag("_blk").over(over).isNotNull(), F.sum("_n").over(over.rowsBetween(W.unboundedPreceding, -1)))
    carry = parts.groupBy(*keys, "_blk").agg(F.max(out).alias("_n")).select(*keys, "_blk", base.alias("_base"))
    parts = parts.join(carry.hint("merge"), [*keys, "_blk"], "left").withColumn(out, F.col(out) + F.coalesce("_base", F.lit(0)))
    return d.filter("NOT _many").select(*df.columns, out).unionByName(parts.select(*df.columns, out))


def _in_blocks(df: DataFrame, keys: list[str], order: list[str], block: Column, sums: dict[str, Column],
               maxes: dict[str, Column], previous: dict[str, str], firsts: bool = False, single: bool = False) -> DataFrame:
    """The rows of ``ordered_scan`` with ``_blk``; every block after others of its group is led by a row with ``_head``.

    With ``firsts`` a group's first block is led by an empty one, if others follow.  With ``single`` no group has others.
    """
    d = df.withColumn("_blk", block)
    last = F.max_by(F.struct(*dict.fromkeys(previous.values())), F.struct(*order)) if previous else None

    totals = d.groupBy(*keys, "_blk").agg(
        *[F.sum(e).alias(f"_s_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_m_{n}") for n, e in maxes.items()],
        *([last.alias("_last")] if previous else []),
    )
    over = W.partitionBy(*keys).orderBy("_blk")
    before = over.rowsBetween(W.unboundedPreceding, -1)
    # As joins do, rows whose key holds a null take nothing from other blocks.
    known = reduce(and_, [F.col(k).isNotNull() for k in keys], F.lag("_blk").over(over).isNotNull())
    carry = totals.select(
        *keys, "_blk",
        F.lag("_blk").over(over).alias("_prior"),
        (F.lead("_blk").over(over) if firsts else F.lit(None)).alias("_later"),
        *[F.when(known, F.sum(f"_s_{n}").over(before)).alias(f"_cs_{n}") for n in sums],
        *[F.when(known, F.max(f"_m_{n}").over(before)).alias(f"_cm_{n}") for n in maxes],
        *([F.when(known, F.lag("_last").over(over)).alias("_clast")] if previous else []),
    ).filter("_prior IS NOT NULL OR _later IS NOT NULL").drop("_prior", "_later").withColumn("_head", F.lit(True))

    if single:
        carry = carry.limit(0)
    # The carried row leads its block.  A join would do the same, but the optimizer takes an exploded input for
    # as small as the table under it, and would send the carried rows of all blocks to the driver.
    d = d.withColumn("_head", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    local = W.partitionBy(*keys, "_blk").orderBy(F.desc("_head"), *order)
    above = local.rowsBetween(W.unboundedPreceding, -1)
    head = F.col("_head")
    out = d.withColumns({
        **{n: F.coalesce(F.sum(F.when(head, F.col(f"_cs_{n}")).otherwise(e)).over(above), F.lit(0)) for n, e in sums.items()},
        **{n: F.max(F.when(head, F.col(f"_cm_{n}")).otherwise(e)).over(above) for n, e in maxes.items()},
        **({"_row": F.lag(F.when(head, F.col("_clast")).otherwise(F.struct(*dict.fromkeys(previous.values())))).over(local)} if previous else {}),
    })
    return out.withColumns({n: F.col("_row")[c] for n, c in previous.items()})
