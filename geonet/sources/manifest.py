"""File lists of two runs: what changed, whether to rebuild; run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def manifest_diff(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Status per file name by etag: new, changed, unchanged or removed."""
    d = prev.selectExpr("name", "etag AS _old", "1 AS _p").join(curr.selectExpr("name", "etag AS _new", "1 AS _c"), "name", "full_outer")
    return d.selectExpr("name", "CASE WHEN _p IS NULL THEN 'new' WHEN _c IS NULL THEN 'removed' WHEN _old <=> _new THEN 'unchanged' ELSE 'changed' END AS status")


def removed_files(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Names of the previous run that the current list no longer has."""
    return prev.join(curr, "name", "left_anti").select("name")


def rebuild_needed(diff: DataFrame, published: bool) -> DataFrame:
    """One row: counts per status and whether the output must be built again."""
    n = lambda s: F.expr(f"count_if(status = '{s}') AS n_{s}")
    changed = F.coalesce(F.expr("bool_or(status <> 'unchanged')"), F.lit(False))
    return diff.agg(n("new"), n("changed"), n("unchanged"), n("removed"), (changed | F.lit(not published)).alias("rebuild"))


def build_summary(counts: dict[str, DataFrame], parameters: dict[str, Column | float | str], started: Column | None = None) -> DataFrame:
    """One row with the row count of each layer, the parameters, and the time of the run if asked for.

    The layers are stacked as (layer) rows, so the counts are one aggregate.
    """
    rows = None
    for name, df in counts.items():
        one = df.select(F.lit(name).alias("layer"))
        rows = one if rows is None else rows.unionByName(one)
    summary = rows.agg(*[F.count_if(F.col("layer") == name).alias(name) for name in counts])
    fixed = {k: v if isinstance(v, Column) else F.lit(v) for k, v in parameters.items()}
    if started is not None:
        fixed |= {"started_at": started, "created_at": F.current_timestamp()}
    return summary.withColumns(fixed) if fixed else summary
