"""Hot-key handling shared by the joins.

A key may hold a large share of all rows.  The adaptive skew join splits the shuffle partitions of such keys
without a second pass over the data, so joins are plain ones.  Where the hot keys of a stored table are known
beforehand, its rows can be spread over salts made from the row and its partition, so that a re-run task
places them alike and copies of one row are spread too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 500_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Every key above ``hot_rows`` rows with the number of salts to spread it over; at most rows / hot_rows keys."""
    hot_rows = hot_rows or HOT_ROWS
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    return counted.select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))


def salted_join(many: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner",
                hot: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Equi-join where ``many`` may hold hot keys and ``few`` has few rows per key.

    Without ``hot`` (``hot_keys(many, keys)`` of a stored table) or ``hot_rows`` skew is left to the adaptive join.
    """
    keys = list(keys)
    if hot is None and hot_rows is None:
        return many.join(few, keys, how)
    hot = hot if hot is not None else hot_keys(many, keys, hot_rows)
    plain = [c for c, kind in many.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.coalesce(F.col("_salts"), F.lit(1)))
    left = many.join(hot, keys, "left").withColumn("_salt", spread.cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    right = few.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
