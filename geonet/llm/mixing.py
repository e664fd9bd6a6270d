"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every document has a fixed 60-bit hash.  A source whose target is ``full`` whole copies of itself plus
a rest takes one more copy of the documents whose hash lies below a threshold.  The threshold is found
without sorting: words are summed by source and by the 12 leading hash bits, the bucket in which the
budget runs out is the boundary bucket, and only its documents are summed again by the next 12 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.llm.common import WORD_SQL, free_name, row_key, stored
from geonet.session import Scratch

HASH_BITS = 60
BUCKET_BITS = 12


def words_of(text: str = "text") -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.expr(f"regexp_count(`{text}`, {WORD_SQL})"), F.lit(0)).cast("long")


def hash60(key: Column) -> Column:
    """First 15 hex digits of the MD5 of a key, as a number."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_key(source: str) -> Column:
    """Text without nulls that tells sources, and the null source, apart."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeat: int) -> DataFrame:
    """Target words per source from (source, source_size): one row per source goes through one window.

    Weights repeat along the sources by code point, null last.  ``share`` of all words is dealt by weight;
    a target stops at ``repeat`` times its source and the excess goes to the others by weight.  Sources are
    taken by rising (cap / weight); the first that its fill level does not cap sets the level of the rest.
    """
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    by_name, every = W.orderBy(F.asc_nulls_last("source")), W.partitionBy(F.lit(1))
    d = sizes.withColumn("w", F.element_at(dealt, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    d = d.withColumn("cap", (F.col("source_size") * repeat).cast("double"))
    order = W.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(float(share))
    d = d.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(onward))
    d = d.withColumn("open", F.col("cap") > F.col("level") * F.col("w"))
    d = d.withColumn("fill", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("cap") / F.col("w"))).over(every))
    return d.select("source", "source_size", F.when(F.col("open"), F.col("fill") * F.col("w")).otherwise(F.col("cap")).alias("target"))


def thresholds(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2,
               text: str = "text", source: str = "source", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents, sources): (doc_id, source, size, h, sk) and (sk, source, source_size, target, full, theta).

    A document is taken ``full`` times, and once more if h < theta.  The document at the boundary is taken
    if that brings the source nearer to its target, so a source misses it by half a document at most; rows
    that share id (or, without id, text) share their hash and go together.  A source without words has
    target 0.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    slim = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_of(text).alias("size"),
                              hash60(row_key(doc_id, text)).alias("h"), source_key(source).alias("sk")), "mix-docs")
    sizes = slim.groupBy("sk").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    aims = targets(sizes.select("source", "source_size"), weights, share, repeat).withColumn("sk", source_key("source"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.withColumn("full", F.least(full, F.lit(repeat)).cast("int"))
    aims = stored(aims.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "mix-targets")

    scratch = Scratch(spark, "mix-levels")
    near, rest = slim, aims.select("sk", "rest")
    found = None
    for level in range(1, HASH_BITS // BUCKET_BITS + 1):
        bucket = F.shiftright("h", HASH_BITS - BUCKET_BITS * level)
        sums = near.groupBy("sk", bucket.alias("bucket")).agg(F.sum("size").alias("s"), F.min("h").alias("low"), F.max("h").alias("high"))
        run = W.partitionBy("sk").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("s").over(run), F.lit(0)))
        edge = sums.join(rest, "sk").filter("before <= rest AND rest < before + s")
        edge = edge.selectExpr("sk", "bucket", "low", "high", "s", "rest - before AS rest")
        edge, seen = scratch.cut_watched(edge, f"edge-{level}", split="count_if(low < high)")
        done = edge.filter("low = high").selectExpr("sk", "low + int(2 * rest >= s) AS theta")
        found = done if found is None else found.unionByName(done)
        if not seen["split"]:
            break
        edge = edge.filter("low < high")
        near = scratch.cut(near.join(edge.select("sk", "bucket"), (near["sk"] == edge["sk"]) & (bucket == edge["bucket"]), "left_semi"),
                           f"near-{level}")
        rest = edge.select("sk", "rest")
    sources = aims.join(found, "sk", "left").withColumn("theta", F.coalesce("theta", F.lit(0)))
    return slim, sources.select("sk", "source", "source_size", "target", "full", "theta")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken.

    Null or empty texts have size 0 and take nothing; other columns of ``docs`` are not read.
    """
    slim, sources = thresholds(docs, **options)
    d = slim.join(sources.drop("source"), "sk")
    d = d.withColumn("copies", F.col("full") + (F.col("h") < F.col("theta")).cast("int"))
    return d.selectExpr("doc_id", "source", "size", "source_size", "target", "copies", "size * copies AS taken")


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it."""
    _, sources = thresholds(docs, text=text, source=source, doc_id=doc_id, **options)
    key, n = free_name(docs, "_mix_key"), free_name(docs, "_mix_n")
    few = sources.select(F.col("sk").alias(key), F.struct("full", "theta").alias(n))
    d = docs.withColumn(key, source_key(source)).join(few, key)
    h = hash60(row_key(doc_id, text))
    d = d.withColumn(n, F.explode(F.sequence(F.lit(0), F.col(n)["full"] + (h < F.col(n)["theta"]).cast("int"))))
    return d.filter(F.col(n) > 0).select(*docs.columns)
