"""Whole GeoJSON documents read by many tasks.

A document is read in pieces that end at a closing brace, which the text reader finds in any split of the file.  Where
a piece stands in the document follows from two prefix sums over the pieces: quotes tell whether it begins inside a
string, braces outside of strings how deep it is.  A feature is what lies between two places of depth one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from geonet.operators.scan import ordered_scan
from geonet.session import Scratch
from geonet.sources import geojson

STRING = r'"(?:[^"\\]++|\\.)*+"'
LEAD = rf'(?s)^(?:[^{{"]++|{STRING})*+'  # everything up to the first brace outside of strings
PIECES_PER_BLOCK = 4_096


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file (path and name), size, at (place in order), text without its closing brace; q quotes, and braces opened outside and inside of its quotes."""
    d = spark.read.option("lineSep", "}").text(path).selectExpr(
        "struct(_metadata.file_path AS path, _metadata.file_name AS name) AS file", "_metadata.file_size AS size",
        "struct(_metadata.file_block_start AS start, monotonically_increasing_id() & 8589934591L AS n) AS at", "value AS text")
    d = d.withColumn("_parts", F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"', -1))
    opened = lambda odd: f"length(array_join(filter(_parts, (p, i) -> i % 2 = {odd}), '')) - length(replace(array_join(filter(_parts, (p, i) -> i % 2 = {odd}), ''), '{{', ''))"
    return d.selectExpr("file", "size", "at", "text", "size(_parts) - 1 AS q", f"{opened(0)} AS even", f"{opened(1)} AS odd")


def _scan(df: DataFrame, out: str, what: str) -> DataFrame:
    block = F.expr(f"struct(at.start, at.n div {PIECES_PER_BLOCK} AS n)")
    return ordered_scan(df, ["file"], ["at"], block, sums={out: F.expr(what)})


def members(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """The objects one level below each document's own, and one row per document.

    Members: file, num (their order), lead (text since the member before), body.  Documents: file, balanced (quotes and
    braces close), tail (the text after the last member).  Each member is gathered in one row, documents are not.
    """
    scratch = Scratch(spark, "documents")
    pieces = scratch.cut(_pieces(spark, path), "pieces")
    slim = pieces.select("file", "size", "at", "q", "even", "odd", F.octet_length("text").alias("bytes"))
    d = _scan(slim, "_quotes", "q")
    d = d.selectExpr("file", "size", "at", "q", "bytes", "_quotes % 2 = 1 AS within", "(_quotes + q) % 2 = 0 AS ends", "CASE WHEN _quotes % 2 = 1 THEN odd ELSE even END AS opened")
    d = scratch.cut(d.withColumn("change", F.expr("opened - CAST(ends AS INT)")), "change")
    d = scratch.cut(_scan(d, "_depth", "change").withColumn("closes", F.expr("ends AND _depth + change = 1")), "depth")
    # A piece that the end of the file cut short has no closing brace.
    files = d.groupBy("file").agg(F.expr("sum(q) % 2 = 0 AND sum(change) + CAST(sum(bytes + 1) > max(size) AS INT) = 0 AND min(_depth) >= 0 AS balanced"))
    d = scratch.cut(_scan(d, "num", "CAST(closes AS INT)").select("file", "at", "num", "closes"), "numbers")
    whole = pieces.join(d, ["file", "at"]).groupBy("file", "num").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "}").alias("text"), F.bool_or("closes").alias("closed"))
    # The first member follows the brace that opens the document.
    first = F.when(F.col("num") == 0, F.length(F.regexp_extract("text", LEAD, 0)) + 1).otherwise(0)
    whole = whole.withColumn("_first", first).withColumn("_rest", F.expr("substring(text, _first + 1)"))
    whole = whole.withColumn("lead", F.regexp_extract("_rest", LEAD, 0))
    whole = scratch.cut(whole.selectExpr("file", "num", "closed", "lead", "concat(substring(_rest, length(lead) + 1), '}') AS body"), "members")
    tails = whole.filter("NOT closed").selectExpr("file", "lead AS tail")
    return whole.filter("closed").drop("closed"), files.join(tails, "file", "left")


def read_large_features(spark: SparkSession, path: str | list[str], layer: str, bad: str = "raise") -> DataFrame:
    """As ``geojson.read_features`` of whole documents, with the same rows and ids, but a document is read by many tasks.

    Features are the objects of the document's array ``features``; other members are passed over.  A document whose
    quotes or braces do not close, that has no such array or a feature that cannot be parsed stops the read; with
    ``bad="skip"`` it is left out whole.  Each feature must fit in one row.  A null in the array is not counted
    in ids.  Empty files are not read.
    """
    found, files = members(spark, path)
    scratch = Scratch(spark, "features")
    # A member follows the name of an array, or its own name, or the member before it in the same array.
    array = F.regexp_extract("lead", rf'(?s)({STRING})\s*:\s*\[[^{{"]*$', 1)
    own = F.expr("lead").rlike(r'(?s):\s*$')
    d = found.withColumn("_array", F.when(own, F.lit("")).when(array != "", array))
    d = d.withColumn("_named", F.expr("CASE WHEN _array IS NOT NULL THEN struct(num, _array AS name) END"))
    block = F.expr(f"num div {PIECES_PER_BLOCK}")
    slim = ordered_scan(d.select("file", "num", "_named"), ["file"], ["num"], block, maxes={"_last": F.col("_named")})
    slim = slim.selectExpr("file", "num", "coalesce(_named.name, _last.name) = '\"features\"' AS feature")
    slim = scratch.cut(slim.filter("feature"), "kinds")
    slim = ordered_scan(slim, ["file"], ["num"], block, sums={"ord": F.lit(1)}).select("file", "num", "ord")
    named = r'(?s)"features"\s*:\s*\['
    has = found.groupBy("file").agg(F.bool_or(F.col("lead").rlike(named)).alias("_has"))
    parsed = found.join(slim, ["file", "num"]).withColumn(
        "f", F.from_json("body", f"{geojson.FEATURE[:-1]},_bad:string>", {"columnNameOfCorruptRecord": "_bad"}))
    parsed = scratch.cut(parsed.select("file", "ord", "f"), "parsed")
    wrong = parsed.groupBy("file").agg(F.expr("bool_or(f IS NULL OR f._bad IS NOT NULL) AS _wrong"))
    state = files.join(has, "file", "left").join(wrong, "file", "left").select("file", F.expr(
        "CASE WHEN NOT balanced OR coalesce(_wrong, false) THEN 'invalid json' END").alias("_why"),
        (F.coalesce("_has", F.lit(False)) | F.coalesce(F.col("tail").rlike(named), F.lit(False))).alias("_any"))
    state = scratch.cut(state.selectExpr("file", "coalesce(_why, CASE WHEN NOT _any THEN 'no features' END) AS reason").filter("reason IS NOT NULL"), "state")
    if bad != "skip":
        first = state.orderBy("file").first()
        if first:
            raise ValueError(f"unreadable GeoJSON file {first['file']['name']}: {first['reason']}")
    rows = parsed.join(state, "file", "left_anti").filter("f.geometry IS NOT NULL")
    return geojson._features(rows.selectExpr("file.name AS file", "ord", "f"), layer)
