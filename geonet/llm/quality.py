"""Quality rules with risk-controlled thresholds.

Five rules score a document; a rule rejects it at or above a cutoff.  The cutoffs of a rule form a fixed
grid, written down before any label is seen.  For every stratum, rule and cutoff the labelled documents
give the number of good ones and of good ones rejected; the exact binomial tail at the tolerated rate is
the p-value of "the rule rejects more than that".  A cutoff is certified when its p-value is at most
``delta`` divided by the number of tests (Bonferroni), and each rule gets an equal part of ``alpha``, so
that with probability 1 - delta at most ``alpha`` of the good documents of any stratum are rejected.
Of the certified cutoffs the one that catches most bad labelled documents is taken.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.llm.common import few_at_once, stored

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
WINDOW = 5
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")

#: Rule -> (score, grid of cutoffs).  Scores are whole numbers per thousand words, so that they are exact.
RULES = {
    "symbols": ("floor(1000 * n_symbols / greatest(n_words, 1))", [20 * i for i in range(1, 51)]),
    "dup_lines": ("floor(10000 * n_dup_lines / greatest(n_words, 1))", [10 * i for i in range(1, 51)]),
    "repeats": ("floor(1000 * n_repeat_words / greatest(n_words, 1))", [4 * i for i in range(1, 51)]),
    "long_words": ("floor(1000 * word_chars / greatest(n_words, 1))", [4000 + 250 * i for i in range(1, 51)]),
    "short_words": ("8000 - floor(1000 * word_chars / greatest(n_words, 1))", [100 * i for i in range(20, 70)]),
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    wide = ids.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        h = (h ^ (h >> np.uint64(29))) * MIXERS[k] + wide[k:k + n] * MIXERS[-1 - k]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    a, b = order[:-1][same], order[1:][same]
    if all((ids[a + k] == ids[b + k]).all() for k in range(WINDOW)):
        hit = np.union1d(a, b)
    else:  # two different windows share a hash: compare the windows themselves
        first: dict[tuple, list[int]] = {}
        for i in range(n):
            first.setdefault(tuple(ids[i:i + WINDOW]), []).append(i)
        hit = np.array([i for at in first.values() if len(at) > 1 for i in at], dtype=np.int64)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + WINDOW, -1)
    return int((np.cumsum(change) > 0).sum())


def base_of(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly \x20 and \x09-\x0D
    spaces = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    dup = 0
    if "\n" in text:
        seen = set()
        for line in text.split("\n"):
            if line in seen:
                dup += 1
            elif HAS_WORD.search(line):
                seen.add(line)
    return len(words), len(text) - spaces, symbols, dup, repeated_words(words)


def base_features():
    @F.pandas_udf(BASE)
    def features(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([base_of(t) for t in text], columns=[c.split()[0] for c in BASE.split(", ")], dtype="int64")

    return features


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    f, m = d, 1
    while True:
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1.0 + t * d, 1.0 + t / c
            d, c = 1.0 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            f *= d * c
        if abs(d * c - 1.0) < 1e-13:
            return f
        m += 1


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly: the p-value of "the rate exceeds p" when k of n were seen."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return scale * beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - scale * beta_fraction(b, a, 1.0 - x) / b


def base_table(docs: DataFrame, stratum: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, stratum and the base features of every document; a null text has none of anything."""
    d = few_at_once(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
                    base_features()(F.col(text)).alias("b"))
    return d.select("doc_id", "stratum", "b.*")


def cutoffs(base: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05,
            good: str = "quality", doc_id: str = "doc_id") -> DataFrame:
    """Chosen cutoff per stratum and rule: stratum, rule, cutoff, n_good, bad_caught, good_lost.

    All labelled documents that pass the base rules are the holdout; the rules learn nothing else from
    them.  An id labelled twice counts as good if any of its labels is.  A stratum without enough labels
    gets no row, so nothing of it is rejected.  Counts per stratum, rule and cutoff are made by Spark.
    """
    marks = labels.filter(F.col(good).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(good) > 0).alias("good"))
    held = base.filter(~base_failed()).join(marks, "doc_id")
    tests = max(1, held.select("stratum").distinct().count()) * sum(len(g) for _, g in RULES.values())
    grid = [(r, c) for r, (_, g) in RULES.items() for c in g]
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(score).cast("long").alias("score")) for r, (score, _) in RULES.items()])
    counts = held.select("stratum", "good", F.inline(rules)).groupBy("stratum", "rule", "score").agg(
        F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    steps = F.create_map(*[x for r, (_, g) in RULES.items() for x in (F.lit(r), F.array(*[F.lit(c).cast("long") for c in g]))])
    at = counts.withColumn("cutoffs", steps[F.col("rule")])
    # rows at the highest cutoff they reach, plus one row of zeros per cutoff, summed from the top
    at = at.withColumn("cutoff", F.expr("array_max(filter(cutoffs, c -> c <= score))"))
    rows = at.select("stratum", "rule", "cutoff", "g", "b").unionByName(
        at.select("stratum", "rule", F.explode("cutoffs").alias("cutoff")).distinct().selectExpr("stratum", "rule", "cutoff", "0L AS g", "0L AS b"))
    rows = rows.groupBy("stratum", "rule", "cutoff").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    over, whole = W.partitionBy("stratum", "rule").orderBy(F.desc_nulls_last("cutoff")), W.partitionBy("stratum", "rule")
    rows = rows.select("stratum", "rule", "cutoff", F.sum("g").over(whole).alias("n_good"),
                       F.sum("g").over(over).alias("good_lost"), F.sum("b").over(over).alias("bad_caught")).filter("cutoff IS NOT NULL")
    rate, level = alpha / len(RULES), delta / tests
    assert len(grid) >= len(RULES)

    def certified(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            yield x[[n > 0 and binomial_tail(int(k), int(n), rate) <= level for k, n in zip(x["good_lost"], x["n_good"])]]

    best = W.partitionBy("stratum", "rule").orderBy(F.desc("bad_caught"), F.asc("good_lost"), F.desc("cutoff"))
    rows = rows.mapInPandas(certified, rows.schema).filter("bad_caught > 0")
    return rows.withColumn("k", F.row_number().over(best)).filter("k = 1").drop("k")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05, stratum: str = "lang",
          text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Base features, base_failed and kept per document.

    Null or empty texts fail the base rules.  Rows with equal id are judged each on its own text.  Without
    labels every document that passes the base rules is kept.  Other columns are not read.
    """
    base = stored(base_table(docs, stratum, text, doc_id), "quality-base")
    chosen = stored(cutoffs(base, labels, alpha, delta), "quality-cutoffs")
    limits = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    d = base.join(limits, "stratum", "left").withColumn("base_failed", base_failed())
    hit = F.lit(False)
    for rule, (score, _) in RULES.items():
        hit = hit | F.coalesce(F.expr(score) >= F.col("limits")[rule], F.lit(False))
    kept = F.when(F.col("base_failed"), False).otherwise(~hit)
    return d.withColumn("kept", kept).select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept")
