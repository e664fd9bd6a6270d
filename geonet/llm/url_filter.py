"""URL filter: allow and block rules, and a logistic regression on hashed character n-grams for the rest.

Everything runs as DataFrame expressions and Spark ML: the n-grams of host and path are array expressions,
hashed into a fixed number of counts, and the regression is fitted on a small labelled URL table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.llm.common import free_name, lower_ascii, stored
from geonet.session import scratch_path

#: Rules of the registered query: (verdict, host/path prefix).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
N_FEATURES = 1 << 14
#: Most labelled rows a fit reads; the rows of least hash are taken.
TRAIN_ROWS = 20_000


def host_of(url: str = "url") -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits.  Rules are code-sized: one CASE branch each."""
    rule = verdict = None
    for say, text in sorted(dict.fromkeys(rules), key=lambda r: (-len(r[1]), r[1], r[0])):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def grams(host: Column, path: Column, sizes: Sequence[int] = (2, 3, 4)) -> Column:
    """Character n-grams of host and path, marked by their part; the ends count as characters."""

    def part(mark: str, col: Column) -> Column:
        text = F.concat(F.lit("^"), col, F.lit("$"))
        return F.concat(*[F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))),
                                      lambda i, n=n: F.concat(F.lit(mark), F.substring(text, i, n))) for n in sizes])

    return F.concat(part("h", host), part("p", path))


def features(urls: DataFrame, host: Column, path: Column, out: str) -> DataFrame:
    words = free_name(urls, "_grams")
    d = urls.withColumn(words, grams(host, path))
    return HashingTF(numFeatures=N_FEATURES, inputCol=words, outputCol=out).transform(d).drop(words)


def fit(labelled: DataFrame, url: str = "url", verdict: str = "verdict", train_rows: int = TRAIN_ROWS) -> LogisticRegressionModel | str:
    """Model for rows (url, verdict): ``allow`` or ``block``; other and null verdicts are left out.

    At most ``train_rows`` distinct URLs are read, those of least hash, in that order and in one partition,
    so that a refit gives the same model.  With one class only, that class is returned as text; without
    any row, ``allow``.
    """
    d = labelled.filter(F.col(verdict).isin("allow", "block")).filter(F.col(url).isNotNull())
    d = d.groupBy(F.col(url).alias("url")).agg(F.min(verdict).alias("verdict"))
    d = d.withColumn("h", F.xxhash64("url")).orderBy("h", "url").limit(train_rows)
    d = stored(d, "url-labelled").coalesce(1).sortWithinPartitions("h", "url")
    classes = [r[0] for r in d.select("verdict").distinct().sort("verdict").collect()]
    if len(classes) < 2:
        return classes[0] if classes else "allow"
    d = features(d, host_of("url"), path_of("url"), "x").selectExpr("x", "CAST(verdict = 'allow' AS DOUBLE) AS y")
    path = scratch_path(d.sparkSession, "url-model")
    LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-4, maxIter=50).fit(d).write().save(path)
    return LogisticRegressionModel.load(path)  # a stored model holds nothing of its training, which tasks cannot receive


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, model: LogisticRegressionModel | str | None = None,
          url: str = "url") -> DataFrame:
    """The rows of ``pages`` with host, path, rule, verdict and score (of ``allow``; null where a rule decides).

    Without ``model`` the labelled table is what the rules decide among the pages.  Null URLs and URLs without
    ``://`` have empty host and path, fit no rule and are judged on these.  Columns of ``pages`` named like
    an output are replaced; repeated rows are judged alike.
    """
    host, path = host_of(url), path_of(url)
    rule, verdict = rule_of(host, path, rules)
    if model is None:
        model = fit(pages.select(F.col(url).alias("url"), verdict.alias("verdict")))
    x, raw, prob, guess = (free_name(pages, n) for n in ("_x", "_raw", "_prob", "_guess"))
    outs = {"host", "path", "rule", "verdict", "score"}
    keep = [c for c in pages.columns if c.lower() not in outs]
    d = pages.select(*keep, host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict"))
    if isinstance(model, str):
        score = F.lit(1.0 if model == "allow" else 0.0)
    else:
        model = model.copy().setFeaturesCol(x).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol(guess)
        d = model.transform(features(d, F.col("host"), F.col("path"), x))
        score = F.round(vector_to_array(F.col(prob))[1], 9)
    score = F.when(F.col("rule").isNull(), score)
    said = F.coalesce(F.col("verdict"), F.when(score >= 0.5, "allow").otherwise("block"))
    return d.select(*keep, "host", "path", "rule", said.alias("verdict"), score.alias("score"))
