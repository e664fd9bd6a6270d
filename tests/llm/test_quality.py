import math
import re
from collections import Counter

from geonet.llm import quality


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def check(got, rows):
    want = Counter((r["doc_id"], *base(r["text"])) for r in rows)
    assert Counter(tuple(r)[:1] + tuple(r)[2:7] for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_documents(spark, documents, doc_rows):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    check(quality.judge(documents, labels).collect(), doc_rows)


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (99, 1, 0), (None, 1, 1), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    check(quality.judge(awkward, labels).collect(), [r.asDict() for r in awkward.collect()])
    assert quality.judge(nothing, labels).count() == 0
    kept = quality.judge(awkward, labels.limit(0)).filter("NOT base_failed AND NOT kept").count()
    assert kept == 0


def test_binomial_tail():
    for n, p in ((1, 0.3), (20, 0.01), (400, 0.05), (3000, 0.01)):
        for k in (0, 1, 5, n // 50, n // 2, n):
            want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
                             for i in range(min(k, n) + 1))
            assert abs(quality.binomial_tail(k, n, p) - min(want, 1.0)) < 1e-9 + 1e-8 * want


def test_cutoffs_are_certified_and_bounded(spark):
    """Plain good documents and symbol-laden bad ones: the rule fires, and never beyond its bound."""
    rows = [(i, "good plain words in a row that say a few things here" + (" #" if i % 400 == 0 else ""), "en", "a") for i in range(2000)]
    rows += [(i, "# $ % & | junk # $ % & words < > of no use ## $$", "en", "a") for i in range(2000, 2200)]
    rows += [(i, "# $ % & | junk # $ % & words < > of no use ## $$", "xx", "a") for i in range(2200, 2210)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i in range(2210)], "doc_id bigint, quality int, toxic int")
    by = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert sum(not by[i] for i in range(2000)) / 2000 <= 0.05
    assert not any(by[i] for i in range(2000, 2200))
    assert all(by[i] for i in range(2200, 2210)), "a stratum without good labels certifies nothing"


def test_repeats_survive_a_hash_collision(monkeypatch):
    import numpy as np

    words = [b"%d" % (i % 37) for i in range(200)]
    want = quality.repeated_words(words)
    monkeypatch.setattr(quality, "MIXERS", np.zeros(5, dtype=np.uint64))
    assert quality.repeated_words(words) == want
