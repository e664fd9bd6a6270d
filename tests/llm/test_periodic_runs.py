import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from geonet.llm import periodic_runs
from geonet.llm.queries import op11_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """Runs by walking the equal pairs at every period; a period that a smaller one explains is left out."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q):
                part = words[i:i + size]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *tail, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_sequences(least):
    rng = random.Random(least)
    for _ in range(1500):
        n, kinds = rng.randint(0, 80), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        got = periodic_runs.runs_of(np.array(words, dtype=np.uint64), least)
        assert [tuple(r) for r in got.tolist()] == brute_runs(words, least)


def test_every_stretch_alone_is_the_whole():
    """Stretches found by grams change nothing against a tree over all words."""
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.randrange(40) for _ in range(rng.randint(30, 90))]
        for _ in range(3):
            at, q = rng.randrange(len(words)), rng.randint(1, 9)
            words[at:at] = [rng.randrange(40) for _ in range(q)] * rng.randint(2, 14)
        got = periodic_runs.runs_of(np.array(words, dtype=np.uint64))
        assert [tuple(r) for r in got.tolist()] == brute_runs(words)


def test_common_extensions():
    rng = random.Random(9)
    words = [rng.randint(1, 2) for _ in range(700)] * 2
    tree = periodic_runs.SuffixTree(words)
    a = np.array([rng.randrange(1400) for _ in range(3000)])
    b = np.array([rng.randrange(1400) for _ in range(3000)])
    a, b = a[a != b], b[a != b]
    for x, y, k in zip(a.tolist(), b.tolist(), tree.common(a, b).tolist()):
        assert words[x:x + k] == words[y:y + k] and words[x + k:x + k + 1] != words[y + k:y + k + 1] or max(x, y) + k == 1400


def test_query_equals_brute_force(spark, doc_rows):
    got = sorted(tuple(r) for r in op11_periodic_runs(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(brute(r["doc_id"], r["text"]) for r in doc_rows)


def test_awkward(spark, awkward, nothing):
    assert periodic_runs.digests(nothing).collect() == []
    got = sorted((tuple(r) for r in periodic_runs.digests(awkward).collect()), key=repr)
    assert got == sorted((brute(r["doc_id"], r["text"]) for r in awkward.collect()), key=repr)
    out = periodic_runs.periodic_runs(awkward.withColumnRenamed("score", "RUNS"))
    assert out.columns == [c for c in awkward.columns if c != "score"] + ["runs", "collapsed"]
    assert {r["collapsed"] for r in out.filter("text IS NULL OR trim(text) = ''").collect()} == {""}


def test_long_documents():
    """A document that is one stretch: a single word, and a passage that stands five times."""
    rng = random.Random(1)
    start = time.time()
    assert periodic_runs.runs_of(np.zeros(100_000, dtype=np.uint64)).tolist() == [[0, 100_000, 1]]
    words = np.array([rng.randrange(5000) for _ in range(20_000)] * 5, dtype=np.uint64)
    assert [0, 100_000, 20_000] in periodic_runs.runs_of(words).tolist()
    assert time.time() - start < 60
