import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from geonet.llm import repeats


def brute(rows, window):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) by counting every window."""
    data = [(i, (t or "").encode("utf-8")) for i, t in rows]
    n = Counter(b[k:k + window] for _, b in data for k in range(len(b) - window + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if n[b[k:k + window]] > 1:
                gone[k:k + window] = b"\x01" * window
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **options):
    rows = repeats.remove_repeats(docs, **options).collect()
    for r in rows:
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    return sorted([tuple(r)[:5] for r in rows], key=repr)


def planted(rng, n):
    """Texts over few letters with shared passages at shifted places, near copies, copies and runs."""
    word = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    passages = [word(rng.randint(20, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice([word(rng.randint(0, 30)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 15):]]) for _ in range(rng.randint(0, 6)))
        rows.append((i, t))
    near = list(rows[1][1] + passages[0] + passages[1])
    for i in range(n, n + 12):
        near[rng.randrange(len(near))] = "x"
        rows.append((i, "".join(near)))
    rows += [(n + 20, "a" * 90), (n + 21, "ab" * 50), (n + 22, None), (n + 23, ""), (3, rows[3][1]), (3, rows[3][1]), (None, passages[2] * 2), (None, "é" * 40)]
    return rows


@pytest.fixture
def short(monkeypatch):
    for name, value in (("WINDOW", 24), ("GRAM", 6), ("SPAN", 19)):
        monkeypatch.setattr(repeats, name, value)


@pytest.mark.parametrize("seed, part, sort_rows", [(1, 1 << 20, 24_576), (2, 37, 24_576), (3, 1 << 20, 2), (4, 1 << 20, 0)])
def test_brute_force(spark, short, monkeypatch, seed, part, sort_rows):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "SORT_BYTES", 900)
    rows = planted(random.Random(seed), 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS spans", "1 AS key", "2 AS th", "3 AS i")
    assert found(docs, sort_rows=sort_rows) == brute(rows, 24)


def test_hash_collisions_are_seen(spark, short, monkeypatch):
    """With base 1 the prefix hashes are sums, so that different strings often share one."""
    real = repeats.suffix_order

    def weak(parts, at, group):
        repeats.powers, keep = (lambda n: (np.ones(n, dtype=np.uint64),) * 2), repeats.powers
        try:
            return real(parts, at, group)
        finally:
            repeats.powers = keep

    rng = random.Random(5)
    parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(24, 60))) for _ in range(40)]
    at = np.array([rng.randrange(len(p)) for p in parts])
    group = np.sort(np.array([rng.randrange(4) for _ in parts]))
    order, common = weak(parts, at, group)
    want = repeats.plain_order(parts, at, group)
    assert common.tolist() == want[1].tolist()
    assert [parts[i][at[i]:] for i in order] == [parts[i][at[i]:] for i in want[0]]


def test_suffix_order(spark):
    rng = random.Random(6)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    at = np.array([rng.randrange(len(p) + 1) for p in parts])
    group = np.sort(np.array([rng.choice([0, 0, 0, 1, 2, 3]) for _ in parts]))
    order, common = repeats.suffix_order(parts, at, group)
    want = repeats.plain_order(parts, at, group)
    assert common.tolist() == want[1].tolist() and [parts[i][at[i]:] for i in order] == [parts[i][at[i]:] for i in want[0]]


def test_documents(documents, doc_rows):
    rows = [(r["doc_id"], r["text"]) for r in doc_rows]
    assert found(documents) == brute(rows, repeats.WINDOW)


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward) == brute(rows, repeats.WINDOW)
    assert repeats.remove_repeats(nothing).count() == 0
