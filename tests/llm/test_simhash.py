import random

import pytest
import xxhash

from geonet.llm import simhash
from geonet.llm.common import WORD_RE


def print_of(text, n_words=4, k=0):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD_RE.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n_words]) for i in range(max(1, len(words) - n_words + 1))]
    hs = [remix(xxhash.xxh64_intdigest(s.encode("utf-8"), 42), k) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints):
    """Smallest id reachable per row by links of at most 4 bits; prints: (id, fingerprint)."""
    values = sorted({p for _, p in prints})
    root = {p: p for p in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        r = find(p)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, p, least[find(p)]) for i, p in prints]


def same(got, rows):
    want = [(i, format(p, "016x"), c) for i, p, c in components([(r["doc_id"], print_of(r["text"])) for r in rows])]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got)


def test_documents(documents, doc_rows):
    same(simhash.near_duplicates(documents).collect(), doc_rows)


def test_awkward_rows(awkward, nothing):
    same(simhash.near_duplicates(awkward).collect(), [r.asDict() for r in awkward.collect()])
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("flips", [1, 3, 6])
def test_no_link_is_lost(spark, flips):
    """Random balls of fingerprints, and chains between them."""
    rng = random.Random(flips)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            y = x
            for b in rng.sample(range(64), rng.randint(0, flips)):
                y ^= 1 << b
            prints.add(y)
            x = y if rng.random() < 0.3 else x
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = {r["fp"]: r["component"] for r in simhash.classes(spark.createDataFrame(rows, "fp long")).collect()}
    want = {}
    for p, _, c in [(p, p, c) for p, _, c in components([(p, p) for p in prints])]:
        want.setdefault(c, set()).add(p)
    mine = {}
    for fp, c in got.items():
        mine.setdefault(c, set()).add(fp % (1 << 64))
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def remix(h, k):
    """The k-th permutation of a shingle hash, in whole numbers."""
    if k:
        m = (1 << 64) - 1
        h ^= 0x9E3779B97F4A7C15 * k & m
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & m
        h = (h ^ h >> 27) * 0x94D049BB133111EB & m
        h ^= h >> 31
    return h


def heads_by(rows, words, prints):
    """Smallest id of every group that links within four bits of any of the fingerprints join; rows: (id, text)."""
    group = {i: i for i, _ in rows}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for k in range(prints):
        for i, _, c in components([(i, print_of(t, words, k)) for i, t in rows]):
            a, b = sorted((find(i), find(c)))
            group[b] = a
    return sorted({find(i) for i, _ in rows})


@pytest.mark.parametrize("prints", [1, 3])
def test_representatives(awkward, nothing, documents, doc_rows, prints):
    kept = simhash.representatives(documents, prints=prints)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == heads_by([(r["doc_id"], r["text"]) for r in doc_rows], 5, prints)
    out = simhash.representatives(awkward, prints=prints)
    assert out.columns == awkward.columns and sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 2, 5, 7, 8]
    assert simhash.representatives(nothing, prints=prints).count() == 0


def test_neighbours_of_few_fingerprints_are_not_broadcast(spark):
    """A fingerprint has 69 neighbours, of which Spark's estimate of the table's size knows nothing."""
    import contextlib
    import io

    rows = [(0, 0, 1), (0, 0b1111, 2), (1, 0, 3), (1, 0b111, 4)]
    for first, want in ((spark.createDataFrame([r[1:] for r in rows[:2]], "fp bigint, c bigint"), {(1, 2)}),
                        (spark.createDataFrame(rows, "k int, fp bigint, c bigint"), {(1, 2), (3, 4)})):
        links, out = simhash.class_links(first), io.StringIO()
        with contextlib.redirect_stdout(out):
            links.explain()
        assert "Broadcast" not in out.getvalue()
        assert {(r.ca, r.cb) for r in links.collect()} == want
