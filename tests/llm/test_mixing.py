from collections import defaultdict

from geonet.llm import mixing
from geonet.llm.common import WORD_RE


def size(text):
    return len(WORD_RE.findall(text or ""))


def water(sizes, share=1.5, weights=(5, 2, 1)):
    """Targets by the rounds of the definition: deal, stop at twice the size, deal the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 1e-9:
        unit, left = left / sum(w[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += unit * w[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
        largest[r["source"]] = max(largest[r["source"]], size(r["text"]))
    aims = water(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - aims[r["source"]]) < 1e-6 * (1 + r["target"])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    return taken, aims, largest


def test_targets_and_taken(documents, doc_rows):
    taken, aims, largest = check(doc_rows, documents)
    for s in aims:
        assert abs(taken[s] - aims[s]) <= largest[s] / 2 + 1e-6


def test_reruns_agree(documents):
    assert sorted(map(tuple, mixing.mix(documents).collect())) == sorted(map(tuple, mixing.mix(documents.repartition(7)).collect()))


def test_awkward_rows(awkward):
    rows = [r.asDict() for r in awkward.collect()]
    taken, aims, largest = check(rows, awkward)
    for s in aims:
        assert abs(taken[s] - aims[s]) <= 2 * largest[s]


def test_rows_are_repeated_whole(awkward, nothing):
    copies = {}
    for r in mixing.mix(awkward).collect():
        copies[(r["doc_id"], r["size"])] = r["copies"]
    out = mixing.mixed_rows(awkward)
    assert out.columns == awkward.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[(r["doc_id"], size(r["text"]))] += 1
    for (i, s), n in copies.items():
        assert seen[(i, s)] == n * sum(1 for r in awkward.collect() if (r["doc_id"], size(r["text"])) == (i, s))
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0
