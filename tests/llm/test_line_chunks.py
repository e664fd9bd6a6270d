import random

import pytest

from geonet.llm import line_chunks


def pieces(lines):
    """Line numbers of every two neighbouring lines with a word, blank lines between them included.

    Where the same two stand at the next line again, that is in a run of one line, only every second pair counts, and the
    last three lines as one piece.
    """
    worded = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\f\r")]
    pairs = [tuple(range(a, b + 1)) for a, b in zip(worded, worded[1:])]
    text = lambda p: [lines[i] for i in p]
    out, k = [], 0
    while k < len(pairs):
        stop = k + 1
        while stop < len(pairs) and text(pairs[stop]) == text(pairs[k]):
            stop += 1
        out += pairs[k:stop:2]
        if stop - k > 1:
            out.append(tuple(range(pairs[stop - 2][0], pairs[stop - 1][-1] + 1)))
        k = stop
    return out


def brute(rows):
    """Kept text per (doc_id, text): every piece goes that stood before, by doc_id and line; rows: (doc_id, text)."""
    seen, gone = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = t.split("\n") if t else []
        for p in pieces(lines):
            seen.setdefault("\n".join(lines[k] for k in p), []).append((i, t, p))
    for at in seen.values():
        first = min(at, key=lambda x: (x[0] is not None, x[0] or 0, x[2][0]))
        for x in at:
            if x != first:
                gone.setdefault(x[:2], set()).update(x[2])
    out = []
    for i, t in rows:
        lines = t.split("\n") if t else []
        g = gone.get((i, t), set())
        out.append((i, len(lines), len(g), t if not t else "\n".join(x for k, x in enumerate(lines) if k not in g)))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, line_chunks.report(docs).collect()), key=repr)


@pytest.mark.parametrize("seed, divisor", [(1, 4), (2, 4), (3, 1), (4, 10**9)])
def test_shared_passages(spark, monkeypatch, seed, divisor):
    """With usual boundaries, with all lines as boundaries and with none."""
    monkeypatch.setattr(line_chunks, "DIVISOR", divisor)
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(rng.randint(0, 4)))
    passages = [[line() for _ in range(rng.randint(3, 14))] for _ in range(5)]
    rows = []
    for i in range(80):
        text = [x for _ in range(rng.randint(0, 4)) for x in rng.choice([[line()], rng.choice(passages)])]
        rows.append((i, "\n".join(text)))
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == brute(rows) and sum(r[2] for r in got) > 50


def test_cuts_resist_shifts():
    rng = random.Random(3)
    passage = [f"line {rng.random()}" for _ in range(60)]
    chunks = lambda x: {"\n".join(x[a:a + n]) for level, a, n, _ in line_chunks.cut(x) if level}
    one, two = chunks(passage), chunks(["new start", "and more", "x", *passage])
    assert len(one) >= 6 and len(one & two) >= len(one) - 1 and len(one) <= 30


def test_pieces_lie_in_their_chunk():
    rng = random.Random(6)
    for _ in range(300):
        lines = [rng.choice(["a", "b", "c c", "", " ", "d"]) for _ in range(rng.randint(0, 40))]
        found = line_chunks.cut(lines)
        chunks = {a: n for level, a, n, _ in found if level}
        for level, a, n, part in found:
            assert level or part == line_chunks.NOWHERE or part <= a and a + n <= part + chunks[part]
        assert sorted((a, n) for level, a, n, _ in found if not level) == sorted((p[0], len(p)) for p in pieces(lines))


def test_documents(documents, doc_rows):
    rows = [(r["doc_id"], r["text"]) for r in doc_rows]
    got = found(documents)
    assert got == brute(rows) and any(r[2] for r in got)


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    out = line_chunks.replaced(awkward)
    assert out.columns == awkward.columns and out.count() == len(rows)
    assert line_chunks.report(nothing).count() == 0


def test_equal_hashes_of_different_chunks_stay(spark, monkeypatch):
    """All chunks share one hash: equal bytes decide, and different bytes are left alone."""

    class Same:
        xxh64_intdigest = staticmethod(line_chunks.xxhash.xxh64_intdigest)
        xxh3_128_digest = staticmethod(lambda b: b"\0" * 16)

    monkeypatch.setattr(line_chunks, "xxhash", Same)
    rows = [(1, "a b\nc d\ne"), (2, "a b\nc d\ne"), (3, "f g\nh i\nj")]
    assert all(r[2] == 0 for r in found(spark.createDataFrame(rows, "doc_id bigint, text string")))
    rows = rows[:2]
    assert sum(r[2] for r in found(spark.createDataFrame(rows, "doc_id bigint, text string"))) >= 2
