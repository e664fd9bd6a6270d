"""Short passages in different surroundings: every repeated run of lines goes, but its first occurrence."""

import random

import pytest

from geonet.llm import line_chunks
from test_line_chunks import brute


@pytest.mark.parametrize("length", [2, 3, 4, 6, 8, 12])
def test_planted_passages(spark, length):
    rng = random.Random(length)
    lines = lambda n: [f"{rng.random()} {rng.random()}" for _ in range(n)]
    rows, want = [], []
    for p in range(30):
        passage = lines(length)
        passage.insert(1, "")
        for k in range(3):
            before, after = lines(rng.randint(0, 6)), lines(rng.randint(0, 6))
            rows.append((3 * p + k, "\n".join(before + passage + after)))
            want.append((3 * p + k, "\n".join(before + (passage if k == 0 else []) + after)))
    got = line_chunks.report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r["doc_id"], r["kept"]) for r in got.collect()) == want


def test_repeated_runs(documents, doc_rows):
    """No pair of neighbouring worded lines is left that stood earlier, and the first of every line is left."""
    kept = {r["doc_id"]: r["kept"] for r in line_chunks.report(documents).collect()}
    worded = lambda t: [x for x in (t or "").split("\n") if line_chunks.HAS_WORD.search(x)]
    seen, before = set(), set()
    for r in sorted(doc_rows, key=lambda r: r["doc_id"]):
        here = worded(r["text"])
        pairs = set(zip(here, here[1:]))
        rest = worded(kept[r["doc_id"]])
        assert not (set(zip(rest, rest[1:])) & pairs & seen)
        assert set(here) - before <= set(rest)
        seen |= pairs
        before |= set(here)


@pytest.mark.parametrize("first", range(2, 8))
@pytest.mark.parametrize("second", range(2, 8))
def test_equal_lines(first, second):
    """A line that repeats itself keeps its first pair, and goes wherever it stands again."""
    texts = ["\n".join(["x"] + ["a b"] * first + ["y"]), "\n".join(["z"] + ["a b"] * second + ["u"])]
    kept = {i: t.split("\n") for i, _, _, t in brute(list(enumerate(texts)))}
    assert kept[0].count("a b") == 2 + first % 2
    assert kept[1].count("a b") == (second % 2 if first == 2 else 0)
