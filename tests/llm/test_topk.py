import numpy as np
import pytest

from geonet.llm import topk


def brute(rows, k):
    good = [(i, np.floor(np.asarray(v, dtype=np.float64) * 256).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % 50 == 0:
            w = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), i) for i, y in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(w)]
    return sorted(out)


def found(spark, rows, **options):
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'x' AS score", "1 AS rank", "2 AS grp")
    return sorted(map(tuple, topk.search(d, d.filter("vec_id % 50 = 0"), **options).collect()))


def f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("block, bits", [(7, 1), (64, 3), (1000, 5)])
def test_matches_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(topk.Slices.__init__, "__defaults__", (bits,))
    rng = np.random.default_rng(3)
    rows = [(i, f32(rng.normal(size=9) * 10.0 ** rng.integers(-3, 3))) for i in range(210)]
    assert found(spark, rows, k=5, block_rows=block, query_rows=2) == brute(rows, 5)


def test_ties_nulls_and_uneven_vectors(spark):
    rows = [(i, [0.5, -0.25]) for i in range(120)]
    rows += [(200, None), (250, [1.0, None]), (300, [1.0, float("nan")]), (350, [float("inf"), 1.0]), (None, [1.0, 1.0]), (400, []), (450, [1.0])]
    rows += [(0, [0.5, -0.25]), (500, [-3.0, 2.0, 9.0])]
    got = found(spark, rows, k=5, block_rows=16)
    assert {r[0] for r in got} == {0, 50, 100, 400, 450, 500}
    assert [r[2] for r in got if r[0] == 100] == [450, 0, 0, 1, 2]
    assert [r[2] for r in got if r[0] == 0] == [450, 1, 2, 3, 4]
    assert all(r[2] != r[0] for r in got)


def test_fewer_rows_than_asked_and_none(spark):
    assert found(spark, [(50, [1.0]), (3, [2.0])], k=5) == [(50, 1, 3, 256 * 512)]
    assert found(spark, [], k=5) == []
