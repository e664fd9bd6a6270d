"""Exact top-k search by inner product over a bit-sliced index.

A vector component becomes the whole number floor(256 * x).  The index holds the vectors in blocks; per
block and dimension the leading bits of the (shifted, non-negative) values are kept as slices, one bitmap
over the rows of the block per bit.  A query adds the slices of all dimensions, weighted by its own bits,
with bitmap full adders; the sum is again a set of slices.  The k-th largest sum is found from the most
significant slice downward; every row whose sum could still reach the top k, given the bits left out of
the slices, is a boundary row and is resolved with its exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from geonet.llm.common import stored

BLOCK_ROWS = 16_384
QUERY_ROWS = 1_024
SLICE_BITS = 5


def whole(vector) -> np.ndarray:
    """floor(256 * x) per component."""
    y = np.floor(np.asarray(vector, dtype=np.float64) * 256.0)
    if len(y) and np.abs(y).max() >= 2.0 ** 62:
        raise OverflowError("a component is too large for whole-number scores")
    return y.astype(np.int64)


def packed(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Blocks of up to ``rows`` vectors: ids and values as bytes, short vectors filled up with zeros.

    ``grp`` is the number of the partition, which an even deal makes a block or little more.
    """
    part = TaskContext.get().partitionId()
    ids: list[int] = []
    values: list[np.ndarray] = []

    def flush():
        width = max(map(len, values))
        grid = np.zeros((len(ids), width), dtype=np.int64)
        for r, v in enumerate(values):
            grid[r, :len(v)] = v
        small = next(t for t in (np.int16, np.int32, np.int64) if not grid.size or (np.iinfo(t).min <= grid.min() and grid.max() <= np.iinfo(t).max))
        out = pd.DataFrame({"grp": [part], "ids": [np.array(ids, dtype=np.int64).tobytes()], "n": [len(ids)], "width": [width],
                            "bytes": [small().itemsize], "grid": [grid.astype(small).tobytes()]})
        ids.clear(), values.clear()
        return out

    for frame in frames:
        for i, v in zip(frame["vec_id"], frame["vector"]):
            ids.append(int(i))
            values.append(whole(v))
            if len(ids) == rows:
                yield flush()
    if ids:
        yield flush()


PACKED = "grp int, ids binary, n int, width int, bytes int, grid binary"


def unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["bytes"]]
    return np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["grid"], dtype=kind).reshape(row["n"], row["width"]).astype(np.int64)


class Slices:
    """Bit slices of one block: ``bit[j][b]`` is the bitmap of bit b of dimension j."""

    def __init__(self, ids: np.ndarray, grid: np.ndarray, bits: int = SLICE_BITS):
        self.ids, self.grid, self.n = ids, grid, len(ids)
        self.words = (self.n + 63) // 64
        self.low = grid.min(axis=0) if self.n else np.zeros(grid.shape[1], dtype=np.int64)
        shifted = (grid - self.low).astype(np.uint64)
        width = int(shifted.max()).bit_length() if shifted.size else 0
        self.drop = max(0, width - bits)
        self.top = max(1, width - self.drop)
        coarse = shifted >> np.uint64(self.drop)
        self.bit = [[self.bitmap((coarse[:, j] >> np.uint64(b)) & np.uint64(1)) for b in range(self.top)] for j in range(grid.shape[1])]
        self.all = self.bitmap(np.ones(self.n, dtype=np.uint64))
        self.none = np.zeros(self.words, dtype=np.uint64)
        self.inverse = [[~s for s in d] for d in self.bit]

    def bitmap(self, flags: np.ndarray) -> np.ndarray:
        raw = np.packbits(flags.astype(np.uint8), bitorder="little")
        return np.frombuffer(raw.tobytes().ljust(self.words * 8, b"\0"), dtype=np.uint64)

    def rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little", count=self.n))

    def total(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of sum_j |q_j| * u_j, lowest first; u_j are the kept bits of dimension j, mirrored where q_j < 0.

        The bitmaps of equal place value wait in one column; three of them become one in the same column
        and one in the next (a full adder), two a half adder, until every column holds one.
        """
        columns: list[list[np.ndarray]] = [[]]
        for j, q in enumerate(query.tolist()):
            own, q, k = (self.bit if q >= 0 else self.inverse)[j], abs(q), 0
            while q:
                if q & 1:
                    while len(columns) < k + self.top:
                        columns.append([])
                    for b, s in enumerate(own):
                        columns[k + b].append(s)
                q >>= 1
                k += 1
        out, place = [], 0
        while place < len(columns):
            col = columns[place]
            if len(col) > 1 and place + 1 == len(columns):
                columns.append([])
            while len(col) > 2:
                a, b, c = col.pop(), col.pop(), col.pop()
                half = a ^ b
                columns[place + 1].append((a & b) | (half & c))
                col.insert(0, half ^ c)
            if len(col) == 2:
                a, b = col
                columns[place + 1].append(a & b)
                col = [a ^ b]
            out.append(col[0] if col else self.none)
            place += 1
        return out

    def candidates(self, query: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """Rows (but ``own``) that may be among the k with the largest inner product."""
        alive = self.all
        if len(own):
            alive = alive.copy()
            np.bitwise_and.at(alive, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
        if self.n - len(own) <= k:
            return self.rows(alive)
        total = self.total(query)
        sure, open_, value = self.none, alive, 0
        for place in range(len(total) - 1, -1, -1):  # the k-th largest sum, from the top slice down
            high = open_ & total[place]
            if int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(high).sum()) >= k:
                open_, value = high, value | 1 << place
            else:
                sure, open_ = sure | high, open_ & ~total[place]
        # a dropped remainder adds at most (2^drop - 1) * sum|q| to 2^drop * sum
        slack = ((1 << self.drop) - 1) * int(np.abs(query).sum())
        least = max(0, value - (slack + (1 << self.drop) - 1 >> self.drop))
        over, equal = self.none, alive
        for place in range(len(total) - 1, -1, -1):  # rows with a sum of at least ``least``
            if least >> place & 1:
                equal = equal & total[place]
            else:
                over, equal = over | (equal & total[place]), equal & ~total[place]
        return self.rows(over | equal)

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query_id, vec_id, score) of the k best rows of the block, ties to the smaller id."""
        width = min(len(query), self.grid.shape[1])
        query = query[:width]
        at = self.candidates(query, np.flatnonzero(self.ids == query_id), k)
        grid = self.grid[at, :width]
        wide = width and int(np.abs(query).max()) * (int(np.abs(grid).max()) if grid.size else 0) * width >= 2 ** 63
        scores = grid.astype(object) @ query.astype(object) if wide else grid @ query
        if wide and len(scores) and max(abs(s) for s in scores) >= 2 ** 63:
            raise OverflowError("a score does not fit a long")
        order = sorted(zip((-s for s in scores.tolist()), self.ids[at].tolist()))[:k]
        return [(query_id, i, -s) for s, i in order]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of largest whole-number inner product per query.

    A query never finds rows of its own id; an id asked twice is asked once, with the lesser of its vectors.
    Ties go to the smaller id; repeated rows count each.  Null ids, null
    vectors and vectors with null or non-finite components take no part, shorter vectors count as filled up
    with zeros, scores beyond a long raise.  Other columns are not read; empty input gives no rows.

    A group of rows meets a group of queries as one cogroup of fixed size, whatever the size of the table, and
    only the k best rows per query and group go on.
    """
    sound = "vec_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).filter(sound)
    asked = queries.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).filter(sound)
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n_rows, n_asked = rows.count(), asked.count()
    row_groups, query_groups = max(1, -(-n_rows // block_rows)), max(1, -(-n_asked // query_rows))
    index = stored(rows.repartition(row_groups).mapInPandas(lambda it: packed(it, block_rows), PACKED), "bit-slices")
    blocks = stored(asked.repartition(query_groups).mapInPandas(lambda it: packed(it, query_rows), PACKED), "query-blocks")
    left = index.withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))))
    right = blocks.withColumnRenamed("grp", "qg").withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(row_groups - 1))))

    def answer(some: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, r in some.iterrows():
            slices = Slices(*unpacked(r))
            for _, q in those.iterrows():
                ids, grid = unpacked(q)
                for i, v in zip(ids.tolist(), grid):
                    found += slices.best(i, v, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = left.groupBy("grp", "qg").cogroup(right.groupBy("grp", "qg")).applyInPandas(answer, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
