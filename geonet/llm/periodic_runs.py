"""Runs: maximal stretches of words that repeat with a period, found in suffix trees.

Every run has a root that is a Lyndon word, for the order of the words or for the reversed one, and the longest
Lyndon word at a place ends where the next smaller suffix begins.  So each place and order gives one candidate
(place, period).  It is extended to the right by the longest common extension of two suffixes and to the left by
that of two reversed prefixes; both are depths of lowest common ancestors in Ukkonen's suffix trees of the words and of
their reversal, read off as minima of the Euler tours in constant time each.

A run of at least m words repeats, at its period, a stretch of at least m / 2 words, so each of its words lies in a gram of
that many words that occurs twice in the document.  Trees are built over the maximal stretches of such words
only; a stretch holds a run as a whole or not at all.  Nothing is cut to a length: a document that is one
stretch is one tree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from geonet.llm.common import few_at_once, free_name

#: Words in a run, at least, beside two periods.
MIN_WORDS = 12
#: Steps of an Euler tour that share one entry of the table of minima.
BLOCK = 32
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def repeated_stretches(ids: np.ndarray, gram: int, least: int) -> list[tuple[int, int]]:
    """[from, to) of the maximal stretches, of at least ``least`` words, whose words all lie in grams that occur twice.

    Grams are compared by hash; two that share one by chance only make a stretch longer.
    """
    n = len(ids) - gram + 1
    if len(ids) < least or n < 2:
        return []
    h = np.zeros(n, dtype=np.uint64)
    for k in range(gram):
        h = (h ^ ids[k:k + n]) * FACTOR
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + gram, -1)
    inside = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]))
    edge = np.diff(inside)
    return [(a, b) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()) if b - a >= least]


class SuffixTree:
    """Ukkonen's suffix tree of symbols 1..top followed by an end mark 0, with its Euler tour."""

    def __init__(self, symbols: list[int]):
        self.size = len(symbols) + 1
        self._build([*symbols, 0])
        self._tour()

    def _build(self, s: list[int]) -> None:
        n, width = len(s), max(s) + 1
        start, stop, link, child = [0], [0], [0], {}
        leaf_of = []
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            inner = 0  # node made in this phase that has no suffix link yet
            while waiting:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    leaf_of.append(len(start))
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if inner:
                        link[inner] = node
                        inner = 0
                else:
                    begin, span = start[below], min(stop[below], i + 1) - start[below]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if s[begin + length] == c:
                        if inner:
                            link[inner] = node
                        length += 1
                        break
                    split = len(start)
                    child[key] = split
                    start.append(begin)
                    stop.append(begin + length)
                    link.append(0)
                    start[below] = begin + length
                    child[split * width + s[begin + length]] = below
                    child[split * width + c] = len(start)
                    leaf_of.append(len(start))
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if inner:
                        link[inner] = split
                    inner = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        count = len(start)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        below = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        order = np.argsort(keys)
        parents = keys[order] // width
        self.below = below[order].tolist()  # children of node 0, 1, ... by their first symbol
        self.first = np.searchsorted(parents, np.arange(count + 1)).tolist()
        self.mark = (keys[order] % width == 0).tolist()
        self.length = (np.array(stop) - np.array(start)).tolist()
        self.suffix = [-1] * count
        for place, leaf in enumerate(leaf_of):  # leaves come in the order of their suffixes
            self.suffix[leaf] = place

    def _tour(self) -> None:
        """Depths, in symbols, along the Euler tour, and each suffix's place in it; minima by blocks."""
        below, first, length, suffix = self.below, self.first, self.length, self.suffix
        depth, at = [0], list(first)
        place = [0] * self.size
        path, depths = [0], [0]
        while path:
            node = path[-1]
            k = at[node]
            if k < first[node + 1]:
                at[node] = k + 1
                node = below[k]
                path.append(node)
                depths.append(depths[-1] + length[node])
                if suffix[node] >= 0:
                    place[suffix[node]] = len(depth)
                depth.append(depths[-1])
            else:
                path.pop()
                depths.pop()
                if path:
                    depth.append(depths[-1])
        self.place = np.array(place)
        blocks = -(-len(depth) // BLOCK)
        grid = np.full((blocks, BLOCK), np.iinfo(np.int32).max, dtype=np.int32)
        grid.ravel()[:len(depth)] = depth
        self.depth = grid.ravel()
        self.ahead = np.minimum.accumulate(grid, axis=1).ravel()
        self.back = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [grid.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, which differ."""
        x, y = self.place[a], self.place[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        bl, bh = low // BLOCK, high // BLOCK
        out = np.minimum(self.back[low], self.ahead[high])
        near = np.flatnonzero(bl == bh)
        if len(near):
            least = self.depth[low[near]]
            for k in range(1, BLOCK):
                least = np.minimum(least, self.depth[np.minimum(low[near] + k, high[near])])
            out[near] = least
        far = np.flatnonzero(bh - bl > 1)
        if len(far):
            lo, n = bl[far] + 1, bh[far] - bl[far] - 1
            level = np.frexp(n.astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                some = np.flatnonzero(level == k)
                t, f = self.table[k], far[some]
                out[f] = np.minimum(out[f], np.minimum(t[lo[some]], t[lo[some] + n[some] - (1 << k)]))
        return out.astype(np.int64)

    def ranks(self, falling: bool) -> list[int]:
        """Rank of every suffix in the order of the symbols, or in the reversed one; the end comes first in both."""
        below, first, suffix, mark = self.below, self.first, self.suffix, self.mark
        rank, at, stack = [0] * self.size, 0, [0]
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                rank[suffix[node]] = at
                at += 1
                continue
            lo, hi = first[node], first[node + 1]
            if not falling:
                stack.extend(below[lo:hi][::-1])
            elif mark[lo]:
                stack.extend(below[lo + 1:hi])
                stack.append(below[lo])
            else:
                stack.extend(below[lo:hi])
        return rank


def lyndon_periods(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at every place, for the order that the ranks are of."""
    n = len(rank) - 1
    after = list(range(1, n + 2))
    for i in range(n - 1, -1, -1):
        j, own = i + 1, rank[i]
        while rank[j] > own:
            j = after[j]
        after[i] = j
    return np.array(after[:n]) - np.arange(n)


def runs_of(ids: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers, by start, then period."""
    out = []
    for begin, end in repeated_stretches(ids, -(-least // 2), least):
        symbols = (np.unique(ids[begin:end], return_inverse=True)[1] + 1).tolist()
        n = end - begin
        tree = SuffixTree(symbols)
        periods = [lyndon_periods(tree.ranks(falling)) for falling in (False, True)]
        i = np.tile(np.arange(n), 2)
        p = np.concatenate(periods)
        some = 2 * p <= n
        i, p = i[some], p[some]
        ahead = tree.common(i, i + p)
        del tree
        back = SuffixTree(symbols[::-1]).common(n - i, n - i - p)
        length = back + p + ahead
        some = length >= np.maximum(2 * p, least)
        out.append(np.stack((begin + i - back, length, p), axis=1)[some])
    if not out:
        return np.empty((0, 3), dtype=np.int64)
    rows = np.unique(np.concatenate(out), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8; bytes are split at \\x20 and \\x09-\\x0D only."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=len(words))


def run_columns(least: int):
    """Pandas function text -> its runs and the text without the repetitions."""

    @F.pandas_udf("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def of(text: pd.Series) -> pd.DataFrame:
        runs, collapsed = [], []
        for t in text:
            words = words_of(t)
            found = runs_of(numbered(words), least) if len(words) >= least else ()
            if len(found):
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, found[:, 0] + found[:, 2], 1)
                np.add.at(change, found[:, 0] + found[:, 1], -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()] if len(found) else [])
            collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"runs": runs, "collapsed": collapsed})

    return of


def periodic_runs(docs: DataFrame, text: str | Column = "text", least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) in words, and ``collapsed``: the text without repetitions.

    Words are stretches without ASCII white space.  A run has at least ``least`` words and two periods, its period is
    the smallest one, and no neighbouring word extends it.  Of a run the first period stays, as far as no other run
    drops it; the words that stay are joined by one space.  Null and empty texts have no run and collapse to
    an empty text.  Repeated rows are treated alike, each by itself; if ``docs`` has columns of these names, they are replaced.
    """
    found = free_name(docs, "_runs")
    col = F.col(text) if isinstance(text, str) else text
    d = few_at_once(docs).withColumn(found, run_columns(least)(col))
    keep = [F.col(c) for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    return d.select(*keep, F.col(f"{found}.runs").alias("runs"), F.col(f"{found}.collapsed").alias("collapsed"))


@F.pandas_udf(T.StringType())
def made_periodic(text: pd.Series, crc: pd.Series) -> pd.Series:
    """Texts whose words from some place on are made to repeat: a tenth of the documents, by the crc32 of their id.

    A test pattern for the operator; a null id has no crc32 and leaves its text as it is.
    """
    out = []
    for t, h in zip(text, crc):
        if t and h == h and h is not None and int(h) % 10 == 0:
            words, g = words_of(t), int(h) // 10
            n = len(words)
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words[a:] = [words[a + k % p] for k in range(n - a)]
                t = b" ".join(words).decode("utf-8", "surrogatepass")
        out.append(t)
    return pd.Series(out, dtype=object)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; nulls without one) and SHA-256 of both results."""
    crc = F.crc32(F.col(doc_id).cast("string"))
    d = docs.select(F.col(doc_id).alias("doc_id"), made_periodic(F.col(text), crc).alias("text"))
    d = periodic_runs(d).withColumn("best", F.expr(
        "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS place, -r.period AS period)))"))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.place")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
