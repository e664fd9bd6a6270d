"""Exact removal of long repeated byte strings by a hash-compared suffix sort.

A byte goes if it lies in a string of 400 bytes that also starts anywhere else.  Every window of 400 bytes has an
anchor, the 64-byte gram of least hash in it, so equal windows have equal anchors at equal places; a run of
windows with one anchor is a segment.  Only segments whose anchor gram occurs again can hold repeats, and
segments that are equal, by a cryptographic digest of their bytes, are one, so few segments need a closer look.  Those of one anchor are compared by sorting the
suffixes that start at the anchors, and the reversed prefixes that end there: a mergesort whose comparisons
find the common extension by binary search over prefix polynomial hashes.  Neighbours in the sorted order are
verified byte by byte.  Two windows are equal if they lie in one class of the forward order, at the length that
follows the anchor, and in one class of the backward order, at the length before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from geonet.llm.common import few_at_once, stored

WINDOW, GRAM = 400, 64
SPAN = WINDOW - GRAM + 1
#: Window starts looked at together; a longer text is taken in such parts.
PART = 1 << 20
#: Segments sorted together, and bytes of them; an anchor with more segments is counted window by window.
SORT_ROWS, SORT_BYTES = 24_576, 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(int(BASE), -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(data: bytes) -> tuple[list, list, list, list, list]:
    """Per segment: gram hash, digest of the segment, first window, windows, place of the gram in the segment."""
    out: tuple[list, list, list, list, list] = ([], [], [], [], [])
    last = len(data) - WINDOW + 1
    if last <= 0:
        return out
    up, down = powers(min(len(data), PART + WINDOW) + 1)
    for begin in range(0, last, PART):
        b = np.frombuffer(data, dtype=np.uint8, offset=begin, count=min(PART, last - begin) + WINDOW - 1)
        prefix = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=prefix[1:])
        h = mixed((prefix[GRAM:] - prefix[:-GRAM]) * down[:len(b) - GRAM + 1])
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < SPAN:
            least = np.minimum(least[:len(least) - (SPAN - size)], least[SPAN - size:])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        n = np.diff(np.concatenate((first, [len(at)])))
        out[0].extend(h[at[first]].view(np.int64).tolist())
        starts, counts = (first + begin).tolist(), n.tolist()
        out[1].extend(hashlib.blake2b(data[s:s + c + WINDOW - 1], digest_size=16).digest() for s, c in zip(starts, counts))
        out[2].extend(starts)
        out[3].extend(counts)
        out[4].extend((at[first] - first).tolist())
    return out


def anchor_columns():
    names = ["key", "seg", "start", "n", "off"]

    @F.pandas_udf("key array<long>, seg array<binary>, start array<int>, n array<int>, off array<int>")
    def of(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([anchors(t.encode("utf-8", "surrogatepass") if t else b"") for t in text], columns=names)

    return of


class Bytes:
    """Segments one after the other with prefix hashes; powers count from the start of each segment."""

    def __init__(self, parts: list[bytes]):
        self.text = np.frombuffer(b"".join(parts), dtype=np.uint8)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        up, self.down = powers(int(sizes.max()) + 1)
        local = np.arange(len(self.text)) - np.repeat(self.begin, sizes)
        self.prefix = np.zeros(len(self.text) + 1, dtype=np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * up[local], out=self.prefix[1:])

    def common(self, a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension from a and b, at most ``most``; la, lb are places within the segments."""
        low, high = np.zeros(len(a), dtype=np.int64), most.copy()
        da, db, pa, pb = self.down[la], self.down[lb], self.prefix[a], self.prefix[b]
        while True:
            go = low < high
            if not go.any():
                return low
            mid = (low + high + 1) >> 1
            same = (self.prefix[a + mid] - pa) * da == (self.prefix[b + mid] - pb) * db
            low = np.where(go & same, mid, low)
            high = np.where(go & ~same, mid - 1, high)


def suffix_order(parts: list[bytes], at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of the suffixes ``parts[i][at[i]:]``, sorted within each group.

    ``group`` does not decrease.  ``common[k]`` is the common length of the k-th suffix in the order and the one
    before it, -1 where a group begins.  Bottom-up mergesort: the rank of a suffix in the neighbouring run is
    found by binary search, for all suffixes of all groups at once.
    """
    bytes_ = Bytes(parts)
    n = len(parts)
    pos, limit = bytes_.begin + at, np.fromiter(map(len, parts), dtype=np.int64, count=n) - at
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.concatenate((first, [n])))
    base, members = np.repeat(first, size), np.repeat(size, size)
    order = np.arange(n)

    def compare(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Sign of suffix y against suffix x."""
        most = np.minimum(limit[x], limit[y])
        k = bytes_.common(pos[x], pos[y], at[x], at[y], most)
        inside = k < most
        last = len(bytes_.text) - 1
        cx, cy = bytes_.text[np.minimum(pos[x] + k, last)].astype(np.int64), bytes_.text[np.minimum(pos[y] + k, last)].astype(np.int64)
        return np.where(inside, np.sign(cy - cx), np.sign(limit[y] - limit[x]))

    width = 1
    while (members > width).any():
        slot = np.flatnonzero(members > width)  # places in the order, by group
        local = slot - base[slot]
        run = local // (2 * width) * (2 * width)
        left = local - run < width
        other = base[slot] + np.where(left, run + width, run)
        stop = base[slot] + np.where(left, np.minimum(run + 2 * width, members[slot]), run + width)
        low, high = other.copy(), np.maximum(stop, other)
        while True:
            go = np.flatnonzero(low < high)
            if not len(go):
                break
            mid = (low[go] + high[go]) >> 1
            sign = compare(order[slot[go]], order[mid])
            before = np.where(left[go], sign < 0, sign <= 0)
            low[go] = np.where(before, mid + 1, low[go])
            high[go] = np.where(before, high[go], mid)
        place = base[slot] + run + (local - run - np.where(left, 0, width)) + (low - other)
        merged = order.copy()
        merged[place] = order[slot]
        order = merged
        width *= 2
    common = np.full(n, -1, dtype=np.int64)
    k = np.flatnonzero(np.arange(n) != base)
    a, b = order[k - 1], order[k]
    common[k] = bytes_.common(pos[a], pos[b], at[a], at[b], np.minimum(limit[a], limit[b]))
    if not verified(parts, at, order, common):
        return plain_order(parts, at, group)
    return order, common


def verified(parts: list[bytes], at: np.ndarray, order: np.ndarray, common: np.ndarray) -> bool:
    """Whether neighbours in the order agree in exactly the bytes that the hashes say, and stand right."""
    at, order = at.tolist(), order.tolist()
    for k, size in enumerate(common.tolist()):
        if size >= 0:
            i, j = order[k - 1], order[k]
            x, y = parts[i][at[i]:], parts[j][at[j]:]
            if x[:size] != y[:size] or x[size:size + 1] == y[size:size + 1] != b"" or x > y:
                return False
    return True


def plain_order(parts: list[bytes], at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same by comparing bytes, for a batch in which two different strings share a hash."""
    order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i][at[i]:], i)))
    common = np.full(len(parts), -1, dtype=np.int64)
    for k in range(1, len(parts)):
        i, j = order[k - 1], order[k]
        if group[i] == group[j]:
            x, y = np.frombuffer(parts[i][at[i]:], dtype=np.uint8), np.frombuffer(parts[j][at[j]:], dtype=np.uint8)
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            common[k] = differ[0] if len(differ) else m
    return order, common


def repeated_windows(group: np.ndarray, parts: list[bytes], off: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Segment x window: whether the window equals one of another segment of its group; ``whole`` marks whole rows."""
    n = len(parts)
    count = np.fromiter(map(len, parts), dtype=np.int64, count=n) - WINDOW + 1
    rank, common = [], []
    for some, at in ((parts, off), ([p[::-1] for p in parts], np.fromiter(map(len, parts), dtype=np.int64, count=n) - off)):
        order, k = suffix_order(some, at, group)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        rank.append(place)
        common.append(k)
    out = np.zeros((n, int(count.max())), dtype=bool)
    out[whole] = np.arange(out.shape[1]) < count[whole, None]
    for before in range(int(off.max()) + 1):  # bytes of the window before the anchor
        rows = np.flatnonzero((off - before >= 0) & (off - before < count))
        if len(rows) < 2:
            continue
        ahead = np.cumsum(common[0] < WINDOW - before)[rank[0][rows]]
        back = np.cumsum(common[1] < before)[rank[1][rows]]
        both = ahead * (n + 1) + back
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        hit = rows[np.concatenate((order[1:][same], order[:-1][same]))]
        out[hit, off[hit] - before] = True
    return out


def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, seg, off, whole, body) sorted by key -> (key, seg, lows, highs): runs of repeated windows."""

    def solve(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        flags = repeated_windows(rows["key"].to_numpy(), rows["body"].tolist(), rows["off"].to_numpy(np.int64), rows["whole"].to_numpy(bool))
        edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        r, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        cut = np.flatnonzero(np.diff(r)) + 1
        if len(r):
            have = r[np.concatenate(([0], cut))]
            yield pd.DataFrame({"key": rows["key"].to_numpy()[have], "seg": rows["seg"].to_numpy()[have],
                                "lows": [x.astype(np.int32) for x in np.split(low, cut)],
                                "highs": [(x - 1).astype(np.int32) for x in np.split(high, cut)]})

    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        for at in range(0, len(frame), 4096):
            part = frame.iloc[at:at + 4096]
            held.append(part)
            size += int(part["body"].map(len).sum())
            if size >= SORT_BYTES:
                rows = pd.concat(held, ignore_index=True)
                keys = rows["key"].to_numpy()
                done = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if done:
                    yield from solve(rows.iloc[:done].reset_index(drop=True))
                held, size = [rows.iloc[done:]], int(rows["body"].iloc[done:].map(len).sum())
    if held and sum(map(len, held)):
        yield from solve(pd.concat(held, ignore_index=True))


RUNS = "key long, seg binary, lows array<int>, highs array<int>"


def counted(pieces: DataFrame) -> DataFrame:
    """The same runs for anchors of very many segments: windows are counted by SHA-256 of their bytes, combined before the shuffle."""
    w = pieces.select("key", "seg", "off", "whole", "body", F.explode(F.sequence(F.lit(0), F.octet_length("body") - WINDOW)).alias("j"))
    w = w.selectExpr("key", "seg", "whole", "j", "off - j AS before", f"sha2(substring(body, j + 1, {WINDOW}), 256) AS content")
    often = w.groupBy("key", "before", "content").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    hit = w.join(often, ["key", "before", "content"], "left_semi").select("key", "seg", "j").unionByName(w.filter("whole").select("key", "seg", "j"))
    hit = hit.groupBy("key", "seg").agg(F.array_sort(F.collect_set("j")).alias("lows"))
    return hit.withColumn("highs", F.col("lows"))


def covered(docs: DataFrame, text: str, doc_id: str, sort_rows: int) -> DataFrame:
    """(doc_id, th, spans): byte intervals [a, b) to remove per document that has any; th hashes its text."""
    names = ["key", "seg", "start", "n", "off"]
    d = few_at_once(docs).select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    found = d.select("doc_id", "th", anchor_columns()(F.col("text")).alias("a"))
    found = stored(found.select("doc_id", "th", F.inline(F.arrays_zip(*[F.col(f"a.{c}").alias(c) for c in names]))), "repeat-anchors")
    each = found.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "th", "start", "n", "off")).alias("at"))
    each = stored(each, "repeat-each")
    keys = stored(each.groupBy("key").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("segs")).filter("c > 1").selectExpr("key", "segs > 1 AS mixed"), "repeat-keys")
    each = stored(each.join(keys, "key").selectExpr("key", "seg", "mixed", "c > 1 AS whole", "at"), "repeat-known")
    again = stored(found.join(each.select("key", "seg", "mixed"), ["key", "seg"]), "repeat-again")
    kinds = each.filter("mixed").select("key", "seg", "whole", "at.*")
    large = stored(kinds.groupBy("key").count().filter(F.col("count") > sort_rows).select("key"), "repeat-large")
    body = d.select(F.col("doc_id").alias("i"), F.col("th").alias("t"), F.col("text").cast("binary").alias("b"))
    pieces = kinds.join(body, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")))
    pieces = pieces.selectExpr("key", "seg", "off", "whole", f"substring(b, start + 1, n + {WINDOW - 1}) AS body")
    if large.isEmpty():
        runs = pieces.repartition("key").sortWithinPartitions("key").mapInPandas(compared, RUNS)
    else:
        pieces = stored(pieces, "repeat-pieces")
        some = pieces.join(large, "key", "left_anti").repartition("key").sortWithinPartitions("key")
        runs = some.mapInPandas(compared, RUNS).unionByName(counted(pieces.join(large, "key", "left_semi")))
    runs = stored(runs, "repeat-runs")
    ends = again.filter("mixed").join(runs, ["key", "seg"])
    ends = ends.select("doc_id", "th", "start", F.inline(F.arrays_zip("lows", "highs")))
    spans = again.filter("NOT mixed").selectExpr("doc_id", "th", "start AS a", f"start + n + {WINDOW - 1} AS b").unionByName(
        ends.selectExpr("doc_id", "th", "start + lows AS a", f"start + highs + {WINDOW} AS b"))
    return spans.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))


def removal(with_kept: bool):
    """Pandas function (text, starts, ends) -> counts, digest and, if wanted, bytes of what is left."""
    kind = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, kept_text string" if with_kept else "")

    @F.pandas_udf(kind)
    def cut(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for t, a, b in zip(text, starts, ends):
            data = t.encode("utf-8", "surrogatepass") if t else b""
            kept, at, spans, gone = [], 0, 0, 0
            if a is not None:
                stop = -1
                for x, y in zip(a.tolist(), b.tolist()):  # sorted by start
                    if x > stop:
                        spans += 1
                        kept.append(data[max(at, 0):x])
                        gone -= x
                        stop = y
                        gone += y
                    elif y > stop:
                        gone += y - stop
                        stop = y
                    at = stop
            kept = b"".join([*kept, data[at:]])
            row = (len(data), gone, spans, hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept, kept.decode("utf-8", "ignore")) if with_kept else row)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])

    return cut


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sort_rows: int = SORT_ROWS,
                   with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (remaining bytes), kept_text per document.

    ``kept_text`` is what is left as text, without halves of characters that a removed run has cut.  Null counts as
    empty; texts under 400 bytes lose nothing by themselves.  Matches never cross documents;
    repeated rows repeat each other's strings.  Whole segments are equal if their BLAKE2b digests are; parts of
    segments are verified on the bytes, but those of anchors with more than ``sort_rows`` different segments, whose
    windows are counted by SHA-256.  ``sort_rows`` does not change the result.
    """
    spans = covered(docs, text, doc_id, sort_rows).select(F.col("doc_id").alias("i"), F.col("th").alias("t"), "spans")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    d = d.join(spans, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left")
    return d.select("doc_id", removal(with_kept)(F.col("text"), F.col("spans.a"), F.col("spans.b")).alias("r")).select("doc_id", "r.*")
