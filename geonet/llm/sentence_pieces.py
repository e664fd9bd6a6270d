"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut into units that no piece crosses (before every space mark that follows another
character), and the distinct units that are new to the worker are put one after the other.  A suffix array of
that text is built to the length of the longest piece, every piece of the vocabulary is found in it by binary
search, and the suffixes in its range are its occurrences: the edges of a lattice.  Sorted by position, the
edges are relaxed from left to right.

The vocabulary is a byte-pair model, so the best path is not the one of the greatest sum of scores: it is the
one that merging by rank would give.  That path is found by relaxing as well.  The encoding of every prefix of a
unit is unique, and an edge continues it exactly if its piece and the last piece before it stay as they are when
the two are encoded together; this is decided by taking back their merges, the later one first, and looking
for a merge across the border that would have come earlier.  Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from geonet.llm.common import few_at_once, give_back, worker_store

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", re.S)
#: Units that a worker remembers, but for those of the texts at hand; they hold most of its memory.
CACHE_UNITS = 200_000
#: Characters indexed together.
INDEX_CHARS = 1 << 18
#: Characters of the texts whose units are held together; a longer text is taken by itself.
HELD_CHARS = 1 << 20
HASH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left piece, right piece) -> joined piece, in an open-addressed table that is probed for many pairs at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        self.shift = np.uint64(64 - max(8, int(4 * len(left)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size + 64, -1, dtype=np.int64), np.full(size + 64, -1, dtype=np.int32)
        self.probes = 1
        for key, slot, value in zip((left << 32 | right).tolist(), self.slot(left << 32 | right).tolist(), joined.tolist()):
            at = slot
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.values[at] = key, value
            self.probes = max(self.probes, at - slot + 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * HASH) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self.slot(keys)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for step in range(self.probes):
            held = self.keys[at[open_] + step]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]] + step]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
        return out


class Model:
    """Pieces, ranks and merges of a byte-pair sentencepiece file."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.names = [m.id_to_piece(i) for i in range(n)]
        special = [m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
        self.byte = np.zeros(256, dtype=np.int64)
        for i in range(n):
            if m.is_byte(i):
                self.byte[int(self.names[i][3:5], 16)] = i
        self.ids = {p: i for i, p in enumerate(self.names) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece of this vocabulary crosses words")
        #: Lower ranks merge first; equal ranks from the left.
        self.rank = np.array([-m.get_score(i) for i in range(n)])
        self.rank = np.unique(self.rank, return_inverse=True)[1].astype(np.int64)
        pairs = [(self.ids[p[:k]], self.ids[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        self.merge = {(a, b): i for a, b, i in pairs}
        # the last merge of every piece in its own encoding; -1 for characters and for pieces never reached
        self.left, self.right = np.full(n + 1, -1, dtype=np.int64), np.full(n + 1, -1, dtype=np.int64)
        self.usable = np.zeros(n + 1, dtype=bool)
        for p, i in self.ids.items():
            done, last = self.merged(p)
            if done == [i]:
                self.usable[i] = True
                if last:
                    self.left[i], self.right[i] = last
        made = np.flatnonzero(self.left >= 0)
        for part in (self.left[made], self.right[made]):  # merges are taken back by rank, so ranks must follow them
            if ((self.left[part] >= 0) & (self.rank[part] > self.rank[made])).any():
                raise ValueError("the ranks of this vocabulary do not follow its merges")
        self.unknown = n  # stands for a character without a piece
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).T)
        use = [i for i in self.ids.values() if self.usable[i]]
        self.pieces = np.array(sorted(use, key=lambda i: self.names[i]), dtype=np.int64)
        self.sizes = np.array([len(self.names[i]) for i in self.pieces], dtype=np.int64)
        self.longest = int(self.sizes.max())
        self.codes = np.zeros((len(self.pieces), self.longest), dtype=np.uint32)
        for r, i in enumerate(self.pieces.tolist()):
            self.codes[r, :self.sizes[r]] = [ord(c) + 1 for c in self.names[i]]

    def merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Encoding of a short text by merging, and the last merge made; for the vocabulary itself."""
        parts = [self.ids.get(c, -1) for c in text]
        last = None
        while True:
            best = min(((self.rank[self.merge[x]], k) for k, x in enumerate(zip(parts[:-1], parts[1:])) if x in self.merge), default=None)
            if best is None:
                return parts, last
            k = best[1]
            last = parts[k], parts[k + 1]
            parts[k:k + 2] = [self.merge[last]]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a and b, each a whole encoding, stay side by side when encoded together."""
        out = np.ones(len(a), dtype=bool)
        open_, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)  # merges across the border below this rank would have come first
        while len(open_):
            joined = self.pairs.find(a, b)
            crossed = (joined >= 0) & (self.rank[joined] < limit)
            out[open_[crossed]] = False
            ra = np.where(self.left[a] >= 0, self.rank[np.minimum(a, len(self.rank) - 1)], -1)
            rb = np.where(self.left[b] >= 0, self.rank[np.minimum(b, len(self.rank) - 1)], -1)
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            open_, a, b, ra, rb = open_[go], a[go], b[go], ra[go], rb[go]
            # the later merge is the one of greater rank; of equal ones the right one, as the left came first
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places in ``codes`` sorted by the ``depth`` characters that follow (by prefix doubling)."""
    n = len(codes)
    present = np.zeros(int(codes.max()) + 1, dtype=np.int64)
    present[codes] = 1
    dense = np.cumsum(present)[codes]  # characters numbered from 1, in their order
    bits = int(dense.max()).bit_length()
    size, key = 0, np.zeros(n, dtype=np.int64)
    while size < depth and (size + 1) * bits <= 63:  # as many characters as fit one number
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:max(0, n - size)] = dense[size:]
        key, size = key << bits | ahead, size + 1
    rank = np.empty(n, dtype=np.int64)
    while True:
        order = np.argsort(key)
        if size >= depth:
            return order
        key = key[order]
        rank[order] = np.concatenate(([1], np.cumsum(key[1:] != key[:-1]) + 1))
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:max(0, n - size)] = rank[size:]
        key, size = rank * (int(rank.max()) + 1) + ahead, 2 * size


def occurrences(model: Model, codes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, row of the piece) of every occurrence of every piece: binary searches of all pieces at once."""
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(model.longest, dtype=codes.dtype)))
    low, high = np.zeros(len(model.pieces), dtype=np.int64), np.full(len(model.pieces), n, dtype=np.int64)
    for k in range(model.longest):
        rows = np.flatnonzero((model.sizes > k) & (low < high))
        want = model.codes[rows, k]

        def bound(strict: bool) -> np.ndarray:
            """First suffix in the range whose k-th character is at least (more than, if strict) the wanted one."""
            a, b = low[rows].copy(), high[rows].copy()
            while True:
                go = np.flatnonzero(a < b)
                if not len(go):
                    return a
                mid = (a[go] + b[go]) >> 1
                c = padded[order[mid] + k]
                up = c <= want[go] if strict else c < want[go]
                a[go], b[go] = np.where(up, mid + 1, a[go]), np.where(up, b[go], mid)

        first, stop = bound(False), bound(True)
        low[rows], high[rows] = first, stop
    count = high - low
    row = np.repeat(np.arange(len(model.pieces), dtype=np.int32), count)
    place = np.arange(len(row), dtype=np.int32) + np.repeat((low - np.cumsum(count) + count).astype(np.int32), count)
    return order.astype(np.int32)[place], row


def encode_units(model: Model, units: list[str]) -> list[bytes]:
    """Ids (as uint16 or uint32 bytes) of units that no piece crosses."""
    kind = np.uint16 if len(model.names) <= 1 << 16 else np.uint32
    sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]  # a zero character ends each unit
    codes = np.frombuffer(("\0".join(units) + "\0").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = np.ones(len(codes), dtype=bool)
    inside[begin + sizes] = False
    codes = np.where(inside, codes + np.uint32(1), 0).astype(np.uint32)  # characters from 1, so that no character is the end
    order = suffix_array(codes, model.longest)
    at, row = occurrences(model, codes, order)
    piece, size = model.pieces.astype(np.int32)[row], model.sizes.astype(np.int32)[row]
    single = np.zeros(len(codes), dtype=bool)
    single[at[size == 1]] = True
    lone = np.flatnonzero(inside & ~single).astype(np.int32)
    at, size = np.concatenate((at, lone)), np.concatenate((size, np.ones(len(lone), dtype=np.int32)))
    piece = np.concatenate((piece, np.full(len(lone), model.unknown, dtype=np.int32)))
    head = np.repeat(begin, sizes + 1).astype(np.int32)  # first place of the unit of each place
    end = at + size
    depth = end - head[at]  # characters of the unit before the end of the edge
    by = np.argsort(depth.astype(np.uint16), kind="stable") if int(depth.max()) < 1 << 16 else np.argsort(depth, kind="stable")
    at, piece, end, depth = at[by], piece[by], end[by], depth[by]
    cuts = np.searchsorted(depth, np.arange(1, int(sizes.max(initial=0)) + 2))
    last, back = np.full(len(codes) + 1, -1, dtype=np.int64), np.zeros(len(codes) + 1, dtype=np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        here, ids = at[a:b].astype(np.int64), piece[a:b].astype(np.int64)
        starts = here == head[here]
        before = last[here]
        ok = starts | (before >= 0)
        ask = np.flatnonzero(ok & ~starts)
        ok[ask] = model.compatible(before[ask], ids[ask])
        last[end[a:b][ok]], back[end[a:b][ok]] = ids[ok], here[ok]
    # walk back from the end of every unit, all units at once
    out_unit, out_place, out_id = [], [], []
    unit, place = np.flatnonzero(sizes), (begin + sizes)[sizes > 0]
    while len(unit):
        out_unit.append(unit)
        out_place.append(place)
        out_id.append(last[place])
        place = back[place]
        go = place > begin[unit]
        unit, place = unit[go], place[go]
    if not out_unit:
        return [b""] * len(units)
    unit, place, ids = map(np.concatenate, (out_unit, out_place, out_id))
    by = np.argsort(place)
    unit, place, ids = unit[by], place[by], ids[by]
    if (ids == model.unknown).any():
        unit, ids = with_bytes(model, codes, unit, place, ids)
    raw = ids.astype(kind).tobytes()
    width = np.dtype(kind).itemsize
    stops = (np.searchsorted(unit, np.arange(len(units) + 1)) * width).tolist()
    return [raw[a:b] for a, b in zip(stops[:-1], stops[1:])]


def with_bytes(model: Model, codes: np.ndarray, unit: np.ndarray, place: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece replaced by the pieces of their bytes."""
    lone = np.flatnonzero(ids == model.unknown)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in (codes[place[lone] - 1] - np.uint32(1)).tolist()]
    count = np.ones(len(ids), dtype=np.int64)
    count[lone] = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    out = np.repeat(ids, count)
    out[out == model.unknown] = model.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    return np.repeat(unit, count), out


class Encoder:
    """Encodes and decodes whole texts, remembering the units of a worker."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.kind = np.dtype("<u2" if len(self.model.names) <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        m = self.model
        self.texts = [m.names[i].replace(SPACE, " ") for i in range(len(m.names))]
        self.bytes_of = {int(i): bytes([b]) for b, i in enumerate(m.byte.tolist())}
        for i in range(len(m.names)):
            if i not in self.bytes_of and m.names[i] not in m.ids:
                self.texts[i] = ""

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")  # without the space mark that each of them begins with
        return [u[1:] if u[1:2] != SPACE and len(u) > 1 else u for u in UNIT.findall(SPACE + text.replace(" ", SPACE))]

    def prepare(self, texts: list[str | None]) -> None:
        """Index and learn the units of these texts that are new; one index for as many texts as INDEX_CHARS allow."""
        if len(self.known) > CACHE_UNITS:
            # units of these texts stay: the common ones are among them
            here = set().union(*[self.units(t or "") for t in texts])
            self.known = {u: ids for u, ids in self.known.items() if u in here}
            give_back()
        new: set[str] = set()
        size = 0
        for at in range(0, len(texts), 64):
            some = set().union(*[self.units(t or "") for t in texts[at:at + 64]]).difference(self.known, new)
            new |= some
            size += sum(map(len, some)) + 2 * len(some)
            if size > INDEX_CHARS:
                self.learn(list(new))
                new, size = set(), 0
        if new:
            self.learn(list(new))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, as bytes, one text after the other."""
        at = 0
        while at < len(texts):
            stop, size = at + 1, len(texts[at] or "")
            while stop < len(texts) and size + len(texts[stop] or "") <= HELD_CHARS:
                size += len(texts[stop] or "")
                stop += 1
            self.prepare(texts[at:stop])
            for t in texts[at:stop]:
                yield b"".join(map(self.known.__getitem__, self.units(t or "")))
            at = stop

    def learn(self, units: list[str]) -> None:
        # runs of space marks were left whole by ``units``; all others get the mark back that they begin with
        self.known.update(zip(units, encode_units(self.model, [u if u[:1] == SPACE else SPACE + u for u in units])))
        give_back()  # the arrays of an index

    def decode(self, ids: bytes) -> str:
        some = np.frombuffer(ids, dtype=self.kind).tolist()
        if self.bytes_of.keys().isdisjoint(some):
            text = "".join(map(self.texts.__getitem__, some))
        else:
            text = b"".join(self.bytes_of.get(i) or self.texts[i].encode("utf-8", "surrogatepass") for i in some).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encoder(path: str) -> Encoder:
    store = worker_store("sentence_pieces")
    if path not in store:
        store.clear()
        store[path] = Encoder(path)
    return store[path]


def encode(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default doc_id) of every row with ``ids``, the pieces of its whole text.

    Null and empty texts have no ids.  Rows are independent; very long texts and words are indexed whole.
    """

    @F.pandas_udf("array<int>")
    def ids(some: pd.Series) -> pd.Series:
        enc = encoder(model)
        out = []
        for x in enc.encode(some.tolist()):
            out.append(np.frombuffer(x, dtype=enc.kind).astype(np.int32))
        return pd.Series(out)

    return few_at_once(docs).select(*[F.col(c) for c in keep or ["doc_id"]], ids(F.col(text)).alias("ids"))


def decode(rows: DataFrame, model: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default doc_id) with ``text``, the text of an array of ids; null stays null."""

    @F.pandas_udf("string")
    def texts(some: pd.Series) -> pd.Series:
        enc = encoder(model)
        return pd.Series([None if x is None else enc.decode(np.asarray(x, dtype=enc.kind).tobytes()) for x in some])

    return few_at_once(rows).select(*[F.col(c) for c in keep or ["doc_id"]], texts(F.col(ids)).alias("text"))


def digests(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip per row.

    ``round_trip``: the decoded ids give the text back, a literal space mark counting as a space; null counts
    as empty.  Encoding and decoding run in one function, so the ids themselves are not shuffled or stored.
    """

    @F.pandas_udf("n_tokens long, ids_crc32 long, round_trip boolean")
    def both(some: pd.Series) -> pd.DataFrame:
        enc = encoder(model)
        rows = []
        texts = some.tolist()
        for t, x in zip(texts, enc.encode(texts)):
            ids = np.frombuffer(x, dtype=enc.kind)
            rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), enc.decode(x) == (t or "").replace(SPACE, " ")))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_crc32", "round_trip"])

    return few_at_once(docs).select(F.col(doc_id).alias("doc_id"), both(F.col(text)).alias("r")).select("doc_id", "r.*")
