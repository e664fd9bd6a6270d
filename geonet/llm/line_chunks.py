"""Line dedup by content-defined chunks of lines.

A hash that rolls over the hashes of the last two lines with a word picks the boundary lines, so a passage is cut alike
wherever it stands and whatever is around it.  A chunk reaches from one boundary line to the next, both included, and all
occurrences of a repeated chunk but the first go.  What no boundary encloses, and every chunk that is kept, is then
compared by its smallest pieces, two neighbouring lines with a word and the blank lines between them: of a
repeated passage of two lines or more no line is left over.  The first occurrence of every line stays, as no piece that
holds it has an earlier one.  The result is that of the pieces alone, as the pieces of a repeated chunk all occur in its
first occurrence; chunks spare them, where texts are copied, a row per pair.  Both are found by length and hash, and
only what is equal byte by byte is removed.
"""

from __future__ import annotations

import re
from collections import deque

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from geonet.llm.common import few_at_once, free_name, stored, worker_store

#: Lines with a word that the boundary hash rolls over; of the lines that may be a boundary one in DIVISOR is.
ROLL, DIVISOR = 2, 4
BASE, MODULUS = 0x100000001B3, (1 << 61) - 1
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
KEY = ["size", "h1", "h2"]
#: Pieces that lie in no chunk.
NOWHERE = -1


def boundaries(lines: list[str]) -> list[int]:
    """Numbers of the boundary lines among ``lines``, all of them with a word; a line like the one before is none."""
    out, recent, rolled, drop = [], deque(), 0, pow(BASE, ROLL, MODULUS)
    for k, line in enumerate(lines):
        h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))
        rolled = (rolled * BASE + h) % MODULUS
        recent.append(h)
        if len(recent) > ROLL:
            rolled = (rolled - drop * recent.popleft()) % MODULUS
        if len(recent) == ROLL and (rolled ^ rolled >> 31) % DIVISOR == 0 and line != lines[k - 1]:
            out.append(k)
    return out


def cut(lines: list[str]) -> list[tuple[int, int, int, int]]:
    """(level, first line, lines, part): chunks (level 1) and pieces (level 0) of a text, the latter with the first line of their chunk.

    A line that repeats itself gives every other pair and its last three, so that its pairs do not remove one another.
    """
    worded = [i for i, line in enumerate(lines) if HAS_WORD.search(line)]
    edges = boundaries([lines[i] for i in worded])
    out = [(1, worded[a], worded[b] + 1 - worded[a], worded[a]) for a, b in zip(edges, edges[1:])]
    part = [NOWHERE] * len(worded)
    for a, b in zip(edges, edges[1:]):
        part[a:b] = [worded[a]] * (b - a)
    body, run = None, 0
    for k in range(len(worded) - 1):
        first, end = worded[k], worded[k + 1] + 1
        run = run + 1 if lines[first:end] == body else 0
        body = lines[first:end]
        if run % 2 == 0:
            out.append((0, first, end - first, part[k]))
        if run and (k + 2 == len(worded) or lines[worded[k + 1]:worded[k + 2] + 1] != body):
            out.append((0, worded[k - 1], end - worded[k - 1], part[k]))
    return out


def chunk_columns(with_body: bool):
    """Pandas function text -> arrays over chunks and pieces: level, first line, lines, part, bytes in it, 128-bit hash, and the bytes."""
    kind = "level array<int>, first array<int>, lines array<int>, part array<int>, size array<int>, h1 array<long>, h2 array<long>"
    kind += ", body array<binary>" if with_body else ""

    @F.pandas_udf(kind)
    def chunks(text: pd.Series) -> pd.DataFrame:
        worker_store("lines")
        rows = []
        for t in text:
            lines = t.split("\n") if t else []
            found = cut(lines)
            bodies = ["\n".join(lines[a:a + n]).encode("utf-8", "surrogatepass") for _, a, n, _ in found]
            hashes = [xxhash.xxh3_128_digest(b) for b in bodies]
            row = [*([x[k] for x in found] for k in range(4)), [len(b) for b in bodies],
                   [int.from_bytes(h[:8], "little", signed=True) for h in hashes], [int.from_bytes(h[8:], "little", signed=True) for h in hashes]]
            rows.append(row + [bodies] if with_body else row)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])

    return chunks


def without():
    """Pandas function (text, first lines, line counts) -> (text, lines, lines removed)."""

    @F.pandas_udf("kept string, n_lines long, n_removed long")
    def rest(text: pd.Series, firsts: pd.Series, counts: pd.Series) -> pd.DataFrame:
        rows = []
        for t, a, n in zip(text, firsts, counts):
            if t is None or not len(t):
                rows.append((t, 0, 0))
                continue
            if a is None or not len(a):
                rows.append((t, t.count("\n") + 1, 0))
                continue
            gone = {i for x, y in zip(a, n) for i in range(x, x + y)}
            lines = t.split("\n")
            rows.append(("\n".join([line for i, line in enumerate(lines) if i not in gone]), len(lines), len(gone)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_removed"])

    return rest


def chunk_rows(docs: DataFrame, text: str, doc_id: str, with_body: bool) -> DataFrame:
    names = ["level", "first", "lines", "part", *KEY] + (["body"] if with_body else [])
    d = few_at_once(docs).select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), chunk_columns(with_body)(F.col(text)).alias("c"))
    zipped = F.arrays_zip(*[F.col(f"c.{n}").alias(n) for n in names])
    return d.select("doc_id", "th", F.inline(zipped))


def counted(at: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(kinds that occur more than once with their first occurrence, their occurrences).

    Kinds are grouped after a map-side combine, so one that a third of all documents hold is one row per task.
    """
    known = at.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "first")).alias("keep"))
    known = stored(known.filter("n > 1").drop("n"), f"lines-known-{name}")
    return known, stored(at.join(known, KEY), f"lines-again-{name}")


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", chunks: bool = True) -> DataFrame:
    """(doc_id, th, firsts, counts): the lines to remove from each document that has any; th hashes its text.

    Chunks and pieces are counted by length and hash; the bytes of all that occur again are compared afterwards.  Should two
    different bodies share length and the 128 bits of their hash, everything is compared by pieces alone, that is without
    ``chunks``, and neither of such pieces is removed.
    """
    later = ~F.struct("doc_id", "th", "first").eqNullSafe(F.col("keep"))
    rows = stored(chunk_rows(docs, text, doc_id, False), "lines-rows")
    pieces = rows.filter("level = 0")
    if chunks:
        large, again = counted(rows.filter("level = 1"), "chunks")
        gone = again.filter(later).select("doc_id", "th", "first", "lines", *KEY)
        done = gone.select(F.col("doc_id").alias("i"), F.col("th").alias("t"), F.col("first").alias("p")).distinct()
        pieces = pieces.join(done, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")) & (F.col("part") == F.col("p")), "left_anti")
    small, at = counted(pieces, "pieces")
    holders, kinds = at.select("doc_id", "th"), small.select(F.lit(0).alias("level"), *KEY)
    if chunks:
        holders, kinds = holders.unionByName(again.select("doc_id", "th")), kinds.unionByName(large.select(F.lit(1).alias("level"), *KEY))
    whole = holders.distinct().select(F.col("doc_id").alias("_i"), F.col("th").alias("_th"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.join(whole, texts["doc_id"].eqNullSafe(F.col("_i")) & (F.xxhash64("text") == F.col("_th")), "left_semi")
    bodies = chunk_rows(texts, "text", "doc_id", True).join(kinds, ["level", *KEY], "left_semi")
    clash = bodies.select("level", *KEY, "body").distinct().groupBy("level", *KEY).agg(F.count(F.lit(1)).alias("bodies")).filter("bodies > 1")
    clash = stored(clash, "lines-clash")
    if chunks and not clash.isEmpty():
        return repeated(docs, text, doc_id, False)
    lost = at.filter(later).join(clash.filter("level = 0"), KEY, "left_anti").select("doc_id", "th", "first", "lines")
    if chunks:
        lost = lost.unionByName(gone.select("doc_id", "th", "first", "lines"))
    lost = lost.groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "lines")).alias("gone"))
    return lost.select("doc_id", "th", F.col("gone.first").alias("firsts"), F.col("gone.lines").alias("counts"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, Column]:
    """(``docs`` with one more column, that column): a struct of kept text, n_lines and n_removed.

    The first occurrence of a chunk or piece, by doc_id (null first) and line, stays.  Null stays null and empty stays
    empty, with no lines; a text that loses all its lines becomes empty.  Rows that repeat both id and text
    count as one document.  Blank lines go with the piece that holds them and make none by themselves.  A line of a
    first occurrence goes too where it is part of another piece that stands earlier.
    """
    gone = repeated(docs, text, doc_id)
    out, i, th = free_name(docs, "_lines"), free_name(docs, "_lines_id"), free_name(docs, "_lines_th")
    gone = gone.select(F.col("doc_id").alias(i), F.col("th").alias(th), F.struct("firsts", "counts").alias(out))
    d = docs.join(gone, docs[doc_id].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text]) == F.col(th)), "left").drop(i, th)
    d = d.withColumn(out, without()(F.col(text), F.col(f"{out}.firsts"), F.col(f"{out}.counts")))
    return d, F.col(out)


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_lines, n_removed, kept (the remaining text) per document."""
    d, x = dedup_lines(docs, text, doc_id)
    return d.select(F.col(doc_id).alias("doc_id"), x["n_lines"].alias("n_lines"), x["n_removed"].alias("n_removed"), x["kept"].alias("kept"))


def replaced(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: str = "n_chars") -> DataFrame:
    """The rows and columns of ``docs`` with the remaining text (and its length, where there is such a column)."""
    d, x = dedup_lines(docs, text, doc_id)
    made = {text: x["kept"], length: F.char_length(x["kept"]).cast("long")}
    return d.select(*[made[c].alias(c) if c in made else F.col(c) for c in docs.columns])
