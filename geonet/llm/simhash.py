"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into five segments on a ring.  If two fingerprints differ in at most four bits, there is
a segment from which the differences, summed along the ring, never exceed their proportional budget: none in
the first segment, at most one in the first two, two in three, three in four.  Candidates share the first
segment of such a chain and differ in at most one bit of the second, which is an equi-join of fingerprints with
their one-bit neighbours; the rest of the chain is tested before the full Hamming distance.

Only distinct fingerprints are compared.  Dense groups would still give all pairs, so fingerprints that are
neighbours in the order of a chain's bits are linked first, and the join keeps only links between different
classes of these first links.  No link between classes is lost, so the components are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from geonet.llm.common import content_key, few_at_once, free_name, stored, worker_store
from geonet.operators.graph import connected_components

DISTANCE = 4
SEED = 42
CHUNK = 1 << 18
#: Segments of the 64 bits, one more than the distance, so that the first of a chain has budget zero.
WIDTHS = (13, 13, 13, 13, 12)
STARTS = tuple(sum(WIDTHS[:i]) for i in range(len(WIDTHS)))
NEAR = 4


def remixed(h: np.ndarray, k: int) -> np.ndarray:
    """The shingle hashes of the k-th fingerprint: the hashes themselves for 0, else another permutation of them."""
    if not k:
        return h
    h = h ^ np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str | None, shingle: int, prints: int = 1) -> list[int]:
    """Signed 64-bit SimHashes of the word shingles of a text, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: only A-Z, and \x20 and \x09-\x0D
    if not words:
        return [0] * prints
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = (ends[-1:] if len(words) < shingle else ends[shingle - 1:]).tolist()
    counts = np.zeros((prints, 64), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
        for k in range(prints):
            counts[k] += np.unpackbits(remixed(h, k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view("<i8").ravel().tolist()


def fingerprints(shingle: int = 4, prints: int = 1):
    @F.pandas_udf("array<long>")
    def of(text: pd.Series) -> pd.Series:
        worker_store("simhash")
        return pd.Series([fingerprint(t, shingle, prints) for t in text])

    return of


def mask(i: int, n: int) -> int:
    """Bits of ``n`` segments from segment i on around the ring, as a signed number."""
    bits = sum(((1 << WIDTHS[k % 5]) - 1) << STARTS[k % 5] for k in range(i, i + n))
    return bits - (1 << 64) if bits >> 63 else bits


def segment(fp: Column, i: int) -> Column:
    i %= len(WIDTHS)
    return F.shiftrightunsigned(fp, STARTS[i]).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1).cast("long"))


def chain_key(fp: Column, i: int, flip: int = 0) -> Column:
    """Number of the chain start, its segment and the next one, the latter with the bits ``flip`` inverted."""
    second = segment(fp, i + 1).bitwiseXOR(F.lit(flip).cast("long"))
    return F.lit(i << 26).cast("long") + F.shiftleft(segment(fp, i), 13) + second


def exact_keys(fp: Column) -> Column:
    return F.array(*[chain_key(fp, i) for i in range(5)])


def near_keys(fp: Column) -> Column:
    return F.array(*[chain_key(fp, i, flip) for i in range(5) for flip in (0, *[1 << b for b in range(WIDTHS[(i + 1) % 5])])])


def within(a: Column, b: Column, key: Column) -> Column:
    """The later budgets of the chain, then the full distance."""
    diff, start = a.bitwiseXOR(b), (F.shiftright(key, 26).bitwiseAND(F.lit(7).cast("long")) + 1).cast("int")

    def bits(n: int) -> Column:
        return F.bit_count(diff.bitwiseAND(F.element_at(F.array(*[F.lit(mask(i, n)).cast("long") for i in range(5)]), start)))

    return (bits(3) <= 2) & (bits(4) <= 3) & (F.bit_count(diff) <= DISTANCE)


def class_links(first: DataFrame) -> DataFrame:
    """Links between different classes of ``first`` ((k,) fp, c): a, ca, b, cb and the join's key and kb."""
    by = ["k"] if "k" in first.columns else []
    kind = lambda key: key + F.shiftleft(F.col("k").cast("long"), 32) if by else key
    a = first.select(F.col("fp").alias("a"), F.col("c").alias("ca"), *by, F.explode(exact_keys(F.col("fp"))).alias("key"))
    a = a.select("a", "ca", kind(F.col("key")).alias("key"))
    b = first.select(F.col("fp").alias("b"), F.col("c").alias("cb"), *by, F.explode(near_keys(F.col("fp"))).alias("kb"))
    b = b.select("b", "cb", kind(F.col("kb")).alias("kb"))
    linked = (F.col("key") == F.col("kb")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    # Both sides look as small as the stored table, and the neighbours are some seventy times its rows.
    return a.join(b.hint("merge"), linked & within(F.col("a"), F.col("b"), F.col("key")))


def classes(fps: DataFrame) -> DataFrame:
    """``fps`` with the class of every fingerprint, ``component``; ``fps`` has distinct rows (fp) or (k, fp).

    With ``k``, the number of a kind of fingerprint, only fingerprints of one kind are compared, and a class is
    a pair of kind and fingerprint.
    """
    by = ["k"] if "k" in fps.columns else []
    node = lambda c: F.struct("k", F.col(c).alias("fp")) if by else F.col(c)
    exact = fps.select(*by, "fp", F.explode(exact_keys(F.col("fp"))).alias("key"))
    order = W.partitionBy(*by, "key").orderBy("fp")
    close = exact.withColumn("before", F.array(*[F.lag("fp", k).over(order) for k in range(1, NEAR + 1)]))
    close = close.select(*by, "fp", F.explode("before").alias("other"))
    close = close.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE)
    first = connected_components(close.select(node("fp").alias("src"), node("other").alias("dst")))
    own = fps.select(*by, "fp", node("fp").alias("own"))
    first = stored(own.join(first, own["own"] == first["node"], "left").select(*by, "fp", F.coalesce("component", "own").alias("c")), "simhash-first")

    links = class_links(first)
    second = connected_components(links.select(F.col("ca").alias("src"), F.col("cb").alias("dst")))
    out = first.join(second, first["c"] == second["node"], "left")
    return out.select(*by, "fp", F.coalesce("component", "c").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits) and component_id of every document.

    Documents are linked if their fingerprints differ in at most four bits; the component id is the smallest
    doc_id that is reachable.  Null and empty texts have fingerprint zero and link like any other; repeated rows
    each get their row; null ids never name a component unless it has no other.  An empty table gives no rows.
    """
    prints = stored(few_at_once(docs).select(F.col(doc_id).alias("doc_id"), fingerprints(shingle)(F.col(text))[0].alias("fp")), "simhash-prints")
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = stored(classes(fps.select("fp")), "simhash-classes")
    named = fps.join(found, "fp")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stand_ins(docs: DataFrame, named: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows of ``docs`` without those that a smaller node of their group stands for; ``named`` has (node, component)."""
    heads = named.groupBy("component").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head <> last")
    links = named.join(heads, "component").filter("node <> head").select("node", "head")
    groups = connected_components(links.select(F.col("node").alias("src"), F.col("head").alias("dst")))
    key, no = free_name(docs, "_sim_key"), free_name(docs, "_sim_no")
    gone = groups.filter("node <> component").select(F.col("node.key").alias(key)).distinct()
    kept = docs.withColumn(key, content_key(doc_id, text)).join(gone, key, "left_anti")
    repeat = W.partitionBy(key).orderBy(F.xxhash64(F.col(text)))
    return kept.withColumn(no, F.row_number().over(repeat)).filter(F.col(no) == 1).select(*docs.columns)


def representatives(docs: DataFrame, shingle: int = 5, prints: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their group: those of its smallest id.

    ``prints`` independent fingerprints are made per document, and documents within four bits by any of them are
    linked, which finds more of the copies that differ here and there.  Rows are named by id and text, so of rows
    that repeat both one stays, and unlike texts of one id stay; an id goes before none.
    """
    rows = stored(few_at_once(docs).select(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), content_key(doc_id, text).alias("key")).alias("node"),
                                           fingerprints(shingle, prints)(F.col(text)).alias("fps")), "simhash-rows")
    one = rows.select("node", F.posexplode("fps").alias("k", "fp"))
    found = stored(classes(one.select("k", "fp").distinct()), "simhash-classes")
    named = one.join(found, ["k", "fp"])
    return stand_ins(docs, named, text, doc_id)
