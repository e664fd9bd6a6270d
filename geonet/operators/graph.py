"""Road graph: edges, connected components, distances from many sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from geonet.functions.geometry import geodesic_length
from geonet.operators.chains import rank_arcs
from geonet.operators.vertices import node_key
from geonet.session import Scratch

NODE_TOL = 0.0001


def build_edges(segs: DataFrame, key: str = "line_id", tol: float = NODE_TOL, geodesic: bool = True) -> DataFrame:
    """Both directions of every segment: src, dst, end coordinates, len, road_type; parallel edges stay."""
    d = segs.selectExpr(key, "seg_idx", "x1", "y1", "x2", "y2", "road_type",
                        f"{node_key('x1', 'y1', tol)} AS a", f"{node_key('x2', 'y2', tol)} AS b").filter("a <> b")
    plane = F.expr("sqrt((x2-x1)*(x2-x1) + (y2-y1)*(y2-y1))")
    d = d.withColumn("len", geodesic_length() if geodesic else plane)
    return d.selectExpr(
        key, "seg_idx", "len", "road_type",
        "inline(array(struct(true AS fwd, a AS src, b AS dst, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by),"
        " struct(false AS fwd, b AS src, a AS dst, x2 AS ax, y2 AS ay, x1 AS bx, y1 AS by)))")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Smallest node of the component per node that has an edge: node, component.

    Alternates two rewrites until nothing changes: every larger neighbour of a node is linked to the
    smallest node it knows, then every node and its smaller neighbours likewise.  The edge table never
    grows; each round is written out, and only its row count and checksum reach the driver.  A node with
    very many edges is split by the adaptive skew join; its minimum is combined before the shuffle.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.selectExpr(f"greatest({src}, {dst}) AS u", f"least({src}, {dst}) AS v").filter("u <> v").distinct()
    watch = {"n": "count(1)", "x": "bit_xor(xxhash64(u, v))"}
    e, seen = scratch.cut_watched(pairs, "edges", **watch)
    while seen["n"]:
        both = e.selectExpr("inline(array(struct(u, v), struct(v AS u, u AS v)))")
        low = both.groupBy("u").agg(F.expr("least(min(v), min(u)) AS m"))
        large = both.filter("v > u").join(low, "u").selectExpr("v AS u", "m AS v")
        low = large.groupBy("u").agg(F.expr("min(v) AS m"))
        small = large.join(low, "u").selectExpr("inline(array(struct(v AS u, m AS v), struct(u AS u, m AS v)))")
        e, state = scratch.cut_watched(small.filter("u <> v").distinct(), "edges", **watch)
        if state == seen:
            break
        seen = state
    return e.selectExpr("u AS node", "v AS component").unionByName(e.selectExpr("v AS node", "v AS component").distinct())


def network_distance(edges: DataFrame, sources: DataFrame, cutoff: float | None = None) -> DataFrame:
    """Shortest distance from the nearest source (node, d0) per reached node: node, d.

    Each round relaxes the edges of the nodes that improved in the round before and writes the improved
    rows alone; it reads the edges and the known distances without moving them while the front is small
    enough to be sent to them.  Known distances are merged when the rounds since the last merge hold as many
    rows as it did.  With ``cutoff``, nodes farther than it are left out; distances below it stay exact, and
    edges longer than it are not followed.
    """
    scratch = Scratch(edges.sparkSession, "distance")
    within = "true" if cutoff is None else f"d <= {float(cutoff)}"
    usable = edges if cutoff is None else edges.filter(F.col("len") <= float(cutoff))
    short = scratch.cut(usable.groupBy("src", "dst").agg(F.min("len").alias("len")), "short")
    front, seen = scratch.cut_watched(sources.groupBy("node").agg(F.min("d0").alias("d")).filter(within), "front0", n="count(1)")
    known, fresh, base, since, rounds = front, [], seen["n"], 0, 0
    least = lambda d: d.groupBy("node").agg(F.min("d").alias("d"))
    while seen["n"]:
        rounds += 1
        step = short.join(front.withColumnRenamed("node", "src"), "src").selectExpr("dst AS node", "d + len AS nd").filter(within.replace("d ", "nd "))
        step = step.groupBy("node").agg(F.min("nd").alias("nd"))
        before = reduce(DataFrame.unionByName, fresh, known)
        old = least(before.join(step.select("node"), "node", "left_semi"))
        better = step.join(old, "node", "left").filter("d IS NULL OR nd < d").selectExpr("node", "nd AS d")
        front, seen = scratch.cut_watched(better, f"front{rounds}", n="count(1)")
        if seen["n"]:
            fresh.append(front)
            since += seen["n"]
        if since > base or len(fresh) == 16:
            known = scratch.cut(least(reduce(DataFrame.unionByName, fresh, known)), f"known{rounds}")
            fresh, base, since = [], base + since, 0
    return least(reduce(DataFrame.unionByName, fresh, known))


def chain_arcs(edges: DataFrame, fixed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every arc followed through its chain, and the nodes within chains.

    A node lies within a chain if it has two neighbours, both its edges lead both ways at the same length and it is
    not in ``fixed`` (node).  Output: src, dst (the first node from there on that is not within a chain), len of the
    whole way; and the inner nodes.  Arcs are followed by doubling, so rounds are the logarithm of the longest chain.
    Arcs of a cycle of inner nodes alone lead nowhere and are left out.
    """
    pairs = edges.filter("src <> dst").groupBy(F.expr("least(src, dst) AS a"), F.expr("greatest(src, dst) AS b")).agg(
        F.expr("min(CASE WHEN src < dst THEN len END) AS there"), F.expr("min(CASE WHEN src > dst THEN len END) AS back"))
    pairs = scratch.cut(pairs, "pairs")
    ends = pairs.selectExpr("coalesce(there = back, false) AS even", "inline(array(struct(a AS node, b AS other), struct(b AS node, a AS other)))")
    inner = ends.groupBy("node").agg(F.expr("min(other) AS p"), F.expr("max(other) AS q"), F.expr("count(1) AS n"), F.expr("bool_and(even) AS even"))
    inner = scratch.cut(inner.filter("n = 2 AND even").join(fixed.select("node").distinct(), "node", "left_anti"), "inner")
    links = inner.selectExpr(
        "inline(array(struct(struct(p AS src, node AS dst) AS arc, struct(node AS src, q AS dst) AS next),"
        " struct(struct(q AS src, node AS dst) AS arc, struct(node AS src, p AS dst) AS next)))")
    arcs = pairs.selectExpr("inline(array(struct(struct(a AS src, b AS dst) AS arc, there AS w), struct(struct(b AS src, a AS dst) AS arc, back AS w)))")
    arcs = scratch.cut(arcs.filter("w IS NOT NULL").join(links, "arc", "left").select("arc", "w", "next"), "arcs")
    ways = rank_arcs(arcs, scratch, "ways").filter("done").join(arcs.select("arc", "w"), "arc")
    return scratch.cut(ways.selectExpr("arc.src AS src", "ptr.dst AS dst", "w + cnt AS len"), "through"), inner.select("node")


def chain_distance(edges: DataFrame, sources: DataFrame, cutoff: float | None = None) -> DataFrame:
    """``network_distance`` with one hop per chain: node, d.

    Chains of nodes with two neighbours become single edges between junctions, dead ends and sources.  Distances are
    spread over these alone, in as many rounds as the widest way has junctions and not as it has hops, and put back
    on the inner nodes from both ends of their chain.  It suits long ways; within a cutoff of a few edges
    ``network_distance`` has less to prepare.  Lengths are not negative.
    """
    scratch = Scratch(edges.sparkSession, "contracted")
    usable = edges if cutoff is None else edges.filter(F.col("len") <= float(cutoff))
    through, inner = chain_arcs(usable, sources, scratch)
    outer = through.join(inner.withColumnRenamed("node", "src"), "src", "left_anti").filter("src <> dst")
    met = scratch.cut(network_distance(outer, sources, cutoff), "met")
    within = through.join(inner.withColumnRenamed("node", "src"), "src", "left_semi")
    back = within.join(met.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.expr("min(d + len) AS d"))
    return met.unionByName(back if cutoff is None else back.filter(F.col("d") <= float(cutoff)))


def source_offsets(snaps: DataFrame, tol: float = NODE_TOL) -> DataFrame:
    """Least start distance per snapped node: node, d0."""
    d = snaps.withColumn("node", F.expr(node_key("x", "y", tol)))
    return d.groupBy("node").agg(F.min("offset_dist").alias("d0"))
