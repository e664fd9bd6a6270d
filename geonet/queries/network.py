"""Graph operators: edges, components, distances, chains, simplification, colouring, runs, dissolve."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geonet.fixtures import layer, with_layers
from geonet.operators import chains, coloring, dissolve, graph, noding, simplify
from geonet.operators.skew import salted_join
from geonet.operators.vertices import node_key
from geonet.queries.attributes import haversine_sql
from geonet.queries.lines import NETWORK, PATH_SEGS, network_segments, r, street_segments
from geonet.session import settle

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


def minor_streets(spark, sf) -> DataFrame:
    """Streets of the minor classes: a network that falls apart into many components."""
    return layer(spark, sf, "fx_streets").filter("frc > 2 AND edge_category <> 'B'").selectExpr(
        "street_id AS line_id", "0 AS seg_idx", "x1", "y1", "x2", "y2", "road_type")


NODES = "struct_pack(kx := CAST(floor({x} / 0.0001 + 0.5) AS BIGINT), ky := CAST(floor({y} / 0.0001 + 0.5) AS BIGINT))"
# Lattice nodes as one number, for the recursive texts.
MINOR = """minor AS (SELECT street_id, road_type, CAST(x1 + y1 * 10000 AS BIGINT) AS a, CAST(x2 + y2 * 10000 AS BIGINT) AS b FROM fx_streets WHERE frc > 2 AND edge_category <> 'B'),
both_ AS (SELECT a AS u, b AS v FROM minor UNION ALL SELECT b, a FROM minor)"""


@query("build_edges", with_layers("fx_streets fx_paths", f"""
WITH {PATH_SEGS}, {NETWORK}, e AS (SELECT line_id, seg_idx, road_type, x1, y1, x2, y2, round({haversine_sql('x1', 'y1', 'x2', 'y2')}, 6) + 0.0 AS len FROM net)
SELECT line_id, seg_idx, road_type, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_, len FROM e UNION ALL SELECT line_id, seg_idx, road_type, x2, y2, x1, y1, len FROM e"""))
def _(spark, sf):
    d = graph.build_edges(network_segments(spark, sf))
    return d.selectExpr("line_id", "seg_idx", "road_type", "ax", "ay", "bx", "by AS by_", *r("len"))


@query("connected_components", with_layers("fx_streets", f"""
WITH RECURSIVE {MINOR}, cc(node, comp) USING KEY (node) AS (
  SELECT u, min(least(u, v)) FROM both_ GROUP BY 1 UNION
  SELECT node, min(comp) FROM (SELECT e.v AS node, cc.comp FROM cc JOIN both_ e ON e.u = cc.node JOIN recurring.cc AS old ON old.node = e.v WHERE cc.comp < old.comp) GROUP BY 1)
SELECT node, comp AS component FROM cc"""))
def _(spark, sf):
    num = lambda x, y: f"CAST({x} + {y} * 10000 AS BIGINT)"
    e = minor_streets(spark, sf).selectExpr(f"{num('x1', 'y1')} AS src", f"{num('x2', 'y2')} AS dst")
    return graph.connected_components(e)


@query("network_distance", with_layers("fx_streets fx_points", f"""
WITH RECURSIVE {MINOR}, start AS (SELECT CAST(floor(x / 100 + 0.5) * 100 + floor(y / 100 + 0.5) * 1000000 AS BIGINT) AS node, min(anzahl + 0.0) AS d FROM fx_points GROUP BY 1),
dist(node, d) USING KEY (node) AS (SELECT node, d FROM start WHERE d <= 400 UNION
  SELECT node, min(d) FROM (SELECT e.v AS node, dist.d + 100 AS d FROM dist JOIN both_ e ON e.u = dist.node LEFT JOIN recurring.dist AS old ON old.node = e.v
    WHERE dist.d + 100 <= 400 AND (old.d IS NULL OR dist.d + 100 < old.d)) GROUP BY 1)
SELECT node, d FROM dist"""))
def _(spark, sf):
    """Distance along minor streets from parking points at their nearest lattice node, up to 400."""
    num = lambda x, y: f"CAST({x} + {y} * 10000 AS BIGINT)"
    e = minor_streets(spark, sf).selectExpr(
        f"inline(array(struct({num('x1', 'y1')} AS src, {num('x2', 'y2')} AS dst), struct({num('x2', 'y2')} AS src, {num('x1', 'y1')} AS dst)))", "100D AS len")
    s = layer(spark, sf, "fx_points").selectExpr(
        f"{num('floor(x / 100 + 0.5D) * 100', 'floor(y / 100 + 0.5D) * 100')} AS node", "CAST(anzahl AS DOUBLE) AS d0")
    return graph.network_distance(e, s, cutoff=400.0)


@query("chain_distance", """
WITH hop AS (SELECT event_id AS id, event_type = 'signup' AND user_id % 100 = 0 AS seat, CAST(user_id % 7 AS DOUBLE) AS d0,
  CAST(1 + user_id % 9 AS DOUBLE) AS len, coalesce(event_id - lag(event_id) OVER (ORDER BY event_id) <> 1, true) AS opens FROM events),
part AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (ORDER BY id) AS chain FROM hop),
pos AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY chain ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM part),
near AS (SELECT id, least(m + min(CASE WHEN seat THEN d0 - m END) OVER (PARTITION BY chain ORDER BY id),
  min(CASE WHEN seat THEN d0 + m END) OVER (PARTITION BY chain ORDER BY id DESC) - m) AS d FROM pos)
SELECT id AS node, d FROM near WHERE d IS NOT NULL UNION ALL SELECT -id, d + 5 FROM near WHERE d IS NOT NULL AND id % 97 = 1""")
def _(spark, sf):
    """Distance from the nearest seat along one way through all events, with a spur at every 97th."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "user_id")
    way = e.join(e.selectExpr("event_id - 1 AS event_id"), "event_id", "left_semi").selectExpr("event_id AS a", "event_id + 1 AS b", "CAST(1 + user_id % 9 AS DOUBLE) AS len")
    spurs = e.filter("event_id % 97 = 1").selectExpr("event_id AS a", "-event_id AS b", "5D AS len")
    edges = way.unionByName(spurs).selectExpr("inline(array(struct(a AS src, b AS dst, len), struct(b AS src, a AS dst, len)))")
    seats = e.filter("event_type = 'signup' AND user_id % 100 = 0").selectExpr("event_id AS node", "CAST(user_id % 7 AS DOUBLE) AS d0")
    return graph.chain_distance(edges, seats)


SNAP = """snaps AS (SELECT street_id, least(1, greatest(0, ((p.x - x1) * (x2 - x1) + (p.y - y1) * (y2 - y1)) / 10000)) AS t, x1, y1, x2, y2, p.x AS px, p.y AS py, road_type
  FROM (SELECT DISTINCT x, y FROM fx_points) p JOIN fx_streets s ON p.x BETWEEN least(x1, x2) - 40 AND greatest(x1, x2) + 40 AND p.y BETWEEN least(y1, y2) - 40 AND greatest(y1, y2) + 40),
snap AS (SELECT street_id, x1 + t * (x2 - x1) AS x, y1 + t * (y2 - y1) AS y, px, py,
  CASE road_type WHEN 'footway' THEN 2.0 WHEN 'service' THEN 3.0 WHEN 'residential' THEN 3.0 WHEN 'primary' THEN 6.0 ELSE 2.5 END AS off FROM snaps)"""


@query("source_offsets", with_layers("fx_points fx_streets", f"""
WITH {SNAP}, d AS (SELECT *, {haversine_sql('px', 'py', 'x', 'y')} AS raw FROM snap)
SELECT CAST(floor(x / 0.0001 + 0.5) AS BIGINT) AS kx, CAST(floor(y / 0.0001 + 0.5) AS BIGINT) AS ky, round(min(greatest(0, raw - off)), 6) + 0.0 AS d0 FROM d WHERE raw <= 20 + 1e-6 GROUP BY 1, 2"""))
def _(spark, sf):
    snaps = noding.nearest_on_each_line(layer(spark, sf, "fx_points"), street_segments(spark, sf))
    return graph.source_offsets(snaps).selectExpr("node.kx AS kx", "node.ky AS ky", *r("d0"))


def node_distances(spark, sf) -> DataFrame:
    """Distances at the nodes of the tracks' lattice, taken from the event values."""
    return layer(spark, sf, "fx_streets").selectExpr(
        f"{node_key('x1', 'y1', graph.NODE_TOL)} AS node", "CAST(width_m * 9 AS DOUBLE) AS d").filter("d >= 0").groupBy("node").agg(F.min("d").alias("d"))


COLOR = """
nd AS (SELECT x1 AS x, y1 AS y, min(width_m * 9.0) AS d FROM fx_streets WHERE width_m >= 0 GROUP BY 1, 2),
e AS (SELECT s.*, a.d AS da0, b.d AS db0, 100.0 AS len FROM fx_streets s LEFT JOIN nd a ON a.x = x1 AND a.y = y1 LEFT JOIN nd b ON b.x = x2 AND b.y = y2),
f AS (SELECT street_id, road_type, coalesce(da0, db0 + len) AS da, coalesce(db0, da0 + len) AS db, len FROM e WHERE da0 IS NOT NULL OR db0 IS NOT NULL),
smp AS (SELECT *, i / 10.0 AS t, CASE i WHEN 0 THEN da WHEN 10 THEN db ELSE least(da + i * 10, db + 100 - i * 10) END AS d FROM f, range(0, 11) r(i)),
seg AS (SELECT * FROM (SELECT *, lead(t) OVER w AS t2, lead(d) OVER w AS d2 FROM smp WINDOW w AS (PARTITION BY street_id ORDER BY i)) WHERE t2 IS NOT NULL),
cut AS (SELECT street_id, t, d FROM smp UNION ALL SELECT street_id, t + (k - d) / (d2 - d) * (t2 - t), k FROM seg, (VALUES (25.0), (50.0), (75.0)) v(k) WHERE (d < k AND d2 > k) OR (d2 < k AND d > k)),
pc AS (SELECT * FROM (SELECT street_id, t AS t0, lead(t) OVER w AS t1, (d + lead(d) OVER w) / 2 AS mid FROM cut WINDOW w AS (PARTITION BY street_id ORDER BY t)) WHERE t1 IS NOT NULL),
colored AS (SELECT street_id, t0, t1, CASE WHEN mid < 25 THEN 25 WHEN mid < 50 THEN 50 WHEN mid < 75 THEN 75 ELSE 0 END AS color, road_type FROM pc JOIN fx_streets USING (street_id)
  UNION ALL SELECT street_id, 0, 1, 0, NULL FROM e WHERE da0 IS NULL AND db0 IS NULL)"""


def colored(spark, sf) -> DataFrame:
    edges = graph.build_edges(street_segments(spark, sf), geodesic=False)
    return coloring.color_edges(edges, node_distances(spark, sf))


@query("color_edges", with_layers("fx_streets", f"""
WITH {COLOR} SELECT street_id AS line_id, round(t0, 6) + 0.0 AS t0, round(t1, 6) + 0.0 AS t1, color,
  CASE color WHEN 25 THEN 40 WHEN 50 THEN 30 WHEN 75 THEN 20 ELSE 10 END AS rank, road_type FROM colored"""))
def _(spark, sf):
    return colored(spark, sf).selectExpr("line_id", *r("t0", "t1"), "color", "rank", "road_type")


@query("merge_runs", with_layers("fx_streets", f"""
WITH {COLOR}, g AS (SELECT *, CASE WHEN abs(t0 - lag(t1) OVER w) <= 1e-9 THEN 0 ELSE 1 END AS brk FROM colored WINDOW w AS (PARTITION BY street_id, color ORDER BY t0)),
h AS (SELECT *, sum(brk) OVER (PARTITION BY street_id, color ORDER BY t0) AS run FROM g)
SELECT street_id AS line_id, color, CAST(run AS INTEGER) AS run, count(*) AS pieces, round(sum(t1 - t0) * 100, 6) + 0.0 AS len, min(road_type) AS road_type FROM h GROUP BY 1, 2, 3"""))
def _(spark, sf):
    d = coloring.run_attributes(coloring.merge_runs(settle(colored(spark, sf), "pieces")))
    return d.selectExpr("line_id", "color", "run", "pieces", *r("len"), "road_type")


@query("merge_runs_across", with_layers("fx_streets", f"""
WITH {COLOR}, pe AS (SELECT c.street_id, c.color, c.t0, s.x1 + c.t0 * (s.x2 - s.x1) AS sx, s.y1 + c.t0 * (s.y2 - s.y1) AS sy, s.x1 + c.t1 * (s.x2 - s.x1) AS ex, s.y1 + c.t1 * (s.y2 - s.y1) AS ey
  FROM colored c JOIN fx_streets s USING (street_id)),
pb AS (SELECT *, CASE WHEN abs(lag(ex) OVER w - sx) <= 1e-6 AND abs(lag(ey) OVER w - sy) <= 1e-6 THEN 0 ELSE 1 END AS brk FROM pe WINDOW w AS (PARTITION BY color ORDER BY street_id, t0)),
pn AS (SELECT *, sum(brk) OVER (PARTITION BY color ORDER BY street_id, t0) AS joined FROM pb)
SELECT color, CAST(joined AS BIGINT) AS joined, count(DISTINCT street_id) AS lines FROM pn GROUP BY 1, 2"""))
def _(spark, sf):
    """Runs joined over the ends of lines."""
    runs = settle(coloring.merge_runs(settle(colored(spark, sf), "pieces")), "runs")
    return coloring.merge_across(runs).groupBy("color", "joined").agg(F.countDistinct("line_id").alias("lines"))


@query("merge_lines", with_layers("fx_streets", """
WITH RECURSIVE ends AS (SELECT street_id AS line, road_type, x1 AS x, y1 AS y, 0 AS e FROM fx_streets UNION ALL SELECT street_id, road_type, x2, y2, 1 FROM fx_streets),
meet AS (SELECT min((line, e)) AS p, max((line, e)) AS q FROM ends GROUP BY road_type, x, y HAVING count(*) = 2 AND min(line) <> max(line)),
step AS (SELECT p[1] AS line, 1 - p[2] AS dir, q[1] AS nline, q[2] AS ndir FROM meet UNION ALL SELECT q[1], 1 - q[2], p[1], p[2] FROM meet),
arc AS (SELECT street_id AS line, d AS dir FROM fx_streets, (VALUES (0), (1)) v(d)),
start AS (SELECT line, dir FROM arc ANTI JOIN (SELECT nline AS line, ndir AS dir FROM step) USING (line, dir)),
walk AS (SELECT line AS l0, dir AS d0, line, dir, 0 AS pos FROM start
  UNION ALL SELECT l0, d0, nline, ndir, pos + 1 FROM walk JOIN step USING (line, dir)),
ring AS (SELECT line AS l0, line, dir, 0 AS pos FROM arc ANTI JOIN walk USING (line, dir) WHERE dir = 0
  UNION ALL SELECT l0, nline, ndir, pos + 1 FROM ring JOIN step USING (line, dir) WHERE nline <> l0),
tail AS (SELECT l0, d0, max_by((line, dir), pos) AS last FROM walk GROUP BY 1, 2),
best AS (SELECT a.l0, a.d0, least(a.l0, a.last[1]) AS chain FROM tail a JOIN tail b ON b.l0 = a.last[1] AND b.d0 = 1 - a.last[2] WHERE a.last > b.last),
pos AS (SELECT chain, line, dir, pos FROM walk JOIN best USING (l0, d0)
  UNION ALL SELECT l0, line, dir, pos FROM ring WHERE l0 IN (SELECT l0 FROM ring GROUP BY 1 HAVING min(line) = l0))
SELECT chain AS chain_id, road_type, CAST(pos AS INTEGER) AS seg_idx, CASE pos.dir WHEN 0 THEN x1 ELSE x2 END AS x1, CASE pos.dir WHEN 0 THEN y1 ELSE y2 END AS y1,
  CASE pos.dir WHEN 0 THEN x2 ELSE x1 END AS x2, CASE pos.dir WHEN 0 THEN y2 ELSE y1 END AS y2, line AS line_id FROM pos JOIN fx_streets ON street_id = line"""))
def _(spark, sf):
    """Streets of one type joined through nodes where only two of their ends meet."""
    d = chains.merge_lines(street_segments(spark, sf))
    return d.select("chain_id", "road_type", "seg_idx", "x1", "y1", "x2", "y2", "line_id")


@query("merge_lines_groups", with_layers("fx_streets", """
WITH RECURSIVE ends AS (SELECT street_id, road_type, x1 AS x, y1 AS y FROM fx_streets UNION ALL SELECT street_id, road_type, x2, y2 FROM fx_streets),
link AS (SELECT min(street_id) AS u, max(street_id) AS v FROM ends GROUP BY road_type, x, y HAVING count(*) = 2),
both_ AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
cc(node, comp) USING KEY (node) AS (SELECT street_id, street_id FROM fx_streets UNION
  SELECT node, min(comp) FROM (SELECT e.v AS node, cc.comp FROM cc JOIN both_ e ON e.u = cc.node JOIN recurring.cc AS old ON old.node = e.v WHERE cc.comp < old.comp) GROUP BY 1),
sz AS (SELECT comp, count(*) AS n FROM cc GROUP BY 1)
SELECT n AS lines, count(*) AS chains FROM sz GROUP BY 1"""))
def _(spark, sf):
    """How many chains have how many lines."""
    d = chains.merge_lines(street_segments(spark, sf)).groupBy("road_type", "chain_id").agg(F.expr("count(1) AS lines"))
    return d.groupBy("lines").agg(F.expr("count(1) AS chains"))


@query("group_lines_by_type", with_layers("fx_streets fx_paths", f"""
WITH {PATH_SEGS}, {NETWORK} SELECT road_type, count(DISTINCT line_id) AS lines, count(*) AS segs, round(sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))), 3) + 0.0 AS len FROM net GROUP BY 1"""))
def _(spark, sf):
    d = network_segments(spark, sf).groupBy("road_type", "line_id").agg(F.expr("count(1) AS n"), F.expr("sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) AS l"))
    return d.groupBy("road_type").agg(F.expr("count(1) AS lines"), F.expr("sum(n) AS segs"), F.expr("round(sum(l), 3) + 0D AS len"))


@query("simplify_lines", with_layers("fx_tracks", """
WITH RECURSIVE span AS (SELECT line_id, min(idx) AS a, max(idx) AS b FROM fx_tracks GROUP BY 1
  UNION ALL SELECT line_id, unnest([a, m]), unnest([m, b]) FROM (
    SELECT line_id, a, b, max(far) AS far, min_by(idx, (-far, idx)) AS m FROM (
      SELECT line_id, a, b, idx, pow(ax + t * (bx - ax) - x, 2) + pow(ay + t * (by_ - ay) - y, 2) AS far FROM (
        SELECT s.line_id, s.a, s.b, v.idx, v.x, v.y, p.x AS ax, p.y AS ay, q.x AS bx, q.y AS by_,
          coalesce(greatest(0, least(1, ((v.x - p.x) * (q.x - p.x) + (v.y - p.y) * (q.y - p.y)) / nullif(pow(q.x - p.x, 2) + pow(q.y - p.y, 2), 0))), 0) AS t
        FROM span s JOIN fx_tracks v ON v.line_id = s.line_id AND v.idx > s.a AND v.idx < s.b
          JOIN fx_tracks p ON p.line_id = s.line_id AND p.idx = s.a JOIN fx_tracks q ON q.line_id = s.line_id AND q.idx = s.b))
    GROUP BY 1, 2, 3) WHERE far > 64),
kept AS (SELECT line_id, a AS idx FROM span UNION SELECT line_id, b FROM span)
SELECT line_id, idx, x, y FROM kept JOIN fx_tracks USING (line_id, idx)"""))
def _(spark, sf):
    """Event tracks without the vertices that deviate by 8 or less."""
    return simplify.simplify_lines(layer(spark, sf, "fx_tracks"))


@query("simplify_first_split", with_layers("fx_tracks", """
WITH ends AS (SELECT line_id, min_by(x, idx) AS ax, min_by(y, idx) AS ay, max_by(x, idx) AS bx, max_by(y, idx) AS by_, max(idx) AS n FROM fx_tracks GROUP BY 1),
d AS (SELECT line_id, idx, x, y, ax, ay, bx, by_, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) AS t FROM fx_tracks JOIN ends USING (line_id) WHERE idx > 0 AND idx < n),
o AS (SELECT line_id, idx, pow(ax + t * (bx - ax) - x, 2) + pow(ay + t * (by_ - ay) - y, 2) AS far FROM d)
SELECT line_id, round(sqrt(max(far)), 6) + 0.0 AS far, CASE WHEN max(far) > 64 THEN min_by(idx, (-far, idx)) END AS idx FROM o GROUP BY 1"""))
def _(spark, sf):
    """The first vertex each track keeps between its ends; the later rounds repeat this per span."""
    v = layer(spark, sf, "fx_tracks")
    ends = v.groupBy("line_id").agg(F.expr("min_by(struct(idx, x, y), idx) AS a"), F.expr("max_by(struct(idx, x, y), idx) AS b"))
    d = simplify.deviation(v.join(ends, "line_id").filter("idx > a.idx AND idx < b.idx"))
    top = simplify.farthest(d, ["line_id"])
    return top.selectExpr("line_id", "round(sqrt(far), 6) + 0D AS far", "CASE WHEN far > 64 THEN m.idx END AS idx")


@query("dissolve_lines", with_layers("fx_streets", """
WITH RECURSIVE ends AS (SELECT street_id, road_type, frc % 2 AS half, x1 AS x, y1 AS y FROM fx_streets UNION ALL SELECT street_id, road_type, frc % 2, x2, y2 FROM fx_streets),
low AS (SELECT road_type, half, x, y, min(street_id) AS m FROM ends GROUP BY 1, 2, 3, 4),
link AS (SELECT street_id AS u, m AS v FROM ends JOIN low USING (road_type, half, x, y) WHERE street_id <> m),
both_ AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
cc(node, comp) USING KEY (node) AS (SELECT street_id, street_id FROM fx_streets UNION
  SELECT node, min(comp) FROM (SELECT e.v AS node, cc.comp FROM cc JOIN both_ e ON e.u = cc.node JOIN recurring.cc AS old ON old.node = e.v WHERE cc.comp < old.comp) GROUP BY 1)
SELECT comp AS component, count(*) AS n_lines, min(road_type) AS road_type, min_by(frc, node) AS frc FROM cc JOIN fx_streets ON street_id = node GROUP BY 1"""))
def _(spark, sf):
    segs = street_segments(spark, sf)
    attrs = layer(spark, sf, "fx_streets").selectExpr("street_id AS line_id", "road_type", "frc % 2 AS half", "frc")
    merged, _lines = dissolve.dissolve_lines(segs, attrs, ["road_type", "half"])
    return merged.select("component", "n_lines", "road_type", "frc")


@query("adjacency_join", with_layers("fx_streets", f"""
WITH {MINOR} SELECT a.u AS node, count(*) AS steps, count(DISTINCT b.v) AS reached FROM both_ a JOIN both_ b ON b.u = a.v GROUP BY 1"""))
def _(spark, sf):
    """Nodes reached by two steps along minor streets."""
    num = lambda x, y: f"CAST({x} + {y} * 10000 AS BIGINT)"
    e = minor_streets(spark, sf).selectExpr(
        f"inline(array(struct({num('x1', 'y1')} AS u, {num('x2', 'y2')} AS v), struct({num('x2', 'y2')} AS u, {num('x1', 'y1')} AS v)))")
    d = salted_join(e.selectExpr("u AS node", "v AS mid"), e.selectExpr("u AS mid", "v"), ["mid"])
    d = d.groupBy("node", "v").agg(F.expr("count(1) AS n"))
    return d.groupBy("node").agg(F.expr("sum(n) AS steps"), F.expr("count(1) AS reached"))
