"""Box join on a uniform grid, the base of every spatial operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_CELL_ROWS = 100_000


def _cells(df: DataFrame, box: Sequence[str], cell: float) -> DataFrame:
    minx, miny, maxx, maxy = box
    d = df.selectExpr("*", f"explode(sequence(floor({minx}/{cell}D), floor({maxx}/{cell}D))) AS _cx")
    return d.selectExpr("*", f"explode(sequence(floor({miny}/{cell}D), floor({maxy}/{cell}D))) AS _cy")


def _sub(value: str, origin: str, cell: float) -> str:
    """Sub-cell of a value inside its hot cell."""
    return f"CAST(greatest(0, least(_split - 1, floor(({value} - {origin}*{cell}D) * _split / {cell}D))) AS INT)"


def _refine(df: DataFrame, box: Sequence[str], hot: DataFrame, on: Sequence[str], cell: float) -> DataFrame:
    """Divide the hot cells into split x split sub-cells; other cells stay whole.

    Every hot cell holds many rows, so their list is short; sent to the rows it saves moving all of them.
    """
    minx, miny, maxx, maxy = box
    d = df.join(F.broadcast(hot), list(on), "left").selectExpr(*df.columns, "coalesce(_split, 1) AS _split")
    d = d.selectExpr("*", f"explode(sequence({_sub(minx, '_cx', cell)}, {_sub(maxx, '_cx', cell)})) AS _sx")
    return d.selectExpr("*", f"explode(sequence({_sub(miny, '_cy', cell)}, {_sub(maxy, '_cy', cell)})) AS _sy")


def box_pairs(a: DataFrame, b: DataFrame, a_box: Sequence[str], b_box: Sequence[str], cell: float,
              extra: str | None = None, hot_rows: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """All pairs whose boxes (minx, miny, maxx, maxy columns) meet, each pair once.

    Boxes are exploded to the cells they touch and equi-joined on the cell.  A pair is kept only
    in the cell that holds the larger of the two lower-left corners, so no ``distinct`` follows.
    Column names of ``a`` and ``b`` must differ, except for the columns ``by``, which must be equal.
    ``extra`` is a further SQL condition.

    Cells above ``hot_rows`` rows on either side are divided further, so that a dense spot of small boxes
    is not compared all against all.  Sub-cells stay as wide as the boxes of the cell (by their root mean
    square), which bounds the copies; a dense spot of wide boxes, all of which do meet, is left to the
    adaptive skew join.
    """
    ca, cb = _cells(a, a_box, cell), _cells(b, b_box, cell)
    gx, gy = f"greatest({a_box[0]}, {b_box[0]})", f"greatest({a_box[1]}, {b_box[1]})"
    on = ["_cx", "_cy", *by]
    tests = [f"{a_box[0]} <= {b_box[2]}", f"{b_box[0]} <= {a_box[2]}", f"{a_box[1]} <= {b_box[3]}",
             f"{b_box[1]} <= {a_box[3]}", f"floor({gx}/{cell}D) = _cx", f"floor({gy}/{cell}D) = _cy"]
    hot_rows = hot_rows or HOT_CELL_ROWS

    def load(d: DataFrame, box: Sequence[str]) -> DataFrame:
        wide = f"greatest({box[2]} - {box[0]}, {box[3]} - {box[1]})"
        return d.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.expr(f"sum({wide} * {wide})").alias("_w"))

    counts = load(ca, a_box).unionByName(load(cb, b_box)).groupBy(*on).agg(
        F.max("_n").alias("_n"), F.expr("sqrt(sum(_w) / sum(_n))").alias("_w")).filter(F.col("_n") > hot_rows)
    hot = counts.selectExpr(*on, f"CAST(greatest(1D, least(ceil(sqrt(4D * _n / {hot_rows})), floor({cell}D / greatest(_w, {cell}D / 1e6)))) AS INT) AS _split")
    hot = hot.filter("_split > 1")
    ca, cb = _refine(ca, a_box, hot, on, cell), _refine(cb, b_box, hot, on, cell).drop("_split")
    on = [*on, "_sx", "_sy"]
    tests += [f"_sx = {_sub(gx, '_cx', cell)}", f"_sy = {_sub(gy, '_cy', cell)}"]
    if extra:
        tests.append(extra)
    # Exploded rows look as small as their table; a broadcast would also make the work jump where a table outgrows it.
    return ca.join(cb.hint("merge"), on).filter(" AND ".join(tests)).select(*a.columns, *[c for c in b.columns if c not in by])


def any_box_pairs(a: DataFrame, b: DataFrame, a_box: Sequence[str], b_box: Sequence[str], cell: float) -> DataFrame:
    """``box_pairs`` for boxes of any size, from a house to a continent.

    A box lives on the grid level whose cells are at least its size, hence in at most four cells, and is
    also entered on the coarser levels in use.  A pair meets on the coarser of its two levels: boxes of a at
    home meet boxes of b at home or passing through, and boxes of a passing through meet those of b at home,
    so that two small boxes never meet on the level of a large one.
    """
    def home(box: Sequence[str]) -> str:
        minx, miny, maxx, maxy = box
        return f"CAST(greatest(0, ceil(log2(greatest({maxx} - {minx}, {maxy} - {miny}, {cell}D) / {cell}D))) AS INT)"

    top = max(d.agg(F.expr(f"max({home(box)})")).first()[0] or 0 for d, box in ((a, a_box), (b, b_box)))

    def entered(df: DataFrame, box: Sequence[str], flag: str) -> DataFrame:
        minx, miny, maxx, maxy = box
        d = df.selectExpr("*", f"{home(box)} AS _home").selectExpr("*", f"explode(sequence(_home, {top})) AS _l")
        d = d.selectExpr(*df.columns, "_l", f"_l = _home AS {flag}", f"{cell}D * shiftleft(1L, _l) AS {flag}s")
        d = d.selectExpr("*", f"explode(sequence(floor({minx}/{flag}s), floor({maxx}/{flag}s))) AS _cx")
        return d.selectExpr("*", f"explode(sequence(floor({miny}/{flag}s), floor({maxy}/{flag}s))) AS _cy")

    ea, eb, on = entered(a, a_box, "_ah"), entered(b, b_box, "_bh"), ["_l", "_cx", "_cy"]
    d = ea.filter("_ah").join(eb, on).unionByName(ea.filter("NOT _ah").join(eb.filter("_bh"), on))
    tests = [f"{a_box[0]} <= {b_box[2]}", f"{b_box[0]} <= {a_box[2]}", f"{a_box[1]} <= {b_box[3]}", f"{b_box[1]} <= {a_box[3]}",
             f"floor(greatest({a_box[0]}, {b_box[0]}) / _ahs) = _cx", f"floor(greatest({a_box[1]}, {b_box[1]}) / _ahs) = _cy"]
    return d.filter(" AND ".join(tests)).select(*a.columns, *b.columns)


def with_box(df: DataFrame, prefix: str = "", grow: str | float = 0.0,
             names: Sequence[str] = ("x1", "y1", "x2", "y2")) -> tuple[DataFrame, list[str]]:
    """Add the box of a segment, grown on all sides, and return the names of its columns."""
    x1, y1, x2, y2 = names
    g = f"CAST({grow} AS DOUBLE)"
    box = [prefix + s for s in ("minx", "miny", "maxx", "maxy")]
    exprs = [f"least({x1},{x2}) - {g}", f"least({y1},{y2}) - {g}", f"greatest({x1},{x2}) + {g}", f"greatest({y1},{y2}) + {g}"]
    return df.selectExpr("*", *[f"{e} AS {n}" for e, n in zip(exprs, box)]), box
