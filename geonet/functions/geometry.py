"""Closed-form plane geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS = 6371008.8  # metres, mean radius
MERCATOR_RADIUS = 6378137.0
EPS = 1e-12


def _c(value: Column | str | float) -> Column:
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else F.lit(value)


def let(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns, given as SQL expressions, that later filters and projections read as values.

    A plain ``withColumns`` lets the optimizer copy the expressions into every later predicate, which
    multiplies long arithmetic; a one-element generator keeps them where they are, still inside
    whole-stage codegen.
    """
    row = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return df.selectExpr("*", f"inline(array(struct({row})))")


def rounded(value: Column | str, digits: int) -> Column:
    """Rounded value, never a negative zero."""
    return F.round(_c(value), digits) + F.lit(0.0)


def r6(value: Column | str) -> Column:
    return rounded(value, 6)


def extent_filter(extent: tuple[float, float, float, float], pad: float = 50.0, x: str = "x", y: str = "y") -> Column:
    """Points in an extent (minx, miny, maxx, maxy) grown by ``pad``; an extent without area is an error."""
    minx, miny, maxx, maxy = extent
    if minx == maxx or miny == maxy:
        raise ValueError(f"extent without area: {extent}")
    return F.col(x).between(minx - pad, maxx + pad) & F.col(y).between(miny - pad, maxy + pad)


def snap_key(value: Column | str, tol: float) -> Column:
    """Grid position of a coordinate, halves rounded up."""
    return F.floor(_c(value) / F.lit(float(tol)) + F.lit(0.5))


def length(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    dx, dy = _c(x2) - _c(x1), _c(y2) - _c(y1)
    return F.sqrt(dx * dx + dy * dy)


def mercator_lon(x: Column | str) -> Column:
    return F.degrees(_c(x) / F.lit(MERCATOR_RADIUS))


def mercator_lat(y: Column | str) -> Column:
    return F.degrees(2 * F.atan(F.exp(_c(y) / F.lit(MERCATOR_RADIUS))) - F.lit(3.141592653589793 / 2))


def geodesic_length(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    """Great-circle metres between two web-mercator points."""
    lat1, lat2 = F.radians(mercator_lat(y1)), F.radians(mercator_lat(y2))
    dlat, dlon = (lat2 - lat1) / 2, (_c(x2) - _c(x1)) / F.lit(MERCATOR_RADIUS) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.sin(dlon) * F.sin(dlon) * F.cos(lat1) * F.cos(lat2)
    return 2 * F.lit(EARTH_RADIUS) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def coords_equal(x1, y1, x2, y2, eps: float = 1e-9) -> Column:
    return (F.abs(_c(x1) - _c(x2)) <= eps) & (F.abs(_c(y1) - _c(y2)) <= eps)


def project(px, py, x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    """Unclamped position of a point along a segment; null for a segment without length."""
    dx, dy = _c(x2) - _c(x1), _c(y2) - _c(y1)
    len2 = dx * dx + dy * dy
    return ((_c(px) - _c(x1)) * dx + (_c(py) - _c(y1)) * dy) / F.nullif(len2, F.lit(0.0))


def closest_t(px, py, x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    """Clamped position; 0 for a segment without length."""
    t = F.coalesce(project(px, py, x1, y1, x2, y2), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def along(a, b, t) -> Column:
    return _c(a) + _c(t) * (_c(b) - _c(a))


def add_capsule_interval(df: DataFrame, a: tuple, b: tuple, r: str | float, lo: str = "t0", hi: str = "t1") -> DataFrame:
    """Add the part [lo, hi] of segment ``a`` within ``r`` of segment ``b``; null where there is none.

    ``a`` and ``b`` name four coordinate columns.  In the frame of ``b`` the point of ``a`` at t is
    (u + t du, v + t dv).  The set within r of ``b`` is convex, so the answer is one interval: the
    hull of the parts in the strip beside ``b`` and in the discs at its two ends.
    """
    (ax, ay, ax2, ay2), (bx, by, bx2, by2) = a, b
    r = f"CAST({r} AS DOUBLE)"
    d = let(df, _bl=f"sqrt(({bx2}-{bx})*({bx2}-{bx}) + ({by2}-{by})*({by2}-{by}))")
    d = let(d, _ex=f"CASE WHEN _bl > 0 THEN ({bx2}-{bx}) / _bl ELSE 1D END",
            _ey=f"CASE WHEN _bl > 0 THEN ({by2}-{by}) / _bl ELSE 0D END")
    d = let(d, _u=f"({ax}-{bx})*_ex + ({ay}-{by})*_ey", _du=f"({ax2}-{ax})*_ex + ({ay2}-{ay})*_ey",
            _v=f"({ay}-{by})*_ex - ({ax}-{bx})*_ey", _dv=f"({ay2}-{ay})*_ex - ({ax2}-{ax})*_ey")
    # Squared speed, and per end disc: half of the linear term and the constant term.
    d = let(d, _ee="_du*_du + _dv*_dv", _bp="_u*_du + _v*_dv", _bq="(_u-_bl)*_du + _v*_dv",
            _cp=f"_u*_u + _v*_v - {r}*{r}", _cq=f"(_u-_bl)*(_u-_bl) + _v*_v - {r}*{r}")

    def strip(p: str, q: str, low: str, high: str) -> tuple[str, str]:
        """t range with low <= p + t q <= high; (1, 0) marks an empty range."""
        inside = f"{p} BETWEEN {low} AND {high}"
        return (f"CASE WHEN abs({q}) >= {EPS} THEN least(({low}-{p})/{q}, ({high}-{p})/{q}) WHEN {inside} THEN 0D ELSE 1D END",
                f"CASE WHEN abs({q}) >= {EPS} THEN greatest(({low}-{p})/{q}, ({high}-{p})/{q}) WHEN {inside} THEN 1D ELSE 0D END")

    def disc(half: str, const: str) -> tuple[str, str]:
        rad = f"({half}*{half} - _ee*{const})"
        return (f"CASE WHEN _ee >= {EPS} AND {rad} >= 0 THEN greatest(0D, (-{half} - sqrt({rad})) / _ee)"
                f" WHEN _ee < {EPS} AND {const} <= 0 THEN 0D ELSE 1D END",
                f"CASE WHEN _ee >= {EPS} AND {rad} >= 0 THEN least(1D, (-{half} + sqrt({rad})) / _ee)"
                f" WHEN _ee < {EPS} AND {const} <= 0 THEN 1D ELSE 0D END")

    (ulo, uhi), (vlo, vhi) = strip("_u", "_du", "0D", "_bl"), strip("_v", "_dv", f"-{r}", r)
    (plo, phi), (qlo, qhi) = disc("_bp", "_cp"), disc("_bq", "_cq")
    d = let(d, _sl=f"greatest(0D, {ulo}, {vlo})", _sh=f"least(1D, {uhi}, {vhi})", _pl=plo, _ph=phi, _ql=qlo, _qh=qhi)
    first = ", ".join(f"CASE WHEN _{n}l <= _{n}h THEN _{n}l END" for n in "spq")
    last = ", ".join(f"CASE WHEN _{n}l <= _{n}h THEN _{n}h END" for n in "spq")
    return let(d, **{lo: f"least({first})", hi: f"greatest({last})"}).select(*df.columns, lo, hi)
