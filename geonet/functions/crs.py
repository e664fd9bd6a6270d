"""Coordinate system changes as column expressions.

4326 <-> 3857 is the closed form.  4326 <-> 31256 / 31257 is the Austrian grid: a 7-parameter
datum shift to the Bessel ellipsoid and a transverse Mercator projection by its Krueger series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from geonet.functions.geometry import MERCATOR_RADIUS, mercator_lat, mercator_lon

# Ellipsoids as (semi-major axis, inverse flattening).
WGS84 = (6378137.0, 298.257223563)
BESSEL = (6377397.155, 299.1528128)
# Shift from Bessel to WGS84 (metres, arc seconds, parts per million).
SHIFT = (577.326, 90.129, 463.919, 5.137, 1.474, 5.297, 2.4232)
# Central meridian, false easting, false northing per grid code.
GRIDS = {31256: (16.0 + 1.0 / 3.0, 0.0, -5000000.0), 31257: (10.0 + 1.0 / 3.0, 150000.0, -5000000.0)}


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    half = F.radians(lat) / 2 + F.lit(math.pi / 4)
    return F.radians(lon) * MERCATOR_RADIUS, F.log(F.tan(half)) * MERCATOR_RADIUS


def _third_flattening(ellipsoid) -> tuple[float, float, float]:
    a, inv = ellipsoid
    f = 1 / inv
    n = f / (2 - f)
    return a, f, n


def _geocentric(df: DataFrame, lon: str, lat: str, ellipsoid, height: str | None = None) -> DataFrame:
    a, f, _ = _third_flattening(ellipsoid)
    e2 = f * (2 - f)
    phi, lam = F.radians(F.col(lat)), F.radians(F.col(lon))
    h = F.col(height) if height else F.lit(0.0)
    d = df.withColumn("_nn", F.lit(a) / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi)))
    nn = F.col("_nn")
    return d.withColumns({
        "_gx": (nn + h) * F.cos(phi) * F.cos(lam),
        "_gy": (nn + h) * F.cos(phi) * F.sin(lam),
        "_gz": (nn * (1 - e2) + h) * F.sin(phi),
    })


def _shift(df: DataFrame, back: bool) -> DataFrame:
    """Move geocentric coordinates from Bessel to WGS84, or ``back``."""
    tx, ty, tz, rx, ry, rz, ppm = SHIFT
    rx, ry, rz = (math.radians(v / 3600) for v in (rx, ry, rz))
    m = 1 + ppm * 1e-6
    x, y, z = F.col("_gx"), F.col("_gy"), F.col("_gz")
    if back:
        x, y, z = (x - tx) / m, (y - ty) / m, (z - tz) / m
        return df.withColumns({"_gx": x + rz * y - ry * z, "_gy": -rz * x + y + rx * z, "_gz": ry * x - rx * y + z})
    return df.withColumns({
        "_gx": m * (x - rz * y + ry * z) + tx,
        "_gy": m * (rz * x + y - rx * z) + ty,
        "_gz": m * (-ry * x + rx * y + z) + tz,
    })


def _geographic(df: DataFrame, lon: str, lat: str, ellipsoid) -> DataFrame:
    """Latitude and longitude of geocentric coordinates (four fixed-point rounds, below 1e-12 degrees)."""
    a, f, _ = _third_flattening(ellipsoid)
    e2 = f * (2 - f)
    d = df.withColumn("_gp", F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy")))
    d = d.withColumn("_phi", F.atan2(F.col("_gz"), F.col("_gp") * (1 - e2)))
    for _ in range(4):
        s = F.sin(F.col("_phi"))
        d = d.withColumn("_nn", F.lit(a) / F.sqrt(1 - e2 * s * s))
        d = d.withColumn("_phi", F.atan2(F.col("_gz") + e2 * F.col("_nn") * F.sin(F.col("_phi")), F.col("_gp")))
    return d.withColumns({lon: F.degrees(F.atan2(F.col("_gy"), F.col("_gx"))), lat: F.degrees(F.col("_phi"))})


def _series(n: float) -> tuple[float, list[float], list[float]]:
    """Rectifying radius factor and the forward and inverse Krueger coefficients to order four."""
    radius = (1 + n**2 / 4 + n**4 / 64) / (1 + n)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
             13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
             61 * n**3 / 240 - 103 * n**4 / 140,
             49561 * n**4 / 161280]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280]
    return radius, alpha, beta


def _to_grid(df: DataFrame, x: str, y: str, code: int) -> DataFrame:
    lon0, east, north = GRIDS[code]
    a, f, n = _third_flattening(BESSEL)
    e = math.sqrt(f * (2 - f))
    radius, alpha, _ = _series(n)
    d = _shift(_geocentric(df, x, y, WGS84), back=True)
    d = _geographic(d, "_lon", "_lat", BESSEL)
    s, dl = F.sin(F.radians(F.col("_lat"))), F.radians(F.col("_lon") - lon0)
    atanh = lambda v: F.lit(0.5) * F.log((1 + v) / (1 - v))
    d = d.withColumn("_t", F.sinh(atanh(s) - e * atanh(e * s)))
    d = d.withColumns({
        "_xi": F.atan2(F.col("_t"), F.cos(dl)),
        "_eta": F.asinh(F.sin(dl) / F.sqrt(F.col("_t") * F.col("_t") + F.cos(dl) * F.cos(dl))),
    })
    xi, eta = F.col("_xi"), F.col("_eta")
    dx = sum((F.lit(c) * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, c in enumerate(alpha, 1)), eta)
    dy = sum((F.lit(c) * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, c in enumerate(alpha, 1)), xi)
    return d.withColumns({x: east + a * radius * dx, y: north + a * radius * dy}).select(*df.columns)


def _from_grid(df: DataFrame, x: str, y: str, code: int) -> DataFrame:
    lon0, east, north = GRIDS[code]
    a, f, n = _third_flattening(BESSEL)
    e2 = f * (2 - f)
    radius, _, beta = _series(n)
    d = df.withColumns({"_xi": (F.col(y) - north) / (a * radius), "_eta": (F.col(x) - east) / (a * radius)})
    xi, eta = F.col("_xi"), F.col("_eta")
    d = d.withColumns({
        "_xp": sum((F.lit(-c) * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, c in enumerate(beta, 1)), xi),
        "_ep": sum((F.lit(-c) * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, c in enumerate(beta, 1)), eta),
    })
    xp, ep = F.col("_xp"), F.col("_ep")
    d = d.withColumns({
        "_lon": F.lit(lon0) + F.degrees(F.atan2(F.sinh(ep), F.cos(xp))),
        "_tc": F.sin(xp) / F.sqrt(F.sinh(ep) * F.sinh(ep) + F.cos(xp) * F.cos(xp)),
    })
    # Newton steps from conformal to geographic latitude, on the tangent.
    d = d.withColumn("_t", F.col("_tc"))
    e = math.sqrt(e2)
    atanh = lambda v: F.lit(0.5) * F.log((1 + v) / (1 - v))
    for _ in range(4):
        t = F.col("_t")
        d = d.withColumn("_sg", F.sinh(e * atanh(e * t / F.sqrt(1 + t * t))))
        sg = F.col("_sg")
        d = d.withColumn("_ti", t * F.sqrt(1 + sg * sg) - sg * F.sqrt(1 + t * t))
        ti = F.col("_ti")
        step = (F.col("_tc") - ti) / F.sqrt(1 + ti * ti) * (1 + (1 - e2) * t * t) / ((1 - e2) * F.sqrt(1 + t * t))
        d = d.withColumn("_t", t + step)
    d = d.withColumn("_lat", F.degrees(F.atan(F.col("_t"))))
    d = _shift(_geocentric(d, "_lon", "_lat", BESSEL), back=False)
    return _geographic(d, x, y, WGS84).select(*df.columns)


def reproject(df: DataFrame, source: int, target: int, x: str = "x", y: str = "y") -> DataFrame:
    """Change the coordinate system of two coordinate columns in place."""
    known = {4326, 3857, *GRIDS}
    if {source, target} - known:
        raise ValueError(f"unknown coordinate system: {sorted({source, target} - known)}")
    if source == target:
        return df
    d = df
    if source == 3857:
        d = d.withColumns({x: mercator_lon(x), y: mercator_lat(y)})
    elif source in GRIDS:
        d = _from_grid(d, x, y, source)
    if target == 3857:
        mx, my = to_mercator(F.col(x), F.col(y))
        d = d.withColumns({x: mx, y: my})
    elif target in GRIDS:
        d = _to_grid(d, x, y, target)
    return d
