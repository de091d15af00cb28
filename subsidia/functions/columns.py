"""Column expressions: the row-level functions of displacement validation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values fixed by the products: metres of a degree of latitude, days of a year, radius for great circles.
KM_PER_DEGREE = 111.195
YEAR_DAYS = 365.25
EARTH_RADIUS_KM = 6378.0


def no_data(value: Column) -> Column:
    """NULL for both kinds of no data, NaN and 0. Applied once, at ingest; NaN must not survive it."""
    return F.when(F.isnan(value) | (value == 0), None).otherwise(value)


def phase_to_metres(value: Column, wavelength: Column | float) -> Column:
    return value * (-F.lit(1.0) * wavelength / (4 * math.pi))


def metres_to_phase(value: Column, wavelength: Column | float) -> Column:
    return value * (F.lit(-4 * math.pi) / wavelength)


def displacement_metres(value: Column, version: Column, wavelength: float) -> Column:
    """Metres, whichever unit the version stores: phase up to 0.3, metres from 0.4 on."""
    return F.when(version_key(version) < version_key(F.lit("0.4")), phase_to_metres(value, F.lit(wavelength))).otherwise(value)


def version_key(version: Column) -> Column:
    """A version as an array of integers, so that 0.10 is above 0.9."""
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))


def coherence_layer(version: Column) -> Column:
    """The name of the coherence layer in a version's products."""
    key = version_key(version)
    return F.when(key >= version_key(F.lit("0.8")), "estimated_phase_quality").when(key >= version_key(F.lit("0.7")), "estimated_spatial_coherence").otherwise("interferometric_correlation")


def fractional_years(date: Column, first: Column) -> Column:
    return F.datediff(date, first) / F.lit(YEAR_DAYS)


def pixel_centre(index: Column, first: Column, step: Column, truncated: bool = False) -> Column:
    """Coordinate of a pixel's centre; ``truncated`` cuts first and step to whole numbers, as metric grids have it."""
    if truncated:
        first, step = first.cast("long"), step.cast("long")
    return first + (index + F.lit(0.5)) * step


def pixel_index(coordinate: Column, first: Column, step: Column) -> Column:
    """Index of the pixel that holds a coordinate, cut towards zero."""
    return ((coordinate - first) / step).cast("int")


def local_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Kilometres east and north of a centre on a plane."""
    return (lon - lon0) * KM_PER_DEGREE * F.cos(F.radians(lat0)), (lat - lat0) * KM_PER_DEGREE


def plane_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) / 1000


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))


def utm(lat: Column, lon: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing on WGS84 by Krueger's series (fourth order in the third flattening)."""
    f, a, k0 = 1 / 298.257223563, 6378137.0, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + sum((c * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, c in enumerate(alpha, 1)), F.lit(0.0))
    north = xi + sum((c * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, c in enumerate(alpha, 1)), F.lit(0.0))
    return 500000 + k0 * radius * east, k0 * radius * north + F.when(lat < 0, 1e7).otherwise(0.0)


def latlon(easting: Column, northing: Column, zone: Column, south: Column | bool = False) -> tuple[Column, Column]:
    """The inverse of ``utm``: latitude and longitude in degrees, by the inverse series and one fixed-point step for the latitude."""
    f, a, k0 = 1 / 298.257223563, 6378137.0, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    south = F.lit(south) if isinstance(south, bool) else south
    x = (northing - F.when(south, 1e7).otherwise(0.0)) / (k0 * radius)
    e = (easting - 500000) / (k0 * radius)
    xi = x - sum((b * F.sin(2 * j * x) * F.cosh(2 * j * e) for j, b in enumerate(beta, 1)), F.lit(0.0))
    eta = e - sum((b * F.cos(2 * j * x) * F.sinh(2 * j * e) for j, b in enumerate(beta, 1)), F.lit(0.0))
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi + sum((d * F.sin(2 * j * chi) for j, d in enumerate(delta, 1)), F.lit(0.0))
    return F.degrees(lat), F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + (zone * 6 - 183)


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS84 ellipsoid by Lambert's formula: within 10 m over thousands of kilometres, millimetres over tens."""
    a, f = 6378.137, 1 / 298.257223563
    reduced = lambda lat: F.atan((1 - f) * F.tan(F.radians(lat)))
    b1, b2 = reduced(lat1), reduced(lat2)
    h = F.pow(F.sin((b2 - b1) / 2), 2) + F.cos(b1) * F.cos(b2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    s = 2 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    x = (s - F.sin(s)) * F.pow(F.sin(p), 2) * F.pow(F.cos(q), 2) / F.pow(F.cos(s / 2), 2)
    y = (s + F.sin(s)) * F.pow(F.cos(p), 2) * F.pow(F.sin(q), 2) / F.pow(F.sin(s / 2), 2)
    return F.when(h == 0, 0.0).otherwise(a * (s - f / 2 * (x + y)))


def geodesic_inverse_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, a: float = 6378.137, flattening: float = 1 / 298.257223563, steps: int = 24) -> Column:
    """Distance on an ellipsoid (WGS84 unless given) by Vincenty's iteration: within a millimetre.

    The difference of longitudes on the auxiliary sphere is a fixed point, folded over ``steps`` rounds inside the expression. Between
    almost opposite points of the equator the rounds don't settle; there the result is NULL.
    """
    f = flattening
    reduced = lambda lat: F.atan((1 - f) * F.tan(F.radians(lat)))
    u1, u2 = reduced(lat1), reduced(lat2)
    turn = F.radians(F.pmod(lon2 - lon1 + 180, F.lit(360.0)) - 180)
    given = F.struct(F.sin(u1).alias("s1"), F.cos(u1).alias("c1"), F.sin(u2).alias("s2"), F.cos(u2).alias("c2"), turn.alias("turn"), turn.alias("at"), turn.alias("last"))

    def sphere(p):
        across, along = p["c2"] * F.sin(p["at"]), p["c1"] * p["s2"] - p["s1"] * p["c2"] * F.cos(p["at"])
        sine, cosine = F.sqrt(across * across + along * along), p["s1"] * p["s2"] + p["c1"] * p["c2"] * F.cos(p["at"])
        azimuth = F.when(sine > 0, p["c1"] * p["c2"] * F.sin(p["at"]) / sine).otherwise(0.0)
        return sine, cosine, azimuth

    def middle(m, p):
        """The cosine of twice the middle's arc; 0 along the equator."""
        square = 1 - m["azimuth"] * m["azimuth"]
        return F.when(square > 1e-15, m["cosine"] - 2 * p["s1"] * p["s2"] / square).otherwise(0.0)

    def step(p, _):
        def moved(m):
            square = 1 - m["azimuth"] * m["azimuth"]
            c = f / 16 * square * (4 + f * (4 - 3 * square))
            arc = F.atan2(m["sine"], m["cosine"]) + c * m["sine"] * (m["middle"] + c * m["cosine"] * (2 * m["middle"] * m["middle"] - 1))
            return p["turn"] + (1 - c) * f * m["azimuth"] * arc

        return F.struct(p["s1"].alias("s1"), p["c1"].alias("c1"), p["s2"].alias("s2"), p["c2"].alias("c2"), p["turn"].alias("turn"), let(figures(p), moved).alias("at"), p["at"].alias("last"))

    def figures(p):
        sine, cosine, azimuth = sphere(p)
        return let(F.struct(sine.alias("sine"), cosine.alias("cosine"), azimuth.alias("azimuth")), lambda m: F.struct(m["sine"].alias("sine"), m["cosine"].alias("cosine"), m["azimuth"].alias("azimuth"), middle(m, p).alias("middle")))

    def length(p):
        def of(m):
            square = (1 - m["azimuth"] * m["azimuth"]) * (1 / (1 - f) ** 2 - 1)
            big = 1 + square / 16384 * (4096 + square * (-768 + square * (320 - 175 * square)))
            small = square / 1024 * (256 + square * (-128 + square * (74 - 47 * square)))
            twice = 2 * m["middle"] * m["middle"] - 1
            less = small * m["sine"] * (m["middle"] + small / 4 * (m["cosine"] * twice - small / 6 * m["middle"] * (4 * m["sine"] * m["sine"] - 3) * (2 * twice - 1)))
            return a * (1 - f) * big * (F.atan2(m["sine"], m["cosine"]) - less)

        return F.when(F.abs(p["at"] - p["last"]) < 1e-11, let(figures(p), of))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), given, step, length)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def los(east: Column, north: Column, up: Column, incidence: Column, azimuth: Column) -> Column:
    """Displacement along the line of sight; azimuth is that of the sight line, counted from north, anti-clockwise."""
    inc, az = F.radians(incidence), F.radians(azimuth)
    return -F.sin(inc) * F.sin(az) * east + F.sin(inc) * F.cos(az) * north + F.cos(inc) * up


def look_angles(e: Column, n: Column) -> tuple[Column, Column]:
    """(incidence, azimuth) in degrees from the unit vector's east and north parts; 0 is no data."""
    e, n = no_data(e), no_data(n)
    up2 = 1 - e * e - n * n
    up = F.when(up2 >= 0, F.sqrt(up2))
    return F.degrees(F.acos(up)), F.degrees(F.atan2(-e, n))


def wrap(phase: Column) -> Column:
    """Into [-pi, pi)."""
    return F.pmod(phase + math.pi, F.lit(2 * math.pi)) - math.pi


def wrapped_difference(difference: Column) -> Column:
    """Less the nearest whole cycles; halves go to the even one."""
    return difference - F.rint(difference / (2 * math.pi)) * (2 * math.pi)


def requirement_mm(distance_km: Column) -> Column:
    """The transient requirement at a distance."""
    return 3 * (1 + F.sqrt(distance_km))


def point_in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies inside a closed ring of (lon, lat): crossings of a ray are odd. Points on the border are out."""
    edges = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def cross(edge):
        a, b = edge["a"], edge["b"]
        return (b["lon"] - a["lon"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lon - a["lon"])

    def on_border(edge):
        a, b = edge["a"], edge["b"]
        return (cross(edge) == 0) & lon.between(F.least(a["lon"], b["lon"]), F.greatest(a["lon"], b["lon"])) & lat.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"]))

    def crosses(edge):
        a, b = edge["a"], edge["b"]
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"])

    odd = F.aggregate(edges, F.lit(False), lambda s, e: s != F.coalesce(crosses(e), F.lit(False)))
    return odd & ~F.exists(edges, on_border)


def hash_order(seed: int, *keys: str) -> Column:
    """A deterministic order in place of a random one: md5 of the seed and the keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
