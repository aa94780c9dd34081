"""National grid coordinates to WGS84 longitude and latitude, as Column arithmetic.

Inverse transverse Mercator on the Airy 1830 ellipsoid (Krueger series in the third flattening, good to well
under a millimetre), then a seven-parameter datum shift. Agreement with grid-shift methods is a few metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Airy 1830 and the national grid projection.
AIRY_A = 6377563.396
AIRY_B = 6356256.909
SCALE_0 = 0.9996012717
LAT_0 = math.radians(49)
LON_0 = math.radians(-2)
EAST_0 = 400000.0
NORTH_0 = -100000.0
# Datum shift to WGS84 (metres, parts per million, arc seconds).
SHIFT_X, SHIFT_Y, SHIFT_Z = 446.448, -125.157, 542.060
SHIFT_SCALE = -20.4894
TURN_X, TURN_Y, TURN_Z = 0.1502, 0.2470, 0.8421
# WGS84.
WGS_A = 6378137.0
WGS_F = 1 / 298.257223563


def _series():
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    radius = AIRY_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    to_sphere = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    to_geodetic = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]
    from_sphere = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    return n, radius, to_sphere, to_geodetic, from_sphere


def _origin_distance() -> float:
    """Meridian distance of the projection origin, in units of the series radius."""
    n, _, _, _, from_sphere = _series()
    e = math.sqrt(1 - (AIRY_B / AIRY_A) ** 2)
    s = math.sin(LAT_0)
    conformal = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
    return conformal + sum(c * math.sin(2 * (i + 1) * conformal) for i, c in enumerate(from_sphere))


N_FLAT, RADIUS, TO_SPHERE, TO_GEODETIC, FROM_SPHERE = _series()
XI_0 = _origin_distance()


def projected_to_airy(df: DataFrame, east: str, north: str, lat: str, lon: str) -> DataFrame:
    """Add latitude and longitude (radians, Airy datum) of grid coordinates."""
    xi, eta = F.col("__xi"), F.col("__eta")
    shifted_xi, shifted_eta = xi, eta
    for i, c in enumerate(TO_SPHERE):
        k = 2.0 * (i + 1)
        shifted_xi = shifted_xi - c * F.sin(k * xi) * F.cosh(k * eta)
        shifted_eta = shifted_eta - c * F.cos(k * xi) * F.sinh(k * eta)
    chi = F.col("__chi")
    latitude = chi
    for i, c in enumerate(TO_GEODETIC):
        latitude = latitude + c * F.sin(2.0 * (i + 1) * chi)
    return (
        df.withColumn("__xi", (F.col(north) - NORTH_0) / (SCALE_0 * RADIUS) + XI_0)
        .withColumn("__eta", (F.col(east) - EAST_0) / (SCALE_0 * RADIUS))
        .withColumns({"__xs": shifted_xi, "__es": shifted_eta})
        .withColumn("__chi", F.asin(F.sin("__xs") / F.cosh("__es")))
        .withColumn(lat, latitude)
        .withColumn(lon, F.atan2(F.sinh("__es"), F.cos("__xs")) + LON_0)
        .drop("__xi", "__eta", "__xs", "__es", "__chi")
    )


def airy_to_wgs84(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Replace radians on the Airy datum by degrees on WGS84, at height zero."""
    e2 = 1 - (AIRY_B / AIRY_A) ** 2
    m = 1 + SHIFT_SCALE * 1e-6
    rx, ry, rz = (math.radians(t / 3600) for t in (TURN_X, TURN_Y, TURN_Z))
    x, y, z = F.col("__x"), F.col("__y"), F.col("__z")
    wgs_b = WGS_A * (1 - WGS_F)
    w2 = WGS_F * (2 - WGS_F)
    second = w2 / (1 - w2)
    sin_t, cos_t = F.sin("__t"), F.cos("__t")
    return (
        df.withColumn("__v", AIRY_A / F.sqrt(1 - e2 * F.sin(lat) * F.sin(lat)))
        .withColumns(
            {
                "__x": F.col("__v") * F.cos(lat) * F.cos(lon),
                "__y": F.col("__v") * F.cos(lat) * F.sin(lon),
                "__z": F.col("__v") * (1 - e2) * F.sin(lat),
            }
        )
        .withColumns(
            {
                "__x": SHIFT_X + m * (x - rz * y + ry * z),
                "__y": SHIFT_Y + m * (rz * x + y - rx * z),
                "__z": SHIFT_Z + m * (-ry * x + rx * y + z),
            }
        )
        .withColumn("__p", F.sqrt(x * x + y * y))
        .withColumn("__t", F.atan2(z * WGS_A, F.col("__p") * wgs_b))
        .withColumn(lon, F.degrees(F.atan2(y, x)))
        .withColumn(
            lat,
            F.degrees(
                F.atan2(
                    z + second * wgs_b * sin_t * sin_t * sin_t,
                    F.col("__p") - w2 * WGS_A * cos_t * cos_t * cos_t,
                )
            ),
        )
        .drop("__v", "__x", "__y", "__z", "__p", "__t")
    )


def to_wgs84(df: DataFrame, east: str, north: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add WGS84 latitude and longitude in degrees."""
    return airy_to_wgs84(projected_to_airy(df, east, north, lat, lon), lat, lon)


def point_text(lat: str | Column, lon: str | Column, axis_order: str = "authority", decimals: int = 6) -> Column:
    """``{first, second}``. ``authority`` puts latitude first, as EPSG:4326 defines it; ``xy`` longitude first."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    first, second = (lat, lon) if axis_order == "authority" else (lon, lat)
    fixed = [F.round(c, decimals).cast(f"decimal(20,{decimals})").cast("string") for c in (first, second)]
    return F.concat(F.lit("{"), fixed[0], F.lit(", "), fixed[1], F.lit("}"))


def set_crs(df: DataFrame, column: str, crs: str) -> DataFrame:
    """Record the coordinate system in the column's metadata; coordinates do not change."""
    return df.withMetadata(column, {**(df.schema[column].metadata or {}), "crs": crs})


def crs_of(df: DataFrame, column: str) -> str | None:
    return (df.schema[column].metadata or {}).get("crs")
