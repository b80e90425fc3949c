"""Feature vectors of scenes and pixels, and coordinates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import doy_cycle

SENSOR_ORDER = ("l5", "l7", "l8", "l9", "s2")

#: The reference ellipsoid and the projection's scale and offsets.
_A, _F, _K0, _EAST, _NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


def utm_to_lonlat(x: Column, y: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a point in a transverse Mercator zone, by the usual series (Snyder 1987, 8-17 on)."""
    e2 = _F * (2 - _F)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    m = (y - F.when(north, 0.0).otherwise(_NORTH)) / _K0
    mu = m / (_A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    s2 = F.sin(foot) * F.sin(foot)
    c = ep2 * F.cos(foot) * F.cos(foot)
    t = F.tan(foot) * F.tan(foot)
    n = _A / F.sqrt(1 - e2 * s2)
    r = _A * (1 - e2) / F.pow(1 - e2 * s2, F.lit(1.5))
    d = (x - _EAST) / (n * _K0)
    lat = foot - n * F.tan(foot) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, F.lit(4)) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, F.lit(6)) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, F.lit(3)) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, F.lit(5)) / 120) / F.cos(foot)
    return F.degrees(lon) + (zone - 1) * 6 - 177, F.degrees(lat)


def place_channels(lat: Column, lon: Column) -> tuple[Column, Column]:
    return lat / 90.0, lon / 180.0


def cell_centre(row: Column, col: Column, x0: Column, y0: Column, res: Column) -> tuple[Column, Column]:
    """Coordinates of a cell's centre; x0, y0 is the upper left corner."""
    return x0 + (col + 0.5) * res, y0 - (row + 0.5) * res


def scene_context(sensor: Column, date: Column, lat: Column, lon: Column) -> Column:
    """[sensor's number, sine and cosine of the day of the year, latitude / 90, longitude / 180]; an unknown sensor is -1."""
    s, c = doy_cycle(date)
    a, b = place_channels(lat, lon)
    number = F.array_position(F.array(*[F.lit(x) for x in SENSOR_ORDER]), F.lower(sensor)) - 1
    return F.array(number.cast("double"), s, c, a.cast("double"), b.cast("double"))


def feature_stack(df: DataFrame, names: list[str], out: str = "features") -> DataFrame:
    """df with the named columns as one array, in this order; a missing column is an error."""
    if lacking := [n for n in names if n not in df.columns]:
        raise ValueError(f"features not in the table: {lacking}")
    return df.withColumn(out, F.array(*[F.col(n).cast("double") for n in names]))


def gray_world(df: DataFrame, scene: list[str], bands: list[str]) -> DataFrame:
    """Bands scaled so that their scene means agree."""
    means = df.groupBy(*scene).agg(*[F.avg(b).alias(f"_{b}") for b in bands])
    gray = sum((F.col(f"_{b}") for b in bands[1:]), F.col(f"_{bands[0]}")) / len(bands)
    return df.join(means, scene).withColumns({b: F.col(b) * F.coalesce(F.try_divide(gray, F.col(f"_{b}")), F.lit(1.0)) for b in bands}).drop(*[f"_{b}" for b in bands])


def scatter(grid: DataFrame, sparse: DataFrame, keys: list[str]) -> DataFrame:
    """Every cell of the grid with what sparse has for it, else null."""
    return grid.select(*keys).join(sparse, keys, "left")
