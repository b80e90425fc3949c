"""Radiometry, sun and terrain formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import REFLECTANCE_NODATA, REFLECTANCE_SCALE
from .indices import bandpass_table


def quantise(x: Column, scale: int = REFLECTANCE_SCALE, nodata: int = REFLECTANCE_NODATA) -> Column:
    """Reflectance as an integer, cut not rounded, at most nodata - 1; negative, null and NaN are nodata."""
    ok = x.isNotNull() & ~F.isnan(x) & (x >= 0)
    return F.when(ok, F.least(x * scale, F.lit(float(nodata - 1))).cast("int")).otherwise(nodata)


def dequantise(n: Column, scale: int = REFLECTANCE_SCALE, nodata: int = REFLECTANCE_NODATA) -> Column:
    return F.when(n != nodata, n / F.lit(float(scale)))


def harmonize(df: DataFrame, sensor_col: str = "sensor", exempt: str = "s2") -> DataFrame:
    """Each band that df has, scaled and shifted by bandpass_table(), but for the exempt sensor."""
    table = bandpass_table()
    return df.withColumns({b: F.when(F.lower(F.col(sensor_col)) == exempt, F.col(b)).otherwise(F.col(b) * s + o) for b, (s, o) in table.items() if b in df.columns})


def illumination(slope: Column, aspect: Column, sun_elevation: Column, sun_azimuth: Column) -> Column:
    """Cosine of the angle between the sun and the surface normal, degrees in; a null aspect (flat) counts as 0."""
    zenith, s = F.radians(F.lit(90.0) - sun_elevation), F.radians(F.coalesce(slope, F.lit(0.0)))
    return F.cos(zenith) * F.cos(s) + F.sin(zenith) * F.sin(s) * F.cos(F.radians(F.coalesce(aspect, F.lit(0.0))) - F.radians(sun_azimuth))


def sun_position(doy: Column, hour: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """Sun's elevation and azimuth in degrees, by the general series of the solar calculator; hour in UTC."""
    g = F.lit(2.0) * F.pi() / 365.0 * (doy - 1 + (hour - 12.0) / 24.0)
    eqtime = 229.18 * (0.000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    decl = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    minutes = F.pmod(hour * 60.0 + eqtime + 4.0 * lon, F.lit(1440.0))
    angle, la = F.radians(minutes / 4.0 - 180.0), F.radians(lat)
    cos_zenith = F.sin(la) * F.sin(decl) + F.cos(la) * F.cos(decl) * F.cos(angle)
    zenith = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos_zenith)))
    azimuth = F.atan2(F.sin(angle), F.cos(angle) * F.sin(la) - F.tan(decl) * F.cos(la)) + F.pi()
    return 90.0 - F.degrees(zenith), F.pmod(F.degrees(azimuth), F.lit(360.0))


def scs_c(df: DataFrame, scene: list[str], bands: list[str], reference: str = "nir", least_sun: float = 5.0, least_px: int = 30, clip: tuple[float, float] = (0.2, 5.0)) -> DataFrame:
    """Terrain correction of bands, with one C for each scene.

    df has slope, aspect, sun_elevation, sun_azimuth and the bands. C is intercept over slope of the reference band
    against illumination; 0 under least_px pixels, without spread, with a slope near zero, or where illumination
    plus C would come near zero. Scenes with the sun under least_sun degrees stay as they are. The fit is one aggregation
    by scene, joined back; the join is on the scene alone, so its other side has a row for each scene.
    """
    il = illumination(F.col("slope"), F.col("aspect"), F.col("sun_elevation"), F.col("sun_azimuth"))
    lit_df = df.withColumn("_il", il)
    both = F.col(reference).isNotNull() & ~F.isnan(reference) & F.col("_il").isNotNull()
    x, y = F.when(both, F.col("_il")), F.when(both, F.col(reference))
    fit = lit_df.groupBy(*scene).agg(F.count(y).alias("_n"), (F.max(x) - F.min(x)).alias("_spread"), F.regr_slope(y, x).alias("_m"), F.regr_intercept(y, x).alias("_b"), F.min("_il").alias("_low"))
    c = F.try_divide(F.col("_b"), F.col("_m"))
    fine = (F.col("_n") >= least_px) & (F.col("_spread") >= 1e-6) & (F.abs("_m") >= 1e-9) & (F.col("_low") + c > 0.05)
    fit = fit.select(*scene, F.when(fine, c).otherwise(0.0).alias("scs_c"))
    under = F.col("_il") + F.col("scs_c")
    ratio = F.when(F.abs(under) > 1e-6, (F.cos(F.radians(F.col("slope"))) + F.col("scs_c")) / under).otherwise(1.0)
    ratio = F.when(F.col("sun_elevation") >= least_sun, F.greatest(F.lit(clip[0]), F.least(F.lit(clip[1]), ratio))).otherwise(1.0)
    return lit_df.join(fit, scene).withColumn("_ratio", ratio).withColumns({b: F.col(b) * F.col("_ratio") for b in bands}).withColumnRenamed("_il", "illumination").withColumnRenamed("_ratio", "scs_ratio")


def northness(slope: Column, aspect: Column, least_slope: float = 2.0) -> tuple[Column, Column]:
    """Cosine and sine of the aspect; null on flat ground."""
    ok = slope >= least_slope
    return F.when(ok, F.cos(F.radians(aspect))), F.when(ok, F.sin(F.radians(aspect)))


def aspect_sector(slope: Column, aspect: Column, n: int = 8, least_slope: float = 2.0) -> Column:
    """Sector of the aspect, the first centred on north; null on flat ground."""
    return F.when(slope >= least_slope, F.floor(F.pmod(aspect + 180.0 / n, F.lit(360.0)) / (360.0 / n)).cast("int"))


def aspect_channels(aspect: Column) -> tuple[Column, Column]:
    """Sine and cosine of the aspect, 0 where it is null."""
    return F.coalesce(F.sin(F.radians(aspect)), F.lit(0.0)), F.coalesce(F.cos(F.radians(aspect)), F.lit(0.0))


def percentile_stretch(df: DataFrame, scene: list[str], bands: list[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Each band between two exact percentiles of its scene as 0 to 255; null stays null, a flat band gives 0."""
    ends = df.groupBy(*scene).agg(*[F.percentile(F.col(b), F.array(F.lit(low), F.lit(high))).alias(f"_{b}") for b in bands])

    def one(b: str) -> Column:
        a, z = F.element_at(F.col(f"_{b}"), 1), F.element_at(F.col(f"_{b}"), 2)
        return (F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col(b) - a, z - a), F.when(F.col(b).isNotNull(), 0.0)))) * 255).cast("int")

    return df.join(ends, scene).withColumns({b: one(b) for b in bands}).drop(*[f"_{b}" for b in bands])


def shadow_stretch(x: Column, k: float = 10.0, gamma: float = 1.2) -> Column:
    """Values from 0 to 1 with the shadows lifted: asinh, then a power."""
    return F.pow(F.asinh(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) * k) / F.asinh(F.lit(k)), F.lit(1.0 / gamma))
