"""Yearly statistics, climatology, anomalies, trends and variability of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import in_season, month_of, water_month, water_year
from ..keys import Series


def yearly_stats(monthly: DataFrame, value: str, s: Series, season: tuple[int, int] = (5, 10), least: int = 2) -> DataFrame:
    """keys, year, gs_mean, annual_max, n_obs. The season's mean needs `least` values in season, and the year's maximum is
    told only then too, though it is over the whole year; n_obs counts the values in season."""
    inside = F.when(in_season(F.col(s.time), *season), F.col(value))
    out = monthly.groupBy(*s.keys, F.year(s.time).alias("year")).agg(F.avg(inside).alias("_mean"), F.max(value).alias("_max"), F.count(inside).alias("n_obs"))
    enough = F.col("n_obs") >= least
    return out.select(*s.keys, "year", F.when(enough, F.col("_mean")).alias("gs_mean"), F.when(enough, F.col("_max")).alias("annual_max"), "n_obs")


def nearest_rank(value: str, pct: float) -> Column:
    """Aggregate: the value at rank int(pct / 100 * (n - 1) + 0.5) of the sorted values, counted from 0."""
    values = F.sort_array(F.collect_list(value))
    at = F.least(F.size(values) - 1, F.floor(F.lit(pct / 100.0) * (F.size(values) - 1) + 0.5).cast("int"))
    return F.when(F.size(values) > 0, F.get(values, at))


def low_values(monthly: DataFrame, value: str, s: Series, pct: float = 10.0) -> DataFrame:
    """Each series' low value by nearest rank: a group is one series."""
    return monthly.groupBy(*s.keys).agg(nearest_rank(value, pct).alias("low"), F.count(value).alias("n_obs"))


def climatology(monthly: DataFrame, value: str, s: Series, base: tuple[int, int] | None = None, least: int = 5, floor: float = 0.02, robust: bool = True) -> DataFrame:
    """keys, moy, centre, scale of each calendar month over the base years: median and 1.4826 MAD, or mean and sample
    deviation; the scale is at least floor, and a month needs `least` values."""
    own = monthly.where(F.col(value).isNotNull()).withColumn("moy", F.month(s.time))
    if base:
        own = own.where(F.year(s.time).between(*base))
    by = s.by("moy")
    if robust:
        # The second pass needs the median beside each value: windows over the partitioning that the aggregate has anyway.
        own = own.withColumn("centre", F.median(value).over(W.partitionBy(*by)))
        out = own.groupBy(*by).agg(F.first("centre").alias("centre"), (F.median(F.abs(F.col(value) - F.col("centre"))) * 1.4826).alias("scale"), F.count(value).alias("n"))
    else:
        out = own.groupBy(*by).agg(F.avg(value).alias("centre"), F.stddev_samp(value).alias("scale"), F.count(value).alias("n"))
    return out.where(F.col("n") >= least).withColumn("scale", F.greatest(F.coalesce("scale", F.lit(0.0)), F.lit(floor)))


def z_scores(monthly: DataFrame, value: str, s: Series, **how: object) -> DataFrame:
    """keys, time, value, z: distance from the climatology of the calendar month, in scales; null without one."""
    base = climatology(monthly, value, s, **how)
    return monthly.withColumn("moy", F.month(s.time)).join(base, s.by("moy"), "left").select(*s.keys, s.time, value, ((F.col(value) - F.col("centre")) / F.col("scale")).alias("z"))


def yearly_anomaly(z: DataFrame, s: Series, season: tuple[int, int] = (5, 10), bound: float = 2.0) -> DataFrame:
    """keys, year, gs_mean_z, min_z, n_low, n_high of the z-scores."""
    inside = F.when(in_season(F.col(s.time), *season), F.col("z"))
    return z.where("z is not null").groupBy(*s.keys, F.year(s.time).alias("year")).agg(F.avg(inside).alias("gs_mean_z"), F.min("z").alias("min_z"), F.count_if(F.col("z") <= -bound).alias("n_low"), F.count_if(F.col("z") >= bound).alias("n_high"))


def worst_anomaly(z: DataFrame, s: Series) -> DataFrame:
    """keys, worst_time, worst_z: the z-score farthest from 0, the first on ties."""
    return z.where("z is not null").groupBy(*s.keys).agg(F.max_by(F.struct(F.col(s.time), F.col("z")), F.struct(F.abs("z"), -F.unix_date(F.col(s.time)))).alias("_w")).select(*s.keys, F.col(f"_w.{s.time}").alias("worst_time"), F.col("_w.z").alias("worst_z"))


def variability(yearly: DataFrame, value: str, s: Series, least: int = 5) -> DataFrame:
    """keys, n_years, cv, mean_abs_change: sample deviation over the mean's size (null near 0), and the mean change
    between adjacent observed years; both need `least` years."""
    own = yearly.where(F.col(value).isNotNull())
    order = W.partitionBy(*s.keys).orderBy("year")
    step = F.when(F.col("year") - F.lag("year").over(order) == 1, F.abs(F.col(value) - F.lag(value).over(order)))
    out = own.withColumn("_step", step).groupBy(*s.keys).agg(F.count(value).alias("n_years"), F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"), F.avg("_step").alias("_change"))
    enough = F.col("n_years") >= least
    return out.select(*s.keys, "n_years", F.when(enough & (F.abs("_mean") > 1e-3), F.col("_sd") / F.abs("_mean")).alias("cv"), F.when(enough, F.col("_change")).alias("mean_abs_change"))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, by the rational form of Abramowitz and Stegun 7.1.26; error under 1.5e-7."""
    t = 1.0 / (1.0 + 0.3275911 * x)
    return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)


def trend(yearly: DataFrame, value: str, s: Series, least: int = 8, since: str | None = None) -> DataFrame:
    """keys, n_years, slope, mk_s, mk_z, mk_p: Theil-Sen slope and Mann-Kendall test, null under `least` years.

    since: a column, null or the first year that counts. A series' years are one array, its pairs an expression on it, so
    there's one shuffle and no self-join; the array has a year each, some dozens.
    """
    own = yearly.where(F.col(value).isNotNull())
    if since:
        own = own.where(F.col(since).isNotNull() & (F.col("year") >= F.col(since)))
    years = own.groupBy(*s.keys).agg(F.sort_array(F.collect_list(F.struct(F.col("year").cast("double").alias("x"), F.col(value).cast("double").alias("y")))).alias("_a"))
    pairs = F.flatten(F.transform("_a", lambda p, i: F.transform(F.slice("_a", i + 2, F.size("_a")), lambda q: F.struct((q["y"] - p["y"]).alias("d"), ((q["y"] - p["y"]) / (q["x"] - p["x"])).alias("m")))))
    return _trend_of(years.withColumn("_p", F.when(F.size("_a") > 1, pairs)), s, least)


def _trend_of(paired: DataFrame, s: Series, least: int) -> DataFrame:
    n = F.size("_a")
    slopes = F.sort_array(F.transform("_p", lambda p: p["m"]))
    half = F.floor((F.size(slopes) - 1) / 2).cast("int")
    out = paired.select(*s.keys, n.alias("n_years"), F.aggregate("_p", F.lit(0.0), lambda t, p: t + F.signum(p["d"])).alias("_s"), slopes.alias("_m"), half.alias("_h"))
    median = F.when(F.size("_m") % 2 == 1, F.get("_m", F.col("_h"))).otherwise((F.get("_m", F.col("_h")) + F.get("_m", F.col("_h") + 1)) / 2)
    enough, k = F.col("n_years") >= least, F.col("n_years").cast("double")
    z = F.when(F.col("_s") == 0, 0.0).otherwise((F.col("_s") - F.signum("_s")) / F.sqrt(k * (k - 1) * (2 * k + 5) / 18.0))
    return out.select(*s.keys, "n_years", F.when(enough, median).alias("slope"), F.when(enough, F.col("_s")).cast("long").alias("mk_s"), F.when(enough, z).alias("mk_z")).withColumn("mk_p", erfc(F.abs("mk_z") / F.sqrt(F.lit(2.0))))


def water_years(classes: DataFrame, s: Series, snow: object, firn: object, ice: object, water: object, excluded: list | None = None, start_month: int = 10) -> DataFrame:
    """keys, water_year, observed, snow, firn, ice and water months, first and last month of snow in the water year."""
    own = classes.where(F.col(s.label).isNotNull())
    if excluded:
        own = own.where(~F.col(s.label).isin(*excluded))
    own = own.withColumn("water_year", water_year(F.col(s.time), start_month)).withColumn("_m", water_month(F.col(s.time), start_month))
    is_snow = F.col(s.label) == F.lit(snow)
    return own.groupBy(*s.keys, "water_year").agg(
        F.count(F.lit(1)).alias("observed"),
        *[F.count_if(F.col(s.label) == F.lit(c)).alias(n) for n, c in (("snow", snow), ("firn", firn), ("ice", ice), ("water", water))],
        F.min(F.when(is_snow, F.col("_m"))).alias("first_snow"),
        F.max(F.when(is_snow, F.col("_m"))).alias("last_snow"),
    )


def season_shares(classes: DataFrame, s: Series, shares: dict[str, list], season: tuple[int, int] = (5, 10)) -> DataFrame:
    """keys, year, n_obs and the share of each named set of classes among a season's months."""
    own = classes.where(F.col(s.label).isNotNull() & in_season(F.col(s.time), *season))
    return own.groupBy(*s.keys, F.year(s.time).alias("year")).agg(F.count(F.lit(1)).alias("n_obs"), *[F.avg(F.col(s.label).isin(*c).cast("double")).alias(n) for n, c in shares.items()])


def monthly_means(obs: DataFrame, value: str, s: Series) -> DataFrame:
    """keys, time (first of the month), value: the median of each month."""
    return obs.groupBy(*s.keys, month_of(F.col(s.time)).alias(s.time)).agg(F.median(value).alias(value))
