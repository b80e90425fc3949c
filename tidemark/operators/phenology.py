"""Seasonal cycle of each year: peak, amplitude, and dates by threshold crossing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..keys import Series

DAYS = 30.4375


def phenology(monthly: DataFrame, value: str, low: str, s: Series, fraction: float = 0.5, least_obs: int = 5, least_amplitude: float = 0.08, gap: int = 2) -> DataFrame:
    """keys, year, peak_month, peak, amplitude, start_doy, end_doy, season_days.

    monthly has one value for each series and month, and the series' low value in column low. The peak is the first greatest
    month, told with least_obs observed months; dates need an amplitude over low. From the peak outward over observed months, a
    date lies where the value falls below low + fraction * amplitude, between the two months by straight line; there is
    none if observed months are more than gap apart before that, or the year ends. A year's months are one array of up to 12.
    """
    own = monthly.where(F.col(value).isNotNull())
    years = own.groupBy(*s.keys, F.year(s.time).alias("year")).agg(
        F.sort_array(F.collect_list(F.struct((F.month(s.time) - 1).alias("m"), F.col(value).cast("double").alias("v")))).alias("a"), F.first(low).cast("double").alias("low")
    )
    top = F.array_max(F.transform("a", lambda p: p["v"]))
    years = years.withColumn("peak", top).withColumn("at", F.array_position(F.transform("a", lambda p: p["v"]), F.col("peak")).cast("int"))
    years = years.withColumn("amplitude", F.col("peak") - F.col("low")).withColumn("cut", F.col("low") + fraction * F.col("amplitude"))

    def walk(points: Column) -> Column:
        """First crossing below the cut along points, which begin at the peak."""
        zero = F.struct(F.lit(None).cast("double").alias("t"), F.lit(False).alias("over"), F.element_at(points, 1).alias("p"))

        def step(acc: Column, q: Column) -> Column:
            p = acc["p"]
            far = F.abs(q["m"] - p["m"]) > gap
            part = (p["v"] - F.col("cut")) / (p["v"] - q["v"])
            crossed = q["v"] < F.col("cut")
            date = (p["m"] + 0.5 + part * (q["m"] - p["m"])) * DAYS
            done = acc["over"]
            return F.struct(F.when(done, acc["t"]).when(~far & crossed, date).alias("t"), (done | far | crossed).alias("over"), q.alias("p"))

        return F.aggregate(F.slice(points, 2, 12), zero, step)["t"]

    n = F.size("a")
    dated = (n >= least_obs) & (F.col("amplitude") >= least_amplitude)
    after = F.slice("a", F.col("at"), F.lit(12))
    before = F.reverse(F.slice("a", F.lit(1), F.col("at")))
    out = years.withColumn("start_doy", F.when(dated, F.round(walk(before)).cast("int"))).withColumn("end_doy", F.when(dated, F.round(walk(after)).cast("int")))
    enough = n >= least_obs
    return out.select(
        *s.keys,
        "year",
        F.when(enough, F.element_at("a", F.col("at"))["m"] + 1).alias("peak_month"),
        F.when(enough, F.col("peak")).alias("peak"),
        F.when(enough, F.col("amplitude")).alias("amplitude"),
        "start_doy",
        "end_doy",
        F.when(F.col("end_doy") > F.col("start_doy"), F.col("end_doy") - F.col("start_doy")).alias("season_days"),
    )
