"""Changes of class between months, their confirmation, and breaks.

Changes meet months, breaks and one another by merging: stored series are packed so small that the planner would send them whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..keys import Series


def month_changes(classes: DataFrame, s: Series, step: int = 12, eligible: list | None = None) -> DataFrame:
    """keys, from_month, to_month, from_class, to_class, changed: each month against the one `step` months before.

    Both classes must be eligible for change. An equi-join of the table with itself, shifted; pairs without both sides are left out.
    """
    own = classes.where(F.col(s.label).isNotNull())
    if eligible is not None:
        own = own.where(F.col(s.label).isin(*eligible))
    a = own.select(*s.keys, F.col(s.time).alias("from_month"), F.add_months(F.col(s.time), step).alias("to_month"), F.col(s.label).alias("from_class"))
    b = own.select(*s.keys, F.col(s.time).alias("to_month"), F.col(s.label).alias("to_class"))
    return a.join(b.hint("merge"), s.by("to_month")).select(*s.keys, "from_month", "to_month", "from_class", "to_class", (F.col("from_class") != F.col("to_class")).alias("changed"))


def confirmed_changes(changes: DataFrame, classes: DataFrame, tile: list[str], s: Series, follow: int = 1) -> DataFrame:
    """Changes with persistent: whether the series has the new class in each of the tile's next `follow` stored months.

    Fewer than that many stored months, or a month without this series, is false.
    """
    months = classes.select(*tile, F.col(s.time).alias("to_month")).distinct()
    order = W.partitionBy(*tile).orderBy("to_month")
    ahead = months.withColumn("_next", F.array(*[F.lead("to_month", n).over(order) for n in range(1, follow + 1)])).select(*tile, "to_month", F.explode("_next").alias("next_month"))
    held = classes.select(*s.keys, F.col(s.time).alias("next_month"), F.col(s.label).alias("_then"))
    checks = changes.where("changed").join(ahead, [*tile, "to_month"]).join(held.hint("merge"), s.by("next_month"), "left")
    agreed = checks.groupBy(*s.keys, "from_month", "to_month").agg((F.count_if(F.col("_then") == F.col("to_class")) == follow).alias("persistent"))
    return changes.where("changed").join(agreed.hint("merge"), s.by("from_month", "to_month"), "left").withColumn("persistent", F.coalesce("persistent", F.lit(False)))


def corroborated_changes(changes: DataFrame, breaks: DataFrame, s: Series, days: int = 45, break_time: str = "t_break") -> DataFrame:
    """The changes with a break of their series within so many days of the new month's first day."""
    c, b = changes.alias("c"), breaks.where(F.col(break_time).isNotNull()).alias("b")
    same = [F.col(f"c.{k}") == F.col(f"b.{k}") for k in s.keys]
    return c.where("changed").join(b.hint("merge"), [*same, F.abs(F.datediff(F.col(f"b.{break_time}"), F.col("c.to_month"))) <= days], "left_semi")


def latest_breaks(breaks: DataFrame, s: Series, carry: list[str], break_time: str = "t_break") -> DataFrame:
    """keys, t_break and the carried columns of each series' latest break."""
    own = breaks.where(F.col(break_time).isNotNull())
    return own.groupBy(*s.keys).agg(F.max(break_time).alias(break_time), *[F.max_by(c, break_time).alias(c) for c in carry])


def break_pairs(breaks: DataFrame, monthly: DataFrame, value: str, s: Series, break_time: str = "t_break") -> DataFrame:
    """Breaks with before, after and difference: the value of the break's month and of the next, both exact months."""
    m = monthly.select(*s.keys, F.col(s.time).alias("_m"), F.col(value).alias("_v"))
    own = breaks.withColumn("_a", F.trunc(break_time, "MM").cast("date")).withColumn("_b", F.add_months(F.trunc(break_time, "MM").cast("date"), 1))
    first = own.join(m.withColumnsRenamed({"_m": "_a", "_v": "before"}), s.by("_a"), "left")
    return first.join(m.withColumnsRenamed({"_m": "_b", "_v": "after"}), s.by("_b"), "left").withColumn("difference", F.col("before") - F.col("after")).drop("_a", "_b")


def trajectories(breaks: DataFrame, monthly: DataFrame, value: str, s: Series, break_time: str = "t_break") -> DataFrame:
    """keys, t_break, month, since_months, value: all months that begin on or after the series' break."""
    m = monthly.where(F.col(value).isNotNull()).select(*s.keys, F.col(s.time).alias("month"), F.col(value))
    since = (F.year("month") - F.year(break_time)) * 12 + F.month("month") - F.month(break_time)
    return breaks.select(*s.keys, break_time).join(m, list(s.keys)).where(F.col("month") >= F.col(break_time)).select(*s.keys, break_time, "month", since.alias("since_months"), value)


def prior_loss(events: DataFrame, s: Series, losses: list[str], retype: str = "open_land_disturbance", to: str = "regrowth_change") -> DataFrame:
    """Events with prior_losses, and an open-land loss after one retyped. Earlier events of a series are counted in date order."""
    earlier = W.partitionBy(*s.keys).orderBy("break_date").rowsBetween(W.unboundedPreceding, -1)
    own = events.withColumn("prior_losses", F.coalesce(F.sum(F.col("event_type").isin(*losses).cast("long")).over(earlier), F.lit(0)))
    return own.withColumn("event_type", F.when((F.col("event_type") == retype) & (F.col("prior_losses") > 0), to).otherwise(F.col("event_type")))
