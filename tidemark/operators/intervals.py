"""Intervals in which a class persists, with hysteresis over observed months."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import month_from_number, month_number
from ..keys import Series


def intervals(classes: DataFrame, target: object, s: Series, masked: list | None = None, window: int = 5, start_share: float = 0.8, end_share: float = 0.2, least_months: int = 12, most: int = 8) -> DataFrame:
    """keys, interval, start_month, end_month: when the target class began and ceased to persist; a null end is open.

    Months of masked classes are skipped. Over the last `window` observed months, the state turns on at
    ceil(start_share * window) hits, from the earliest hit in the window, and off at floor(end_share * window) hits, at the first
    observed month after the last hit. Intervals shorter than least_months, an open one counted to the month after
    the series' last observed one, go; at most `most` begin. Series that never show the class are left out before
    anything is ordered; the state is a fold over one array for each series.
    """
    hits_on, hits_off = math.ceil(start_share * window - 1e-9), math.floor(end_share * window + 1e-9)
    if hits_off >= hits_on:
        raise ValueError("an interval must end at fewer hits than it starts with")
    own = classes.where(F.col(s.label).isNotNull())
    last = own.groupBy(*s.keys).agg(F.max(month_number(F.col(s.time))).alias("_last"), F.max((F.col(s.label) == F.lit(target)).cast("int")).alias("_any")).where("_any = 1")
    if masked:
        own = own.where(~F.col(s.label).isin(*masked))
    seen = own.select(*s.keys, month_number(F.col(s.time)).alias("m"), (F.col(s.label) == F.lit(target)).cast("int").alias("hit"))
    order = W.partitionBy(*s.keys).orderBy("m")
    span = order.rowsBetween(-(window - 1), 0)
    rows = (
        seen.withColumn("full", F.row_number().over(order) >= window)
        .withColumn("hits", F.sum("hit").over(span))
        .withColumn("first_hit", F.min(F.when(F.col("hit") == 1, F.col("m"))).over(span))
        .withColumn("last_hit", F.max(F.when(F.col("hit") == 1, F.col("m"))).over(order.rowsBetween(W.unboundedPreceding, 0)))
        # The first observed month after a hit: known at the hit by looking one row ahead, carried to where the state turns off.
        .withColumn("_next", F.lead("m").over(order))
        .withColumn("after_hit", F.last(F.when(F.col("hit") == 1, F.col("_next")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    )
    change = F.when(F.col("full") & (F.col("hits") >= hits_on), 1).when(F.col("full") & (F.col("hits") <= hits_off), -1).otherwise(0)
    # A state turns where it differs from the last decided one, so no fold is needed: carry the last decision forward.
    rows = rows.withColumn("_d", F.when(change != 0, change)).where("_d is not null")
    before = F.coalesce(F.lag("_d").over(order), F.lit(-1))
    turns = rows.withColumn("_b", before).where("_d <> _b")
    starts = turns.withColumn("_end", F.lead("after_hit").over(order)).where("_d = 1").withColumn("interval", F.row_number().over(order)).where(F.col("interval") <= most)
    out = starts.join(last, list(s.keys)).withColumn("_stop", F.coalesce("_end", F.col("_last") + 1)).where(F.col("_stop") - F.col("first_hit") >= least_months)
    return out.select(*s.keys, F.lit(target).alias("class"), "interval", month_from_number(F.col("first_hit")).alias("start_month"), month_from_number(F.col("_end")).alias("end_month"))


def match_breaks(spans: DataFrame, breaks: DataFrame, s: Series, before: int = 18, after: int = 6, least_drop: float = 0.1, break_time: str = "t_break", drop: str = "drop") -> DataFrame:
    """spans with break_date: of the series' breaks with a drop of least_drop, from `before` months ahead of the interval's start to
    `after` months past it, the nearest one, the earlier on ties; null if there is none. Joined on the series' key, with the gap as a condition."""
    own = breaks.where(F.col(drop) >= least_drop).select(*s.keys, F.col(break_time).alias("_t"))
    gap = month_number(F.col("_t")) - month_number(F.col("start_month"))
    ids = s.by("class", "interval")
    near = spans.join(own, list(s.keys)).withColumn("_gap", gap).where(F.col("_gap").between(-before, after))
    best = near.groupBy(*ids).agg(F.min_by("_t", F.struct(F.abs("_gap"), F.col("_t"))).alias("break_date"))
    return spans.join(best, ids, "left")


def summarize(spans: DataFrame, s: Series) -> DataFrame:
    """keys, class, n, first_start, last_end, active: a series' intervals of a class."""
    return spans.groupBy(*s.keys, "class").agg(F.count(F.lit(1)).alias("n"), F.min("start_month").alias("first_start"), F.max("end_month").alias("last_end"), F.max(F.col("end_month").isNull()).alias("active"))


def hysteresis(value: Column, on: float, off: float) -> Column:
    """The decision that a value makes: 1 on, -1 off, null to stay."""
    return F.when(value >= on, 1).when(value <= off, -1)
