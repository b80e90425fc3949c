"""Monthly classes by voting rules, monthly statistics, and binned medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import doy_in_window, month_of
from ..keys import Series

RULES = ("median", "any_occurrence", "fallback_occurrence")


def vote_counts(obs: DataFrame, s: Series, ignored: list | None = None) -> DataFrame:
    """keys, month, class, votes: observations of each class in each month; null and ignored classes don't vote."""
    use = obs.where(F.col(s.label).isNotNull())
    if ignored:
        use = use.where(~F.col(s.label).isin(*ignored))
    return use.groupBy(*s.keys, month_of(F.col(s.time)).alias("month"), s.label).agg(F.count(F.lit(1)).alias("votes"))


def monthly_class(obs: DataFrame, rules: list[tuple], s: Series, ignored: list | None = None) -> DataFrame:
    """keys, month, class: one class for each series and month, null where none wins.

    rules: (class, rule, priority, min_count, doy_start, doy_end) for classes that aren't plain `median` ones. The winner is

    - the class with more than half of the votes, not counting fallback classes' votes; any-occurrence votes count;
    - else, of fallback classes with min_count votes (or all votes, if fewer), the one of the lowest priority;
      else the present one of the highest priority number;
    - and above all any-occurrence classes that occur, lowest priority first.

    A fallback class whose window of days excludes the middle of the month votes as a plain one. On equal priorities the
    larger class wins where the strict pass or any-occurrence decides. One aggregation by (series, month, class) and one by (series, month), both on the same shuffle: the
    rules are literals, not a join.
    """
    votes = vote_counts(obs, s, ignored).repartition(*s.keys, "month")
    label, mid = F.col(s.label), F.dayofyear(F.make_date(F.year("month"), F.month("month"), F.lit(15)))
    rule, priority, least = F.lit("median"), F.lit(0), F.lit(1)
    for cls, kind, rank, least_count, start, end in rules:
        if kind not in RULES:
            raise ValueError(f"unknown rule {kind!r}; known: {RULES}")
        on = label == F.lit(cls)
        if kind == "fallback_occurrence":
            on_rule = on & doy_in_window(mid, start, end)
        else:
            on_rule = on
        rule = F.when(on_rule, kind).otherwise(rule)
        priority = F.when(on, rank).otherwise(priority)
        least = F.when(on, least_count or 1).otherwise(least)
    tagged = votes.select(*s.keys, "month", label.alias("_c"), "votes", rule.alias("_rule"), priority.alias("_p"), least.alias("_least"))
    group = W.partitionBy(*s.keys, "month")
    tagged = tagged.withColumn("_all", F.sum("votes").over(group)).withColumn("_plain", F.sum(F.when(F.col("_rule") != "fallback_occurrence", F.col("votes")).otherwise(0)).over(group))

    def best(when: Column, order: Column) -> Column:
        """Class of the greatest order among the rows where `when` holds."""
        return F.max_by(F.when(when, F.col("_c")), F.when(when, order))

    fallback = F.col("_rule") == "fallback_occurrence"
    strict = fallback & (F.col("votes") >= F.least("_least", "_all"))
    return tagged.groupBy(*s.keys, "month").agg(
        F.coalesce(
            best(F.col("_rule") == "any_occurrence", F.struct(-F.col("_p"), F.col("_c"))),
            best((F.col("_rule") == "median") & (2 * F.col("votes") > F.col("_plain")), F.struct("votes", "_c")),
            best(strict, F.struct(-F.col("_p"), F.col("_c"))),
            best(fallback, F.struct("_p", F.col("_c"))),
        ).alias(s.label)
    )


def monthly_stats(obs: DataFrame, values: list[str], s: Series) -> DataFrame:
    """keys, month, index_name, median, min, max, n_obs of each value column, in long form; all null months are absent.

    Exact medians: a group holds one series' values of one month.
    """
    aggs = [f(v).alias(f"{v}__{n}") for v in values for n, f in (("median", F.median), ("min", F.min), ("max", F.max), ("n", F.count))]
    wide = obs.groupBy(*s.keys, month_of(F.col(s.time)).alias("month")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(v).alias("index_name"), F.col(f"{v}__median").alias("median"), F.col(f"{v}__min").alias("min"), F.col(f"{v}__max").alias("max"), F.col(f"{v}__n").alias("n_obs")) for v in values])
    return wide.select(*s.keys, "month", F.inline(rows)).where("n_obs > 0")


def bin_plan(scenes: DataFrame, tile: list[str], s: Series, days: int) -> DataFrame:
    """scenes (tile, sensor, time) with bin and bin_date: periods of so many days from the tile's first scene, apart for
    each sensor; bin_date is the rounded mean of the scenes' days in the bin. A small table: a row for each scene."""
    first = F.min(s.time).over(W.partitionBy(*tile))
    binned = scenes.select(*tile, s.source, s.time).distinct().withColumn("bin", F.floor(F.datediff(F.col(s.time), first) / days).cast("int"))
    mean = F.avg(F.unix_date(F.col(s.time))).over(W.partitionBy(*tile, s.source, "bin"))
    return binned.withColumn("bin_date", F.date_from_unix_date(F.bround(mean).cast("int")))


def binned_medians(obs: DataFrame, values: list[str], tile: list[str], s: Series, days: int = 15) -> DataFrame:
    """keys, sensor, bin, bin_date, the median of each value, and the commonest class (smallest on ties)."""
    plan = bin_plan(obs, tile, s, days)
    binned = obs.join(plan, [*tile, s.source, s.time])
    by = [*s.keys, s.source, "bin", "bin_date"]
    return binned.groupBy(*by).agg(*[F.median(v).alias(v) for v in values], F.count(F.lit(1)).alias("n_obs"), F.mode(s.label, deterministic=True).alias(s.label))


def reference_scene(scenes: DataFrame, by: list[str], s: Series, order: list[str], resolution: str | None = None) -> DataFrame:
    """Each group's reference scene: by sensor priority, or by the finest resolution, then sensor and scene id."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(s.source))
    rank = F.when(rank == 0, len(order) + 1).otherwise(rank)
    keys = [F.col(resolution), F.col(s.source), F.col(s.scene)] if resolution else [rank, F.col(s.scene)]
    return scenes.groupBy(*by).agg(F.min_by(F.struct(s.source, s.scene), F.struct(*[k.alias(f"k{n}") for n, k in enumerate(keys)])).alias("_r")).select(*by, "_r.*")
