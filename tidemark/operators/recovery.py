"""Recovery after events: curves, class succession, transitions and binned outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import in_season
from ..keys import Series


def dominant_class(classes: DataFrame, s: Series, season: tuple[int, int] = (5, 10), least: int = 2, masked: list | None = None) -> DataFrame:
    """keys, year, class: the commonest class of the season, the smallest on ties; null under `least` observed months."""
    own = classes.where(F.col(s.label).isNotNull() & in_season(F.col(s.time), *season))
    if masked:
        own = own.where(~F.col(s.label).isin(*masked))
    counts = own.groupBy(*s.keys, F.year(s.time).alias("year"), s.label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*s.keys, "year").agg(F.min_by(s.label, F.struct(-F.col("_n"), F.col(s.label))).alias("_c"), F.sum("_n").alias("n_obs")).select(*s.keys, "year", F.when(F.col("n_obs") >= least, F.col("_c")).alias(s.label), "n_obs")


def since_event(yearly: DataFrame, events: DataFrame, s: Series, event_year: str = "event_year", most: int = 20) -> DataFrame:
    """Events joined with their series' years: years_since from 0 to most."""
    return events.join(yearly, list(s.keys)).withColumn("years_since", F.col("year") - F.col(event_year)).where(F.col("years_since").between(0, most))


def succession(seq: DataFrame, event: list[str], label: str, forest: object) -> DataFrame:
    """For each event: n_changes between adjacent observed years, first_forest year, final class, n_observed."""
    order = W.partitionBy(*event).orderBy("years_since")
    step = (F.col("years_since") - F.lag("years_since").over(order) == 1) & (F.col(label) != F.lag(label).over(order))
    own = seq.where(F.col(label).isNotNull()).withColumn("_step", F.coalesce(step, F.lit(False)))
    return own.groupBy(*event).agg(
        F.count_if("_step").alias("n_changes"),
        F.min(F.when(F.col(label) == F.lit(forest), F.col("years_since"))).alias("first_forest"),
        F.max_by(label, "years_since").alias("final_class"),
        F.count(F.lit(1)).alias("n_observed"),
    )


def time_in_class(seq: DataFrame, event: list[str], label: str) -> DataFrame:
    return seq.where(F.col(label).isNotNull()).groupBy(*event, label).agg(F.count(F.lit(1)).alias("years"))


def transitions(seq: DataFrame, event: list[str], kind: str, label: str) -> DataFrame:
    """kind, from_class, to_class, count, prob: Markov counts of adjacent observed years and shares of their row."""
    order = W.partitionBy(*event).orderBy("years_since")
    pairs = (
        seq.withColumn("_from", F.lag(label).over(order))
        .withColumn("_gap", F.col("years_since") - F.lag("years_since").over(order))
        .where(F.col("_from").isNotNull() & F.col(label).isNotNull() & (F.col("_gap") == 1))
    )
    counts = pairs.groupBy(F.col(kind), F.col("_from").alias("from_class"), F.col(label).alias("to_class")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("prob", F.col("count") / F.sum("count").over(W.partitionBy(kind, "from_class")))


def class_shares(seq: DataFrame, kind: str, label: str) -> DataFrame:
    """kind, years_since, class, n_observed, share of each class among the observed events of that age."""
    counts = seq.where(F.col(label).isNotNull()).groupBy(kind, "years_since", label).agg(F.count(F.lit(1)).alias("_n"))
    whole = F.sum("_n").over(W.partitionBy(kind, "years_since"))
    return counts.select(kind, "years_since", label, whole.alias("n_observed"), (F.col("_n") / whole).alias("share"))


def curves(yearly: DataFrame, events: DataFrame, value: str, s: Series, event_year: str = "event_year", most: int = 20, pre: int = 3, least_pre: int = 2, threshold: float = 0.8, sustain: int = 2, least_baseline: float = 0.05) -> DataFrame:
    """Events with baseline, trough, trough_year, recovery_year, status, dropped, last_observed_year, rate.

    baseline: median of the observed years of the `pre` before the event, at least least_pre. Values are relative to it.
    The trough is the first least of years 0 to most. Recovery is the first year from the trough on with
    threshold or more of the baseline that holds in the next observed years until `sustain` are counted. status: recovered, censored, no_baseline
    (too few years before, or a baseline under least_baseline, which has no curve). rate: relative gain a year from the trough to
    the recovery, else to the last year. A year is one array slot, so each event is one row after a single shuffle.
    """
    ids = [c for c in events.columns]
    own = events.join(yearly.where(F.col(value).isNotNull()).select(*s.keys, "year", F.col(value).alias("_v")), list(s.keys)).withColumn("_k", F.col("year") - F.col(event_year)).where(F.col("_k").between(-pre, most))
    rows = own.groupBy(*ids).agg(
        F.median(F.when(F.col("_k") < 0, F.col("_v"))).alias("_base"),
        F.count(F.when(F.col("_k") < 0, 1)).alias("_n"),
        F.sort_array(F.collect_list(F.when(F.col("_k") >= 0, F.struct(F.col("_k").alias("k"), F.col("_v").alias("v"))))).alias("_a"),
    )
    rows = rows.withColumn("baseline", F.when(F.col("_n") >= least_pre, F.col("_base")))
    fine = F.col("baseline") >= least_baseline
    rows = rows.withColumn("_r", F.when(fine, F.transform("_a", lambda p: F.struct(p["k"].alias("k"), (p["v"] / F.col("baseline")).alias("v")))))
    rows = rows.withColumn("trough", F.array_min(F.transform("_r", lambda p: p["v"]))).withColumn("_t", F.array_position(F.transform("_r", lambda p: p["v"]), F.col("trough")).cast("int"))
    held = F.filter(
        F.transform("_r", lambda p, i: F.struct(p["k"].alias("k"), ((i + 1 >= F.col("_t")) & (F.size(F.slice("_r", i + 1, sustain)) == sustain) & F.forall(F.slice("_r", i + 1, sustain), lambda q: q["v"] >= threshold)).alias("ok"))),
        lambda p: p["ok"],
    )
    rows = rows.withColumn("recovery_year", F.get(held, F.lit(0))["k"]).withColumn("last_observed_year", F.when(F.size("_r") > 0, F.element_at("_r", -1)["k"])).withColumn("trough_year", F.when(F.size("_r") > 0, F.element_at("_r", F.col("_t"))["k"]))
    end = F.coalesce("recovery_year", "last_observed_year")
    at_end = F.get(F.filter("_r", lambda p: p["k"] == end), F.lit(0))["v"]
    status = F.when(~F.coalesce(fine, F.lit(False)), "no_baseline").when(F.col("recovery_year").isNotNull(), "recovered").otherwise("censored")
    rate = F.when(end > F.col("trough_year"), (at_end - F.col("trough")) / (end - F.col("trough_year")))
    return rows.select(*ids, "baseline", "trough", "trough_year", "recovery_year", "last_observed_year", status.alias("status"), (F.col("trough") < threshold).alias("dropped"), rate.alias("rate"))


def factor_summary(outcomes: DataFrame, factors: dict[str, Column], kind: str, least: int = 5) -> DataFrame:
    """factor, kind, bin, n, n_recovered, share_recovered, median_years, by_5, by_10 for each factor's bins, over all kinds
    ('all') and each one; groups under `least` are left out. by_k counts only outcomes observed for k years or recovered before,
    and is null where fewer than `least` are. All factors and both groupings are one pass: rows are unfolded, then grouped once."""
    unfolded = F.array(*[F.struct(F.lit(n).alias("factor"), c.cast("string").alias("bin")) for n, c in factors.items()])
    both = F.array(F.lit("all"), F.col(kind))
    rows = outcomes.where(F.col("baseline").isNotNull() & F.col("last_observed_year").isNotNull()).select("*", F.inline(unfolded)).withColumn("_kind", F.explode(both)).where(F.col("bin").isNotNull())
    done = F.col("recovery_year").isNotNull()

    def by(k: int) -> Column:
        known = F.col("last_observed_year") >= k
        return F.when(F.count_if(known) >= least, F.count_if(known & done & (F.col("recovery_year") <= k)) / F.count_if(known))

    return (
        rows.groupBy("factor", F.col("_kind").alias("kind"), "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(done).alias("n_recovered"), F.median("recovery_year").alias("median_years"), by(5).alias("by_5"), by(10).alias("by_10"))
        .where(F.col("n") >= least)
        .withColumn("share_recovered", F.col("n_recovered") / F.col("n"))
    )
