"""Quality of classifications: confusion, calibration, boundaries, class weights and separability."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, pred: str, by: list[str] | None = None, ignored: list | None = None) -> DataFrame:
    """by, truth, pred, n; null and ignored truths don't count."""
    own = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    if ignored:
        own = own.where(~F.col(truth).isin(*ignored))
    return own.groupBy(*(by or []), F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(table: DataFrame, beta: float = 2.0) -> DataFrame:
    """class, support, predicted, precision, recall, f1, f_beta, iou, specificity from a confusion table; a class that is
    neither truth nor prediction is absent, and ratios without a base are null."""
    sides = table.select(F.inline(F.array(F.struct(F.col("truth").alias("class"), "n", F.lit(0).alias("side")), F.struct(F.col("pred").alias("class"), "n", F.lit(1).alias("side")))), (F.col("truth") == F.col("pred")).alias("_hit"))
    agg = sides.groupBy("class").agg(F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("support"), F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("predicted"), F.sum(F.when((F.col("side") == 0) & F.col("_hit"), F.col("n")).otherwise(0)).alias("tp"))
    total = F.sum("support").over(W.partitionBy())
    tp, s, p = F.col("tp"), F.col("support"), F.col("predicted")
    b2 = beta * beta
    return agg.select(
        "class", "support", "predicted", "tp",
        F.try_divide(tp, p).alias("precision"),
        F.try_divide(tp, s).alias("recall"),
        F.try_divide(2 * tp, s + p).alias("f1"),
        F.try_divide((1 + b2) * tp, b2 * s + p).alias("f_beta"),
        F.try_divide(tp, s + p - tp).alias("iou"),
        F.try_divide(total - s - p + tp, total - s).alias("specificity"),
        total.alias("total"),
    )


def overall_metrics(table: DataFrame) -> DataFrame:
    """One row: n, accuracy, miou_macro, miou_weighted (by support), miou_inv_freq, kappa, mcc."""
    m = class_metrics(table)
    inverse = F.when(F.col("support") > 0, 1.0 / F.col("support"))
    a = m.agg(
        F.max("total").alias("n"), F.sum("tp").alias("_tp"), F.avg("iou").alias("miou_macro"),
        F.try_divide(F.sum(F.col("iou") * F.col("support")), F.sum("support")).alias("miou_weighted"),
        F.try_divide(F.sum(F.col("iou") * inverse), F.sum(F.when(F.col("iou").isNotNull(), inverse))).alias("miou_inv_freq"),
        F.sum(F.col("support").cast("double") * F.col("predicted")).alias("_sp"), F.sum(F.col("support").cast("double") * F.col("support")).alias("_ss"), F.sum(F.col("predicted").cast("double") * F.col("predicted")).alias("_pp"),
    )
    n = F.col("n").cast("double")
    po, pe = F.col("_tp") / n, F.col("_sp") / (n * n)
    root = F.sqrt(n * n - F.col("_pp")) * F.sqrt(n * n - F.col("_ss"))
    return a.select("n", po.alias("accuracy"), "miou_macro", "miou_weighted", "miou_inv_freq", F.try_divide(po - pe, 1 - pe).alias("kappa"), F.try_divide(F.col("_tp") * n - F.col("_sp"), root).alias("mcc"))


def calibration(df: DataFrame, confidence: str, correct: Column, bins: int = 10) -> DataFrame:
    """bin, n, mean_confidence, accuracy, gap: reliability by equal bins of confidence, 1 in the last."""
    at = F.least(F.lit(bins - 1), F.floor(F.col(confidence) * bins).cast("int"))
    out = df.where(F.col(confidence).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(confidence).alias("mean_confidence"), F.avg(correct.cast("double")).alias("accuracy"))
    return out.withColumn("gap", F.abs(F.col("mean_confidence") - F.col("accuracy")))


def calibration_error(table: DataFrame) -> DataFrame:
    return table.agg((F.sum(F.col("gap") * F.col("n")) / F.sum("n")).alias("ece"), F.max("gap").alias("worst_gap"), F.sum("n").alias("n"))


def neighbours(df: DataFrame, by: list[str], row: str, col: str, reach: int, value: str) -> DataFrame:
    """by, row, col, _nv: the values within `reach` cells of each cell, one row each, cells outside absent. Each cell is sent to
    (2 reach + 1)^2 places; a hash join on the cell, no range condition."""
    steps = F.array(*[F.struct(F.lit(a).alias("_dr"), F.lit(b).alias("_dc")) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)])
    return df.select(*by, row, col, F.col(value).alias("_nv"), F.inline(steps)).select(*by, (F.col(row) + F.col("_dr")).alias(row), (F.col(col) + F.col("_dc")).alias(col), "_nv")


def boundary(labels: DataFrame, by: list[str], row: str, col: str, label: str, width: int = 1) -> DataFrame:
    """labels with on_boundary: whether a cell within `width` has a neighbour of another class.

    Places hold the least and the greatest class near them before they meet the cells. They are met by merging: the planner takes
    the ninefold places for as small as the cells that they come from, and would send them whole.
    """
    steps = F.array(*[F.struct(F.lit(a).alias("_dr"), F.lit(b).alias("_dc")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    sent = labels.where(F.col(label).isNotNull()).select(*by, row, col, F.col(label).alias("_nv"), F.inline(steps))
    near = sent.select(*by, (F.col(row) + F.col("_dr")).alias(row), (F.col(col) + F.col("_dc")).alias(col), "_nv", ((F.col("_dr") == 0) & (F.col("_dc") == 0)).alias("_own"))
    edge = near.groupBy(*by, row, col).agg(F.max("_own").alias("_own"), (F.min("_nv") != F.max("_nv")).alias("_edge")).where("_own and _edge").select(*by, row, col, "_edge")
    if width > 1:
        edge = neighbours(edge, by, row, col, width - 1, "_edge").select(*by, row, col, F.col("_nv").alias("_edge")).distinct()
    return labels.join(edge.hint("merge"), [*by, row, col], "left").withColumn("on_boundary", F.coalesce("_edge", F.lit(False))).drop("_edge")


def tolerant_hits(df: DataFrame, by: list[str], row: str, col: str, truth: str, pred: str, reach: int = 1) -> DataFrame:
    """truth, pred, n where a prediction counts as right if its class is the truth of some cell within `reach`.

    Each class near a place goes there once and meets the predictions of it, by merging for the reason given in boundary().
    """
    own = df.where(F.col(truth).isNotNull()).select(*by, row, col, truth, pred)
    near = neighbours(own, by, row, col, reach, truth).distinct().withColumnRenamed("_nv", pred).withColumn("_ok", F.lit(True))
    cells = own.join(near.hint("merge"), [*by, row, col, pred], "left").groupBy(*by, row, col, truth, pred).agg(F.max("_ok").alias("_ok"))
    return cells.groupBy(F.col(truth).alias("truth"), F.when(F.col("_ok"), F.col(truth)).otherwise(F.col(pred)).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def feature_moments(df: DataFrame, features: str) -> DataFrame:
    """feature, mean, std (sample) of each array place over all rows; null and non-finite values are left out."""
    cells = df.select(F.posexplode(features).alias("feature", "x")).where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")))
    return cells.groupBy("feature").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.count("x").alias("n"))


def normalise(features: Column, mean: list[float], std: list[float]) -> Column:
    """Array of (x - mean) / max(std, 1e-6), 0 for what isn't finite."""
    m, s = F.array(*[F.lit(float(x)) for x in mean]), F.array(*[F.lit(max(float(x), 1e-6)) for x in std])
    return F.transform(features, lambda x, i: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise((x - F.get(m, i)) / F.get(s, i)))


def class_counts(df: DataFrame, scene: list[str], label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(*scene, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def inverse_frequency_weights(counts: DataFrame, eps: float = 1e-6) -> DataFrame:
    """class, n, weight: inverse share, scaled to a mean of 1."""
    total = F.sum("n").over(W.partitionBy())
    own = counts.groupBy("class").agg(F.sum("n").alias("n")).withColumn("_w", 1.0 / (F.col("n") / total + eps))
    return own.select("class", "n", (F.col("_w") / F.avg("_w").over(W.partitionBy())).alias("weight"))


def power_weights(counts: DataFrame, power: float = 0.5, most: float = 10.0) -> DataFrame:
    """class, n, weight: (median count / count) ^ power, at most `most`, scaled to a mean of 1."""
    own = counts.groupBy("class").agg(F.sum("n").alias("n"))
    own = own.withColumn("_w", F.least(F.lit(most), F.pow(F.median("n").over(W.partitionBy()) / F.col("n"), F.lit(power))))
    return own.select("class", "n", (F.col("_w") / F.avg("_w").over(W.partitionBy())).alias("weight"))


def sampling_weights(counts: DataFrame, scene: list[str], rare_share: float = 0.05, boost: float = 4.0) -> DataFrame:
    """scene, rare_share, weight: 1 + boost * the scene's share of classes rarer than rare_share of all."""
    shares = counts.groupBy("class").agg(F.sum("n").alias("_c")).withColumn("_rare", F.col("_c") / F.sum("_c").over(W.partitionBy()) < rare_share).select("class", "_rare")
    own = counts.join(shares, "class").groupBy(*scene).agg((F.sum(F.when(F.col("_rare"), F.col("n")).otherwise(0)) / F.sum("n")).alias("rare_share"))
    return own.withColumn("weight", 1.0 + boost * F.col("rare_share"))


def seed_summary(runs: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    """by, metric, mean, std (population), min, max, n over runs."""
    rows = runs.select(*by, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    return rows.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n"))


def single_separability(df: DataFrame, label: str, features: str) -> DataFrame:
    """class_a, class_b, feature, jm: Jeffries-Matusita distance of two classes in one feature, as normal distributions."""
    cells = df.select(F.col(label).alias("class"), F.posexplode(features).alias("feature", "x")).where(F.col("x").isNotNull())
    m = cells.groupBy("class", "feature").agg(F.avg("x").alias("mu"), (F.var_samp("x") + 1e-6).alias("v"))
    a, b = m.alias("a"), m.alias("b")
    va, vb = F.col("a.v"), F.col("b.v")
    v = (va + vb) / 2
    d = F.col("a.mu") - F.col("b.mu")
    distance = d * d / (8 * v) + 0.5 * F.log(v / F.sqrt(va * vb))
    pairs = a.join(b, (F.col("a.feature") == F.col("b.feature")) & (F.col("a.class") < F.col("b.class")))
    return pairs.select(F.col("a.class").alias("class_a"), F.col("b.class").alias("class_b"), F.col("a.feature").alias("feature"), (2 * (1 - F.exp(-distance))).alias("jm"))


def separability(df: DataFrame, label: str, features: str, n: int) -> DataFrame:
    """class_a, class_b, jm over all n features, by normal distributions. Every partition sends a class's sums of 1, x and x x'; they
    are added up in Spark, and 1 + n + n * n numbers a class reach the pairs. Classes are few, as in any confusion table."""
    cells = df.select(F.col(label).alias("c"), F.col(features).alias("x")).where(F.col(label).isNotNull() & (F.size(features) == n))
    kind = dict(df.dtypes)[label]

    def sums(batches):
        for batch in batches:
            for c, part in batch.groupby("c"):
                x = np.stack([np.asarray(v, float) for v in part["x"]])
                all_ = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                yield pd.DataFrame({"c": c, "pos": np.arange(len(all_)), "v": all_})

    added = cells.mapInPandas(sums, f"c {kind}, pos int, v double").groupBy("c", "pos").agg(F.sum("v").alias("v"))
    flat: dict = {}
    for r in added.collect():
        flat.setdefault(r["c"], np.zeros(1 + n + n * n))[r["pos"]] = r["v"]
    models = {}
    for c, all_ in flat.items():
        size, mean = all_[0], all_[1 : n + 1] / all_[0]
        models[c] = (mean, (all_[n + 1 :].reshape(n, n) - size * np.outer(mean, mean)) / max(1, size - 1) + 1e-6 * np.eye(n))
    out = []
    for a, b in combinations(sorted(models), 2):
        (ma, sa), (mb, sb) = models[a], models[b]
        mid, d = (sa + sb) / 2, ma - mb
        logs = [np.linalg.slogdet(x)[1] for x in (mid, sa, sb)]
        out.append((a, b, float(2 * (1 - np.exp(-(d @ np.linalg.solve(mid, d) / 8 + 0.5 * (logs[0] - (logs[1] + logs[2]) / 2)))))))
    return df.sparkSession.createDataFrame(out, f"class_a {kind}, class_b {kind}, jm double")


def feature_correlations(df: DataFrame, features: str, n: int, least: float = 0.95) -> DataFrame:
    """feature_a, feature_b, r of all pairs of array places with |r| >= least: one aggregation with a column for each pair."""
    pairs = list(combinations(range(n), 2))
    row = df.select(F.col(features).alias("x")).agg(*[F.corr(F.get("x", F.lit(a)).cast("double"), F.get("x", F.lit(b)).cast("double")).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    unfolded = row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])))
    return unfolded.where(F.abs("r") >= least)


def correlation_matrix(df: DataFrame, features: str, n: int, least: float = 0.95) -> DataFrame:
    """feature_correlations for many places: every partition sends the sums of each pair, which are added up in Spark, and
    4 n * n numbers reach the driver. Missing values count in no pair that they are part of."""
    kinds = 4

    def sums(batches):
        total = np.zeros((kinds, n, n))
        for batch in batches:
            x = np.full((len(batch), n), np.nan)
            for row, v in zip(x, batch["x"], strict=True):
                if v is not None:
                    row[: min(n, len(v))] = np.asarray(v[:n], float)
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pd.DataFrame({"pos": np.arange(total.size), "v": total.ravel()})

    added = df.select(F.col(features).alias("x")).mapInPandas(sums, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v"))
    flat = np.zeros(kinds * n * n)
    for r in added.collect():
        flat[r["pos"]] = r["v"]
    size, s, ss, xy = flat.reshape(kinds, n, n)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = (size * xy - s * s.T) / np.sqrt((size * ss - s * s) * (size * ss.T - s.T * s.T))
    out = [(a, b, float(r[a, b])) for a, b in combinations(range(n), 2) if abs(r[a, b]) >= least]
    return df.sparkSession.createDataFrame(out, "feature_a int, feature_b int, r double")


def majority_blocks(labels: DataFrame, by: list[str], row: str, col: str, label: str, size: int) -> DataFrame:
    """by, row, col, class of blocks of size x size cells: the commonest, with no-data competing; smallest class on ties, no-data last."""
    counts = labels.groupBy(*by, F.floor(F.col(row) / size).cast("int").alias(row), F.floor(F.col(col) / size).cast("int").alias(col), label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*by, row, col).agg(F.min_by(F.struct(F.col(label)), F.struct(-F.col("_n"), F.col(label).isNull(), F.col(label))).alias("_b")).select(*by, row, col, F.col(f"_b.{label}").alias(label))
