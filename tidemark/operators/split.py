"""Seeded splits and samples by digest order, so that reruns and other partitionings agree."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Groups whose shares of classes are weighed at once.
BLOCK = 1 << 16
STRATA = ((1, 1), (2, 4), (5, None))


def draw(seed: int, *columns: str) -> Column:
    """Order of a row under a seed: MD5 of the seed and the columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def split_tiles(scenes: DataFrame, tile: str, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 0) -> DataFrame:
    """tile, n_scenes, stratum, split: tiles shuffled within strata by their number of scenes; of each stratum the first rounded
    shares go to val and test, the others to train. Train is never empty while there's a tile: with too few, the last tile stays."""
    size = scenes.groupBy(tile).agg(F.count(F.lit(1)).alias("n_scenes"))
    stratum = F.when(F.col("n_scenes") <= 1, 0).when(F.col("n_scenes") <= 4, 1).otherwise(2)
    own = size.withColumn("stratum", stratum)
    group = W.partitionBy("stratum")
    own = own.withColumn("_r", F.row_number().over(group.orderBy(draw(seed, tile), tile))).withColumn("_n", F.count(F.lit(1)).over(group))
    val = F.floor(F.col("_n") * ratios[1] + 0.5)
    test = F.floor(F.col("_n") * ratios[2] + 0.5)
    val, test = F.least(val, F.col("_n") - 1), F.least(test, F.col("_n") - 1 - F.least(val, F.col("_n") - 1))
    return own.select(tile, "n_scenes", "stratum", F.when(F.col("_r") <= val, "val").when(F.col("_r") <= val + test, "test").otherwise("train").alias("split"))


def overlaps(parts: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that are in more than one split; empty for a good split."""
    return parts.groupBy(key).agg(F.countDistinct(split).alias("n_splits")).where(F.col("n_splits") > 1)


def share_warnings(parts: DataFrame, counts: DataFrame, tile: str, ratios: dict[str, float], high: float = 2.0, low: float = 0.4, single: float = 0.5) -> DataFrame:
    """split, class, share, target, warning: classes far from a split's target share, and tiles that hold most of a class in a split."""
    own = counts.join(parts.select(tile, "split"), tile)
    by_class = own.groupBy("split", "class").agg(F.sum("n").alias("_n"), F.max("n").alias("_most"))
    share = F.col("_n") / F.sum("_n").over(W.partitionBy("class"))
    target = F.lit(None).cast("double")
    for name, t in ratios.items():
        target = F.when(F.col("split") == name, t).otherwise(target)
    out = by_class.withColumn("share", share).withColumn("target", target)
    warning = F.when(F.col("share") > high * F.col("target"), "too much").when(F.col("share") < low * F.col("target"), "too little").when(F.col("_most") > single * F.col("_n"), "single tile")
    return out.withColumn("warning", warning).where("warning is not null").select("split", "class", "share", "target", "warning")


def missing_classes(parts: DataFrame, counts: DataFrame, tile: str) -> DataFrame:
    """split, class pairs without a pixel, with donor: the tile that has most of the class, the largest id on ties. It is of train;
    for a class missing there, of val, or else of test. repair_coverage moves tiles by this choice."""
    own = counts.join(parts.select(tile, "split"), tile)
    every = own.select("class").distinct().withColumn("split", F.explode(F.array(F.lit("train"), F.lit("val"), F.lit("test"))))
    none = every.join(own.where("n > 0").select("class", "split").distinct(), ["class", "split"], "left_anti")
    most = own.where("n > 0").groupBy("class", "split").agg(F.max_by(tile, F.struct("n", tile)).alias("_d"))
    of = lambda name: F.max(F.when(F.col("split") == name, F.col("_d")))
    donors = most.groupBy("class").agg(of("train").alias("_train"), of("val").alias("_val"), of("test").alias("_test"))
    donor = F.when(F.col("split") == "train", F.coalesce("_val", "_test")).otherwise(F.col("_train"))
    return none.join(donors, "class", "left").select("class", "split", donor.alias("donor"))


def repaired(parts: dict, counts: list[tuple], enabled: tuple[str, ...] = ("train", "val", "test")) -> dict:
    """Splits by tile after tiles have moved so that every split sees each sensor, then each class, then each pair of them.

    counts: (tile, sensor, class, n), an aggregate with a row for each tile, sensor and class, on the driver; class may be null.
    val and test are served from train, then train from val or else test; a split never gives its last tile. Donors are, for a
    sensor, the first tile by id; for a class, the tile that has most of it, the largest id on ties; for a pair, the tile whose
    leaving costs its split the fewest pairs, then the one of fewest pairs, then by id, unless every tile of the split has the
    pair and the cheapest still costs one.
    """
    own = dict(parts)
    sensors: dict = {t: set() for t in own}
    classes: dict = {t: {} for t in own}
    pairs: dict = {t: set() for t in own}
    for t, sensor, c, n in counts:
        sensors[t].add(sensor)
        if c is not None and n > 0:
            classes[t][c] = classes[t].get(c, 0) + n
            pairs[t].add((sensor, c))

    def members(split: str) -> list:
        return sorted(t for t, s in own.items() if s == split)

    def by_sensor(donors: list, sensor):
        return next((t for t in donors if sensor in sensors[t]), None)

    def by_class(donors: list, c):
        return max((t for t in donors if c in classes[t]), key=lambda t: (classes[t][c], t), default=None)

    def by_pair(donors: list, pair):
        able = [t for t in donors if pair in pairs[t]]
        if not able:
            return None
        held = Counter(p for t in donors for p in pairs[t])
        cost = {t: (sum(held[p] == 1 for p in pairs[t]), len(pairs[t]), t) for t in able}
        best = min(able, key=cost.get)
        return None if cost[best][0] > 0 and len(able) == len(donors) else best

    for has, pick in ((sensors, by_sensor), (classes, by_class), (pairs, by_pair)):
        every = sorted({x for t in own for x in has[t]})
        for to, sources in (("val", ["train"]), ("test", ["train"]), ("train", ["val", "test"])):
            if to not in enabled:
                continue
            for x in every:
                if any(x in has[t] for t in members(to)):
                    continue
                for source in sources:
                    donors = members(source)
                    chosen = pick(donors, x) if len(donors) > 1 else None
                    if chosen is not None:
                        own[chosen] = to
                        break
    return own


def repair_coverage(parts: DataFrame, counts: DataFrame, tile: str, enabled: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """tile, split after repaired(). counts: tile, sensor, class, n."""
    before = {r[0]: r[1] for r in parts.select(tile, "split").collect()}
    seen = [tuple(r) for r in counts.join(parts.select(tile), tile).select(tile, "sensor", "class", "n").collect()]
    return parts.sparkSession.createDataFrame(sorted(repaired(before, seen, enabled).items()), f"{tile} {dict(parts.dtypes)[tile]}, split string")


def folds(scenes: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """key, fold: keys dealt in digest order to k folds of about equal number.

    A key's number in that order is its place among the digests that begin alike, and the count of those before: no task orders
    more than a part of 4096.
    """
    own = scenes.select(key).distinct().withColumn("_d", draw(seed, key)).withColumn("_b", F.substring("_d", 1, 3))
    counts = own.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_b", (F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    place = F.row_number().over(W.partitionBy("_b").orderBy("_d", key)) - 1
    return own.withColumn("_p", place).join(before, "_b").select(key, F.pmod(F.col("_p") + F.col("_before"), F.lit(k)).alias("fold"))


def dealt_by_rarity(sizes: np.ndarray, table: np.ndarray, k: int) -> np.ndarray:
    """Fold of each group: groups of most rare-class content first, each to the fold whose class shares and scene counts it
    unbalances least, the first on ties. sizes: scenes of each group, in the order that holds on ties; table: group by class,
    which becomes the classes' shares."""
    k = max(2, min(k, len(sizes)))
    total = table.sum(axis=0) + 1e-9
    rarity = 1.0 / (total / total.sum() + 1e-6)
    share = np.divide(table, total, out=table)
    score = np.concatenate([np.zeros(0), *[(share[a : a + BLOCK] * rarity).sum(axis=1) for a in range(0, len(share), BLOCK)]])
    order = np.argsort(-score, kind="stable")
    del score
    loads, held, out = np.zeros((k, table.shape[1])), np.zeros(k), np.zeros(len(sizes), np.int32)
    target = sizes.sum() / k
    for g in order:
        cost = ((loads + share[g]) ** 2).sum(axis=1) + 0.05 * ((held + sizes[g]) / target) ** 2
        to = cost.argmin()
        out[g] = to
        loads[to] += share[g]
        held[to] += sizes[g]
    return out


def balanced_folds(scenes: DataFrame, counts: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """key, fold by dealt_by_rarity; digest order on ties. scenes: a row for each scene; counts: key, class, n, an aggregate.

    The choice is greedy and so is made on the driver, over flat arrays: a key, its size and fold, and a number for each class.
    """
    spark, kind = scenes.sparkSession, dict(scenes.dtypes)[key]
    seen = counts.where(F.col("class").isNotNull())
    classes = sorted(r[0] for r in seen.select("class").distinct().collect())
    at = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("class")) if classes else F.lit(0)
    size = scenes.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(key, "_n", F.lit(None).cast("int").alias("_c"), F.lit(None).cast("double").alias("_x"))
    both = size.unionAll(seen.select(F.col(key).cast(kind), F.lit(None).cast("long"), (at - 1).cast("int"), F.col("n").cast("double")))
    own = both.groupBy(key).agg(F.sum("_n").alias("_n"), F.collect_list("_c").alias("_c"), F.collect_list("_x").alias("_x")).where(F.col("_n").isNotNull())
    rows = own.orderBy(draw(seed, key), key).toArrow()
    keys, sizes, table = rows[key], rows["_n"].to_numpy().astype(np.float64), np.zeros((rows.num_rows, len(classes)))
    group = 0
    for batch in rows.select(["_c", "_x"]).to_batches():
        c, x = batch.columns
        owner = group + np.repeat(np.arange(len(c)), np.diff(c.offsets.to_numpy()))
        np.add.at(table, (owner, c.flatten().to_numpy()), x.flatten().to_numpy())
        group += len(c)
    del rows
    fold = dealt_by_rarity(sizes, table, k)
    return spark.createDataFrame(pa.table({key: keys, "fold": fold})).select(F.col(key).cast(kind), "fold")


def sample_per_scene(pixels: DataFrame, scene: list[str], cell: list[str], n: int, seed: int = 0) -> DataFrame:
    """Up to n rows of each scene, drawn by digest."""
    return pixels.withColumn("_r", F.row_number().over(W.partitionBy(*scene).orderBy(draw(seed, *scene, *cell), *cell))).where(F.col("_r") <= n).drop("_r")


def evenly_spaced(cells: DataFrame, scene: list[str], order: list[str], k: int) -> DataFrame:
    """k cells of each scene at even distances in its order; all if it has fewer."""
    group = W.partitionBy(*scene)
    own = cells.withColumn("_r", F.row_number().over(group.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(group))
    step = F.floor(F.col("_r") * k / F.col("_n")) != F.floor((F.col("_r") - 1) * k / F.col("_n"))
    return own.where((F.col("_n") <= k) | (F.col("_r") == 0) | step).drop("_r", "_n")


def labelled_patches(labels: DataFrame, scene: list[str], row: str, col: str, label: str, size: int, least: float = 0.2) -> DataFrame:
    """scene, patch row and column, labelled share of patches with at least `least` labelled cells."""
    g = labels.groupBy(*scene, F.floor(F.col(row) / size).cast("int").alias("patch_row"), F.floor(F.col(col) / size).cast("int").alias("patch_col"))
    return g.agg((F.count(label) / F.lit(float(size * size))).alias("labelled")).where(F.col("labelled") >= least)


def anneal(counts: list[tuple[str, int, int]], parts: dict[str, str], ratios: dict[str, float], steps: int = 60_000, hot: float = 0.3, cold: float = 0.002, seed: int = 0) -> dict[str, str]:
    """Swaps of tiles between splits that bring every class's shares nearer to the ratios, by simulated annealing.

    counts: (tile, class, n), an aggregate with a row for each tile and class, on the driver. Sizes of splits stay.
    The energy is the sum over classes and splits of squared distance of shares; a swap changes two columns of it.
    """
    rng = np.random.default_rng(seed)
    tiles, classes, names = sorted(parts), sorted({c for _, c, _ in counts}), list(ratios)
    at = {t: i for i, t in enumerate(tiles)}
    table = np.zeros((len(tiles), len(classes)))
    for t, c, n in counts:
        table[at[t], classes.index(c)] += n
    table /= np.maximum(table.sum(axis=0), 1)
    own = np.array([names.index(parts[t]) for t in tiles])
    share = np.stack([table[own == k].sum(axis=0) for k in range(len(names))])
    goal = np.array([ratios[n] for n in names])[:, None]
    energy = ((share - goal) ** 2).sum()
    best, kept = energy, own.copy()
    for step in range(steps if len(tiles) > 1 else 0):
        i, j = rng.integers(len(tiles), size=2)
        if own[i] == own[j]:
            continue
        d = table[i] - table[j]
        new = share.copy()
        new[own[i]] -= d
        new[own[j]] += d
        after = ((new - goal) ** 2).sum()
        heat = hot * (cold / hot) ** (step / steps) * 0.01
        if after <= energy or rng.random() < np.exp((energy - after) / heat):
            own[i], own[j], share, energy = own[j], own[i], new, after
            if energy < best:
                best, kept = energy, own.copy()
    return {t: names[k] for t, k in zip(tiles, kept)}


def drawn(scenes: DataFrame, weight: str, key: list[str], n: int, seed: int = 0) -> DataFrame:
    """draw, key: n scenes drawn with replacement by weight. Draw k goes to the scene in whose part of the summed weights the k-th
    number falls; numbers come from digests of seed and k. Scenes are few, a row for each."""
    order = W.orderBy(*key)
    whole = W.partitionBy()
    to = F.sum(weight).over(order.rowsBetween(W.unboundedPreceding, 0)) / F.sum(weight).over(whole)
    parts = scenes.where(F.col(weight) > 0).withColumn("_to", to).withColumn("_from", F.coalesce(F.lag("_to").over(order), F.lit(0.0)))
    picks = scenes.sparkSession.range(n).select(F.col("id").alias("draw"), (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)).alias("_u"))
    cells = 64
    wide = parts.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") * cells), F.least(F.floor(F.col("_to") * cells), F.lit(cells - 1)))))
    return picks.withColumn("_cell", F.floor(F.col("_u") * cells)).join(wide, "_cell").where("_u >= _from and _u < _to").select("draw", *key)


def bootstrap(rows: DataFrame, key: list[str], rounds: int, seed: int = 0, most: int = 12) -> DataFrame:
    """rows with round and times: how often a row is in each of so many samples with replacement, as independent Poisson(1) counts
    from digests; rows that a round leaves out are absent. Counts above `most` are given as `most`; none of the digests' 32 bits is above 12."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("round").cast("string"), *[F.col(k).cast("string") for k in key])), 1, 8), 16, 10).cast("double") / float(1 << 32)
    out = rows.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("_u", u)
    total, term, times = 0.0, 0.36787944117144233, F.lit(0)
    for k in range(1, most + 1):
        total, term = total + term, term / k
        times = F.when(F.col("_u") >= total, k).otherwise(times)
    return out.withColumn("times", times).where("times > 0").drop("_u")
