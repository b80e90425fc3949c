"""Classifiers as expressions and estimators: threshold rules, ambiguity, priority, losses, forests."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quality import class_metrics, confusion


def threshold_class(features: Column, rules: list[tuple[int, str, float, int]], default: int) -> Column:
    """First rule (feature place, '<' or '>=', bound, class) that holds gives the class: one CASE, no function call."""
    out = F.lit(default)
    for place, way, bound, cls in reversed(rules):
        if way not in ("<", ">="):
            raise ValueError(f"unknown comparison {way!r}")
        x = F.get(features, F.lit(place)).cast("double")
        out = F.when((x < bound) if way == "<" else (x >= bound), cls).otherwise(out)
    return out


def one_hot(cls: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i == cls, 1.0).otherwise(0.0))


def search_thresholds(df: DataFrame, features: str, label: str, classes: list[int], n_features: int, trials: int = 20, seed: int = 0, grid: list[float] | None = None) -> tuple[list[tuple[int, str, float, int]], float]:
    """The best of some random rule lists by macro IoU, or of all single-bound ones over grid. All trials are scored in one pass,
    as columns of one aggregation."""
    rng = random.Random(seed)
    ends = df.agg(*[F.percentile(F.get(features, F.lit(i)).cast("double"), F.array(F.lit(0.05), F.lit(0.95))).alias(f"q{i}") for i in range(n_features)]).first()
    plans = []
    if grid:
        plans = [[(i, ">=", ends[i][0] + g * (ends[i][1] - ends[i][0]), classes[1])] for i in range(n_features) for g in grid]
    else:
        plans = [[(i := rng.randrange(n_features), rng.choice(["<", ">="]), rng.uniform(*ends[i]), c) for c in classes[1:]] for _ in range(trials)]
    own = df.where(F.col(label).isNotNull())
    hits = own.select(F.col(label).alias("truth"), F.posexplode(F.array(*[threshold_class(F.col(features), p, classes[0]) for p in plans])).alias("plan", "pred"))
    table = hits.groupBy("plan", "truth", "pred").agg(F.count(F.lit(1)).alias("n")).collect()
    best = (-1.0, 0)
    for k in range(len(plans)):
        t = {(r["truth"], r["pred"]): r["n"] for r in table if r["plan"] == k}
        ious = []
        for c in classes:
            tp, union = t.get((c, c), 0), sum(v for (a, b), v in t.items() if a == c or b == c)
            if union:
                ious.append(tp / union)
        best = max(best, (sum(ious) / len(ious) if ious else 0.0, -k))
    return plans[-best[1]], best[0]


def ranked(probs: Column) -> Column:
    """(p, class) of each class by falling probability, smaller class on ties."""
    pairs = F.transform(probs, lambda p, i: F.struct((-p.cast("double")).alias("m"), i.cast("int").alias("c")))
    return F.array_sort(pairs)


def decide(probs: Column, priority: list[int], threshold: float = 0.1) -> Column:
    """The likeliest class; when the second is nearer than the threshold, whichever of the two comes first in priority."""
    top = ranked(probs)
    a, b = F.get(top, F.lit(0)), F.get(top, F.lit(1))
    rank = lambda c: F.when(F.array_position(F.array(*[F.lit(x) for x in priority]), c) == 0, len(priority) + 1).otherwise(F.array_position(F.array(*[F.lit(x) for x in priority]), c))
    close = (b["m"] - a["m"]) < threshold
    return F.when(b.isNotNull() & close & (rank(b["c"]) < rank(a["c"])), b["c"]).otherwise(a["c"])


def confidence(probs: Column) -> Column:
    return F.array_max(probs)


def remap(labels: DataFrame, label: str, merge: dict[int, int], known: list[int], nodata: int | None = None) -> DataFrame:
    """Labels with some classes folded into others; unknown, self and chained merges are errors, unknown labels become nodata."""
    for a, b in merge.items():
        if a not in known or b not in known:
            raise ValueError(f"unknown class in merge {a} -> {b}")
        if a == b or b in merge:
            raise ValueError(f"class {a} is merged into itself or through another")
    out = F.when(F.col(label).isin(*known), F.col(label)).otherwise(F.lit(nodata))
    for a, b in merge.items():
        out = F.when(F.col(label) == a, b).otherwise(out)
    return labels.withColumn(label, out)


def to_dense(labels: DataFrame, dim: DataFrame, label: str, back: bool = False) -> DataFrame:
    """Raw ids to dense ids by the class dimension, or back; unknown ids become null. The dimension has a row a class."""
    a, b = ("dense_id", "raw_id") if back else ("raw_id", "dense_id")
    own = F.broadcast(dim.select(F.col(a).alias("_from"), F.col(b).alias("_to")))
    return labels.join(own, F.col(label) == F.col("_from"), "left").withColumn(label, F.col("_to")).drop("_from", "_to")


def cross_entropy(probs: Column, truth: Column, weight: Column | float = 1.0, gamma: float = 0.0) -> Column:
    p = F.greatest(F.element_at(probs, truth + 1), F.lit(1e-12))
    return -(F.lit(weight) if isinstance(weight, float) else weight) * F.pow(1 - p, F.lit(gamma)) * F.log(p)


def dice_loss(df: DataFrame, probs: str, truth: str, n: int, smooth: float = 1.0) -> DataFrame:
    """One row: 1 - mean over classes of the soft Dice coefficient."""
    cells = df.where(F.col(truth).isNotNull()).select(F.col(truth).alias("t"), F.posexplode(probs).alias("c", "p")).where(F.col("c") < n)
    per = cells.groupBy("c").agg(((2 * F.sum(F.when(F.col("t") == F.col("c"), F.col("p")).otherwise(0.0)) + smooth) / (F.sum("p") + F.sum((F.col("t") == F.col("c")).cast("double")) + smooth)).alias("d"))
    return per.agg((1 - F.avg("d")).alias("dice_loss"))


def directional_penalty(probs: Column, truth: Column, true_class: int, predicted_class: int, beta: float) -> Column:
    """beta times the probability put on predicted_class where the truth is true_class."""
    return F.when(truth == true_class, beta * F.element_at(probs, predicted_class + 1)).otherwise(0.0)


def permuted(df: DataFrame, features: str, places: list[int], key: list[str], seed: int = 0, group_rows: int = 100_000) -> DataFrame:
    """features with some places taken together from another row: rows are dealt by hash to groups of about group_rows, and inside a
    group the rows in key order take them from the rows in digest order."""
    from .split import draw

    groups = max(1, df.count() // group_rows)
    own = df.withColumn("_g", F.pmod(F.xxhash64(*key), F.lit(groups)))
    a = own.withColumn("_n", F.row_number().over(W.partitionBy("_g").orderBy(*key)))
    b = own.select("_g", F.col(features).alias("_f"), F.row_number().over(W.partitionBy("_g").orderBy(draw(seed, *key), *key)).alias("_n"))
    mixed = F.transform(F.col(features), lambda x, i: F.when(i.isin(*places), F.get("_f", i)).otherwise(x))
    return a.join(b, ["_g", "_n"]).withColumn(features, mixed).drop("_g", "_n", "_f")


def permutation_importance(df: DataFrame, features: str, truth: str, groups: dict[str, list[int]], predict: Callable[[Column], Column], key: list[str], seed: int = 0) -> DataFrame:
    """group, base_miou, miou, importance: loss of macro IoU when a group of features is shuffled together."""

    def miou(d: DataFrame) -> DataFrame:
        return class_metrics(confusion(d.withColumn("_p", predict(F.col(features))), truth, "_p")).agg(F.avg("iou").alias("miou"))

    out = miou(df).withColumn("group", F.lit(None).cast("string"))
    for name, places in groups.items():
        out = out.unionByName(miou(permuted(df, features, places, key, seed)).withColumn("group", F.lit(name)))
    base = F.max(F.when(F.col("group").isNull(), F.col("miou"))).over(W.partitionBy())  # over a row for each group
    return out.withColumn("base_miou", base).where("group is not null").select("group", "base_miou", "miou", (F.col("base_miou") - F.col("miou")).alias("importance"))


def random_forest(df: DataFrame, features: str, label: str, trees: int = 20, depth: int = 8, seed: int = 7):
    """A fitted forest and the frame with prediction and probability, classes weighted by inverse frequency."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    own = df.where(F.col(label).isNotNull()).withColumn("_x", array_to_vector(F.col(features).cast("array<double>"))).withColumn("_y", F.col(label).cast("double"))
    whole = W.partitionBy()
    counts = own.groupBy("_y").count().withColumn("_w", F.sum("count").over(whole) / (F.col("count") * F.count(F.lit(1)).over(whole))).select("_y", "_w")
    model = RandomForestClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", numTrees=trees, maxDepth=depth, seed=seed).fit(own.join(F.broadcast(counts), "_y"))
    return model, model.transform(own).drop("_x", "_y", "rawPrediction")


def boosted_trees(df: DataFrame, features: str, label: str, rounds: int = 10, depth: int = 4, seed: int = 7):
    """One against the rest with boosted trees: the nearest built-in form of a multi-class booster. The fitted model and
    the frame with prediction."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.functions import array_to_vector

    own = df.where(F.col(label).isNotNull()).withColumn("_x", array_to_vector(F.col(features).cast("array<double>"))).withColumn("_y", F.col(label).cast("double"))
    base = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=rounds, maxDepth=depth, seed=seed)
    model = OneVsRest(classifier=base, featuresCol="_x", labelCol="_y").fit(own)
    return model, model.transform(own).drop("_x", "_y", "rawPrediction")


def total_penalty(probs: Column, truth: Column, penalties: list[tuple[int, int, float]]) -> Column:
    """Sum of directional penalties (true class, predicted class, beta); those without a positive beta don't count."""
    out = F.lit(0.0)
    for true_class, predicted_class, beta in penalties:
        if beta > 0:
            out = out + directional_penalty(probs, truth, true_class, predicted_class, beta)
    return out


def deep_supervision(aux: list[Column], truth: Column, weights: list[float], weight: Column | float = 1.0) -> Column:
    """Cross entropies of side outputs, each with its weight, added up."""
    out = F.lit(0.0)
    for probs, w in zip(aux, weights, strict=True):
        out = out + w * cross_entropy(probs, truth, weight)
    return out


def moving_average(old: Column, new: Column, decay: float) -> Column:
    """Arrays of weights: decay * old + (1 - decay) * new, place by place."""
    return F.zip_with(old, new, lambda a, b: a * decay + b * (1.0 - decay))


class Centroids:
    """A class for each row by the nearest mean of the classes in some places of an array: one aggregation to fit, an expression to predict."""

    def __init__(self, places: list[int]):
        self.places, self.means = places, {}

    def fit(self, df: DataFrame, features: str, label: str) -> Centroids:
        rows = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("c")).agg(*[F.avg(F.get(features, F.lit(i)).cast("double")).alias(f"m{i}") for i in self.places]).collect()
        self.means = {r["c"]: [r[f"m{i}"] for i in self.places] for r in sorted(rows, key=lambda r: r["c"])}
        return self

    def predict(self, features: Column) -> Column:
        """The nearest class, the smallest on ties; null before there is any."""
        away = [F.struct(sum((F.pow(F.get(features, F.lit(i)).cast("double") - F.lit(m), F.lit(2.0)) for i, m in zip(self.places, means, strict=True)), F.lit(0.0)).alias("d"), F.lit(c).alias("c")) for c, means in self.means.items()]
        return F.array_min(F.array(*away))["c"] if away else F.lit(None).cast("int")


def miou_of(df: DataFrame, truth: str, pred: Column) -> DataFrame:
    return class_metrics(confusion(df.withColumn("_p", pred), truth, "_p")).agg(F.avg("iou").alias("miou"))


def drop_column_importance(df: DataFrame, features: str, truth: str, groups: dict[str, list[int]], places: list[int], least: float = 0.0, kind: Callable[[list[int]], Centroids] = Centroids) -> DataFrame:
    """group, base_miou, miou, importance, drop: a model fitted anew without each group of features; what loses no more than `least`
    can be dropped."""
    def score(used: list[int]) -> DataFrame:
        return miou_of(df, truth, kind(used).fit(df, features, truth).predict(F.col(features)))

    out, base = None, score(places).withColumnRenamed("miou", "base_miou")
    for name, own in groups.items():
        one = score([p for p in places if p not in own]).withColumn("group", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return base.join(out).select("group", "base_miou", "miou", (F.col("base_miou") - F.col("miou")).alias("importance"), (F.col("base_miou") - F.col("miou") <= least).alias("drop"))


class Fitted:
    """A model of any kind: fit(df) once, then predict(df) adds a column prediction."""

    def __init__(self, kind: str, features: str, label: str, **options: object):
        if kind not in KINDS:
            raise ValueError(f"unknown kind of model {kind!r}; known: {sorted(KINDS)}")
        self.kind, self.features, self.label, self.options, self.model = kind, features, label, options, None

    def fit(self, df: DataFrame) -> Fitted:
        self.model = KINDS[self.kind][0](df, self.features, self.label, **self.options)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("the model isn't fitted")
        return KINDS[self.kind][1](self.model, df, self.features)


def _by_forest(model, df: DataFrame, features: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    out = model.transform(df.withColumn("_x", array_to_vector(F.col(features).cast("array<double>"))))
    return out.drop("_x", "rawPrediction", "probability").withColumn("prediction", F.col("prediction").cast("int"))


def _fit_thresholds(df: DataFrame, features: str, label: str, classes: list[int], n_features: int, **how: object) -> list[tuple[list, int]]:
    return [(search_thresholds(df, features, label, classes, n_features, **how)[0], classes[0])]


#: Kinds of models: how each is fitted and predicts. Networks need a library that isn't here; their probabilities are taken as a column.
KINDS: dict[str, tuple[Callable, Callable]] = {
    "threshold": (_fit_thresholds, lambda m, df, f: df.withColumn("prediction", threshold_class(F.col(f), *m[0]))),
    "centroids": (lambda df, f, y, places: Centroids(places).fit(df, f, y), lambda m, df, f: df.withColumn("prediction", m.predict(F.col(f)))),
    "random_forest": (lambda df, f, y, **how: random_forest(df, f, y, **how)[0], _by_forest),
    "boosted": (lambda df, f, y, **how: boosted_trees(df, f, y, **how)[0], _by_forest),
    "precomputed": (lambda df, f, y, priority=(), threshold=0.0: (list(priority), threshold), lambda m, df, f: df.withColumn("prediction", decide(F.col(f), *m))),
}


def train(df: DataFrame, kind: str, features: str, label: str, split: str, **options: object) -> tuple[Fitted, DataFrame]:
    """A model fitted on the rows of split train, and a report: split, n, accuracy, miou_macro of every split."""
    model = Fitted(kind, features, label, **options).fit(df.where(F.col(split) == "train"))
    rows = model.predict(df.where(F.col(label).isNotNull()))
    hits = confusion(rows, label, "prediction", [split])
    sides = hits.select(split, F.inline(F.array(F.struct(F.col("truth").alias("c"), "n", (F.col("truth") == F.col("pred")).alias("hit"), F.lit(True).alias("own")), F.struct(F.col("pred").alias("c"), "n", (F.col("truth") == F.col("pred")).alias("hit"), F.lit(False).alias("own")))))
    one = sides.groupBy(split, "c").agg(F.sum(F.when(F.col("hit") & F.col("own"), F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(~F.col("hit") | F.col("own"), F.col("n")).otherwise(0)).alias("any"), F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).alias("support"))
    return model, one.groupBy(split).agg(F.sum("support").alias("n"), (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg(F.col("tp") / F.col("any")).alias("miou_macro"))


def run_trials(df: DataFrame, features: str, label: str, fold: str, k: int, trials: list[tuple[str, dict]]) -> DataFrame:
    """trial, kind, fold, n, miou: every trial (kind, options) fitted k times, each time scored on the fold that it didn't see."""
    out = None
    for t, (kind, options) in enumerate(trials):
        for j in range(k):
            model = Fitted(kind, features, label, **options).fit(df.where(F.col(fold) != j))
            held = model.predict(df.where((F.col(fold) == j) & F.col(label).isNotNull()))
            one = class_metrics(confusion(held, label, "prediction")).agg(F.sum("support").alias("n"), F.avg("iou").alias("miou")).select(F.lit(t).alias("trial"), F.lit(kind).alias("kind"), F.lit(j).alias("fold"), "n", "miou")
            out = one if out is None else out.unionByName(one)
    return out


def ensemble(members: list[Column], weights: list[float] | None = None) -> Column:
    """Mean of the members' probability arrays, by weight."""
    own = weights or [1.0] * len(members)
    out = F.transform(members[0], lambda p: p * own[0])
    for m, w in zip(members[1:], own[1:], strict=True):
        out = F.zip_with(out, F.transform(m, _times(w)), lambda a, b: a + b)
    return F.transform(out, lambda p: p / sum(own))


def _times(w: float) -> Callable[[Column], Column]:
    return lambda p: p * w
