"""Quality metrics, splits, samples and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models, quality, split
from ..schema import CLASSES, class_dim
from .catalogue import query
from .standins import CELLS, OBS, SCORED, cells, sales, scored, table

CONF = "cf AS (SELECT truth, pred, count(*) AS n FROM cells GROUP BY ALL)"


@query("truth l, pred l, n l", f"WITH {CELLS}, {CONF} SELECT * FROM cf")
def confusion_matrix(spark, sf):
    return quality.confusion(cells(spark, sf), "truth", "pred")


METRICS = CELLS + f", {CONF}, ks AS (SELECT truth AS class FROM cf UNION SELECT pred FROM cf), m AS (SELECT class, sum(CASE WHEN truth = class THEN n ELSE 0 END) AS support, sum(CASE WHEN pred = class THEN n ELSE 0 END) AS predicted, sum(CASE WHEN truth = class AND pred = class THEN n ELSE 0 END) AS tp FROM ks, cf GROUP BY class), t AS (SELECT sum(n) AS total FROM cf)"


@query(
    "class l, support l, predicted l, precision d, recall d, f1 d, f_beta d, iou d, specificity d",
    f"WITH {METRICS} SELECT class, support, predicted, tp / nullif(predicted, 0) AS precision, tp / nullif(support, 0) AS recall, 2 * tp / nullif(support + predicted, 0) AS f1, 5 * tp / nullif(4 * support + predicted, 0) AS f_beta, tp / nullif(support + predicted - tp, 0) AS iou, (total - support - predicted + tp) / nullif(total - support, 0) AS specificity FROM m, t",
)
def confusion_metrics(spark, sf):
    return quality.class_metrics(quality.confusion(cells(spark, sf), "truth", "pred"))


@query(
    "n l, accuracy d, miou_macro d, miou_weighted d, kappa d, mcc d",
    f"""WITH {METRICS}, a AS (SELECT max(total) AS n, sum(tp) AS tp, avg(tp / nullif(support + predicted - tp, 0)) AS miou_macro, sum(support * tp / nullif(support + predicted - tp, 0)) / sum(support) AS miou_weighted, sum(support * predicted)::DOUBLE AS sp, sum(support * support)::DOUBLE AS ss, sum(predicted * predicted)::DOUBLE AS pp FROM m, t)
    SELECT n, tp / n AS accuracy, miou_macro, miou_weighted, (tp / n - sp / (n::DOUBLE * n)) / (1 - sp / (n::DOUBLE * n)) AS kappa, (tp * n::DOUBLE - sp) / (sqrt(n::DOUBLE * n - pp) * sqrt(n::DOUBLE * n - ss)) AS mcc FROM a""",
)
def overall_quality(spark, sf):
    return quality.overall_metrics(quality.confusion(cells(spark, sf), "truth", "pred"))


@query(
    "bin l, n l, mean_confidence d, accuracy d, gap d",
    f"WITH {SCORED}, p AS (SELECT *, list_max(probs) AS c, list_position(probs, list_max(probs)) - 1 AS k FROM sc) SELECT least(9, floor(c * 10)) AS bin, count(*) AS n, avg(c) AS mean_confidence, avg((k = truth)::INT) AS accuracy, abs(avg(c) - avg((k = truth)::INT)) AS gap FROM p GROUP BY 1",
)
def calibration_bins(spark, sf):
    d = scored(spark, sf).withColumn("c", models.confidence(F.col("probs"))).withColumn("k", models.decide(F.col("probs"), [], 0.0))
    return quality.calibration(d, "c", F.col("k") == F.col("truth"))


@query("ece d, worst_gap d, n l", f"WITH {SCORED}, p AS (SELECT *, list_max(probs) AS c, list_position(probs, list_max(probs)) - 1 AS k FROM sc), b AS (SELECT least(9, floor(c * 10)) AS bin, count(*) AS n, abs(avg(c) - avg((k = truth)::INT)) AS gap FROM p GROUP BY 1) SELECT sum(gap * n) / sum(n) AS ece, max(gap) AS worst_gap, sum(n) AS n FROM b")
def calibration_error(spark, sf):
    d = scored(spark, sf).withColumn("c", models.confidence(F.col("probs"))).withColumn("k", models.decide(F.col("probs"), [], 0.0))
    return quality.calibration_error(quality.calibration(d, "c", F.col("k") == F.col("truth")))


@query(
    "id l, cls l",
    f"""WITH {SCORED}, u AS (SELECT id, unnest(probs) AS p, unnest([0, 1, 2, 3]) AS c FROM sc), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, c) AS k FROM u), t AS (SELECT id, max(CASE WHEN k = 1 THEN p END) AS p1, max(CASE WHEN k = 1 THEN c END) AS c1, max(CASE WHEN k = 2 THEN p END) AS p2, max(CASE WHEN k = 2 THEN c END) AS c2 FROM r GROUP BY id)
    SELECT id, CASE WHEN p1 - p2 < 0.1 AND list_position([2, 0, 3, 1], c2) < list_position([2, 0, 3, 1], c1) THEN c2 ELSE c1 END AS cls FROM t""",
)
def ambiguity_priority(spark, sf):
    return scored(spark, sf).select("id", models.decide(F.col("probs"), [2, 0, 3, 1], 0.1).alias("cls"))


@query("vec_id l, cls l", "SELECT vec_id, CASE WHEN embedding[1] < -0.1 THEN 3 WHEN embedding[2] >= 0.05 THEN 1 WHEN embedding[3] >= 0 THEN 2 ELSE 0 END AS cls FROM embeddings")
def threshold_model(spark, sf):
    rules = [(0, "<", -0.1, 3), (1, ">=", 0.05, 1), (2, ">=", 0.0, 2)]
    return table(spark, sf, "embeddings").select("vec_id", models.threshold_class(F.col("embedding"), rules, 0).alias("cls"))


@query(
    "place l, way s, bound d, class l, miou d",
    """WITH v AS (SELECT f - 1 AS place, embedding[f]::DOUBLE AS x, (label % 3)::INT AS truth FROM embeddings, range(1, 65) t(f)), e AS (SELECT place, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM v GROUP BY place),
    p AS (SELECT place, place * 3 + n AS plan, lo + [0.25, 0.5, 0.75][n + 1] * (hi - lo) AS bound FROM e, range(3) g(n)), h AS (SELECT plan, truth, (x >= bound)::INT AS pred, count(*) AS n FROM p JOIN v USING (place) GROUP BY ALL),
    c AS (SELECT plan, c, sum(CASE WHEN truth = c AND pred = c THEN n ELSE 0 END) / sum(n) AS iou FROM h, range(3) k(c) WHERE truth = c OR pred = c GROUP BY ALL), s AS (SELECT plan, avg(iou) AS miou FROM c GROUP BY plan)
    SELECT place, '>=' AS way, bound, 1 AS class, miou FROM s JOIN p USING (plan) ORDER BY round(miou, 12) DESC, plan LIMIT 1""",
)
def threshold_search(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("y", F.pmod("label", F.lit(3)))
    rules, miou = models.search_thresholds(e, "embedding", "y", [0, 1, 2], 64, grid=[0.25, 0.5, 0.75])
    return spark.createDataFrame([(*r, miou) for r in rules], "place int, way string, bound double, class int, miou double")


@query("raw l, dense l, again l", "WITH d AS (SELECT unnest([%s]) AS r), n AS (SELECT r, row_number() OVER () - 1 AS d FROM d), p AS (SELECT DISTINCT p_size - 1 AS raw FROM part) SELECT raw, n.d AS dense, n.r AS again FROM p LEFT JOIN n ON n.r = raw" % ", ".join(str(c[0]) for c in CLASSES))
def raw_dense_remap(spark, sf):
    dim = class_dim(spark)
    p = table(spark, sf, "part").select((F.col("p_size") - 1).alias("raw")).distinct()
    d = models.to_dense(p.withColumn("dense", F.col("raw")), dim, "dense")
    return models.to_dense(d.withColumn("again", F.col("dense")), dim, "again", back=True)


@query("tile l, truth l, n l", f"WITH {CELLS} SELECT tile, CASE WHEN truth = 2 THEN 1 ELSE truth END AS truth, count(*) AS n FROM cells GROUP BY ALL")
def label_merge(spark, sf):
    return models.remap(cells(spark, sf), "truth", {2: 1}, [0, 1, 2]).groupBy("tile", "truth").agg(F.count(F.lit(1)).alias("n"))


@query("id l, ce d, focal d, pen d", f"WITH {SCORED}, p AS (SELECT *, greatest(probs[truth + 1], 1e-12) AS q FROM sc) SELECT id, -ln(q) AS ce, -2 * pow(1 - q, 2) * ln(q) AS focal, CASE WHEN truth = 1 THEN 3 * probs[3] ELSE 0 END AS pen FROM p")
def loss_columns(spark, sf):
    p, t = F.col("probs"), F.col("truth")
    return scored(spark, sf).select("id", models.cross_entropy(p, t).alias("ce"), models.cross_entropy(p, t, 2.0, 2.0).alias("focal"), models.directional_penalty(p, t, 1, 2, 3.0).alias("pen"))


@query("dice_loss d", f"WITH {SCORED}, u AS (SELECT truth, unnest(probs) AS p, unnest([0, 1, 2, 3]) AS c FROM sc), k AS (SELECT c, (2 * sum(CASE WHEN truth = c THEN p ELSE 0 END) + 1) / (sum(p) + sum((truth = c)::INT) + 1) AS d FROM u GROUP BY c) SELECT 1 - avg(d) AS dice_loss FROM k")
def dice_loss(spark, sf):
    return models.dice_loss(scored(spark, sf), "probs", "truth", 4)


@query("tile l, class l, n l", f"WITH {CELLS} SELECT tile, truth AS class, count(*) AS n FROM cells GROUP BY ALL")
def class_counts(spark, sf):
    return quality.class_counts(cells(spark, sf), ["tile"], "truth")


@query("class l, n l, weight d", f"WITH {CELLS}, c AS (SELECT truth AS class, count(*) AS n FROM cells GROUP BY ALL), w AS (SELECT *, 1 / (n / sum(n) OVER () + 1e-6) AS w FROM c) SELECT class, n, w / avg(w) OVER () AS weight FROM w")
def class_weights_inverse(spark, sf):
    return quality.inverse_frequency_weights(quality.class_counts(cells(spark, sf), ["tile"], "truth"))


@query("class l, n l, weight d", f"WITH {CELLS}, c AS (SELECT truth AS class, count(*) AS n FROM cells GROUP BY ALL), w AS (SELECT *, least(10, pow((SELECT median(n) FROM c) / n, 0.5)) AS w FROM c) SELECT class, n, w / avg(w) OVER () AS weight FROM w")
def class_weights_power(spark, sf):
    return quality.power_weights(quality.class_counts(cells(spark, sf), ["tile"], "truth"))


@query("tile l, rare_share d, weight d", f"WITH {CELLS}, c AS (SELECT tile, truth, count(*) AS n FROM cells GROUP BY ALL), g AS (SELECT truth, sum(n) / sum(sum(n)) OVER () < 0.33 AS rare FROM c GROUP BY truth) SELECT tile, sum(CASE WHEN rare THEN n ELSE 0 END) / sum(n) AS rare_share, 1 + 4 * sum(CASE WHEN rare THEN n ELSE 0 END) / sum(n) AS weight FROM c JOIN g USING (truth) GROUP BY tile")
def sampling_weights(spark, sf):
    return quality.sampling_weights(quality.class_counts(cells(spark, sf), ["tile"], "truth"), ["tile"], 0.33)


@query("feature l, mean d, std d, n l", "SELECT f - 1 AS feature, avg(embedding[f]::DOUBLE) AS mean, stddev_samp(embedding[f]::DOUBLE) AS std, count(*) AS n FROM embeddings, range(1, 65) t(f) GROUP BY f")
def feature_mean_std(spark, sf):
    return quality.feature_moments(table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>")), "embedding")


@query("vec_id l, a d, b d", "SELECT vec_id, (embedding[1]::DOUBLE - 0.01) / 0.125 AS a, (embedding[2]::DOUBLE + 0.02) / 1e-6 AS b FROM embeddings")
def normalised_features(spark, sf):
    x = quality.normalise(F.col("embedding").cast("array<double>"), [0.01, -0.02] + [0.0] * 62, [0.125, 0.0] + [1.0] * 62)
    return table(spark, sf, "embeddings").select("vec_id", x.alias("x")).select("vec_id", F.get("x", F.lit(0)).alias("a"), F.get("x", F.lit(1)).alias("b"))


@query("o_orderstatus s, metric s, mean d, std d, min d, max d, n l", "WITH u AS (SELECT o_orderstatus, 'price' AS metric, o_totalprice AS v FROM orders UNION ALL SELECT o_orderstatus, 'key', o_custkey FROM orders) SELECT o_orderstatus, metric, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max, count(v) AS n FROM u GROUP BY ALL")
def seed_aggregate(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed({"o_totalprice": "price", "o_custkey": "key"})
    return quality.seed_summary(o, ["price", "key"], ["o_orderstatus"])


@query("class_a l, class_b l, feature l, jm d", "WITH m AS (SELECT label AS c, f - 1 AS f, avg(embedding[f]::DOUBLE) AS mu, var_samp(embedding[f]::DOUBLE) + 1e-6 AS v FROM embeddings, range(1, 65) t(f) GROUP BY ALL) SELECT a.c AS class_a, b.c AS class_b, a.f AS feature, 2 * (1 - exp(-((a.mu - b.mu) * (a.mu - b.mu) / (8 * ((a.v + b.v) / 2)) + 0.5 * ln(((a.v + b.v) / 2) / sqrt(a.v * b.v))))) AS jm FROM m a JOIN m b ON a.f = b.f AND a.c < b.c")
def jm_single_feature(spark, sf):
    return quality.single_separability(table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>")), "label", "embedding")


@query("class_a l, class_b l, jm d")
def jm_separability(spark, sf):
    return quality.separability(table(spark, sf, "embeddings"), "label", "embedding", 64)


@query("feature_a l, feature_b l, r d", "SELECT a - 1 AS feature_a, b - 1 AS feature_b, corr(embedding[a]::DOUBLE, embedding[b]::DOUBLE) AS r FROM embeddings, range(1, 65) t(a), range(1, 65) u(b) WHERE a < b GROUP BY a, b HAVING abs(corr(embedding[a]::DOUBLE, embedding[b]::DOUBLE)) >= 0.01")
def feature_correlation(spark, sf):
    return quality.correlation_matrix(table(spark, sf, "embeddings"), "embedding", 64, 0.01)


@query(
    "tile l, n_scenes l, stratum l, split s",
    """WITH t AS (SELECT o_custkey AS tile, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT *, CASE WHEN n <= 1 THEN 0 WHEN n <= 4 THEN 1 ELSE 2 END AS stratum FROM t),
    r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('0|' || tile), tile) AS k, count(*) OVER (PARTITION BY stratum) AS m FROM s), c AS (SELECT *, least(floor(m * 0.15 + 0.5), m - 1) AS va FROM r), d AS (SELECT *, least(floor(m * 0.15 + 0.5), m - 1 - va) AS te FROM c)
    SELECT tile, n AS n_scenes, stratum, CASE WHEN k <= va THEN 'val' WHEN k <= va + te THEN 'test' ELSE 'train' END AS split FROM d""",
)
def tile_split(spark, sf):
    return split.split_tiles(table(spark, sf, "orders").withColumnRenamed("o_custkey", "tile"), "tile")


@query("px l, scene_id s", f"WITH {OBS} SELECT px, scene_id FROM obs QUALIFY row_number() OVER (PARTITION BY px ORDER BY md5('3|' || px || '|' || scene_id), scene_id) <= 5")
def per_scene_sample(spark, sf):
    return split.sample_per_scene(sales(spark, sf).select("px", "scene_id"), ["px"], ["scene_id"], 5, 3)


@query("key l, fold l", "SELECT c_custkey AS key, (row_number() OVER (ORDER BY md5('0|' || c_custkey), c_custkey) - 1) % 5 AS fold FROM customer")
def cross_validation_folds(spark, sf):
    return split.folds(table(spark, sf, "customer").withColumnRenamed("c_custkey", "key"), "key", 5)


@query("key l, fold l")
def balanced_cross_validation_folds(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.ascii("o_orderpriority").alias("class"))
    return split.balanced_folds(o, o.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n")), "key", 5)


@query("tile l, row l, col l", f"WITH {CELLS}, r AS (SELECT tile, row, col, row_number() OVER (PARTITION BY tile ORDER BY row, col) - 1 AS r, count(*) OVER (PARTITION BY tile) AS n FROM cells) SELECT tile, row, col FROM r WHERE n <= 16 OR r = 0 OR floor(r * 16 / n) <> floor((r - 1) * 16 / n)")
def evenly_spaced_cells(spark, sf):
    return split.evenly_spaced(cells(spark, sf), ["tile"], ["row", "col"], 16)


@query("tile l, patch_row l, patch_col l, labelled d", f"WITH {CELLS} SELECT tile, row // 5 AS patch_row, col // 5 AS patch_col, count(CASE WHEN truth > 0 THEN 1 END) / 25.0 AS labelled FROM cells GROUP BY ALL HAVING count(CASE WHEN truth > 0 THEN 1 END) / 25.0 >= 0.2")
def labelled_patches(spark, sf):
    return split.labelled_patches(cells(spark, sf).withColumn("y", F.when(F.col("truth") > 0, F.col("truth"))), ["tile"], "row", "col", "y", 5)


def _parts(spark, sf):
    c = cells(spark, sf).withColumn("blk", F.concat_ws("-", "tile", F.floor(F.col("row") / 4)))
    return c, split.split_tiles(c.select("blk", "col"), "blk", (0.5, 0.3, 0.2))


PARTS = CELLS + """, bl AS (SELECT *, tile || '-' || (row // 4) AS blk FROM cells), pt AS (SELECT blk, CASE WHEN count(*) <= 1 THEN 0 WHEN count(*) <= 4 THEN 1 ELSE 2 END AS st FROM bl GROUP BY blk),
pr AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY md5('0|' || blk), blk) AS k, count(*) OVER (PARTITION BY st) AS m FROM pt), pv AS (SELECT *, least(floor(m * 0.3 + 0.5), m - 1) AS va FROM pr),
parts AS (SELECT blk, CASE WHEN k <= va THEN 'val' WHEN k <= va + least(floor(m * 0.2 + 0.5), m - 1 - va) THEN 'test' ELSE 'train' END AS split FROM pv)"""


@query(
    "split s, class l, share d, target d, warning s",
    f"""WITH {PARTS}, w AS (SELECT split, class, sum(n) AS n, max(n) AS most FROM (SELECT blk, truth AS class, count(*) AS n FROM bl GROUP BY ALL) JOIN parts USING (blk) GROUP BY ALL),
    x AS (SELECT *, n / sum(n) OVER (PARTITION BY class) AS share, CASE split WHEN 'train' THEN 0.5::DOUBLE WHEN 'val' THEN 0.3 ELSE 0.2 END AS target FROM w),
    y AS (SELECT *, CASE WHEN share > 1.02::DOUBLE * target THEN 'too much' WHEN share < 0.98::DOUBLE * target THEN 'too little' WHEN most > 0.5 * n THEN 'single tile' END AS warning FROM x) SELECT * FROM y WHERE warning IS NOT NULL""",
)
def split_share_warnings(spark, sf):
    c, parts = _parts(spark, sf)
    return split.share_warnings(parts, quality.class_counts(c, ["blk"], "truth"), "blk", {"train": 0.5, "val": 0.3, "test": 0.2}, high=1.02, low=0.98)


@query(
    "class l, split s, donor s",
    f"""WITH {PARTS}, ow AS (SELECT blk, split, class, n FROM (SELECT blk, floor(share * 50)::INT % 50 AS class, count(*) AS n FROM bl GROUP BY ALL) JOIN parts USING (blk)),
    nn AS (SELECT class, split FROM (SELECT DISTINCT class FROM ow), (SELECT unnest(['train', 'val', 'test']) AS split) EXCEPT SELECT class, split FROM ow),
    mo AS (SELECT class, split, max_by(blk, (n, blk)) AS d FROM ow GROUP BY ALL), dd AS (SELECT class, max(d) FILTER (split = 'train') AS a, max(d) FILTER (split = 'val') AS b, max(d) FILTER (split = 'test') AS c FROM mo GROUP BY class)
    SELECT class, split, CASE WHEN split = 'train' THEN coalesce(b, c) ELSE a END AS donor FROM nn JOIN dd USING (class)""",
)
def split_missing_classes(spark, sf):
    c, parts = _parts(spark, sf)
    c = c.withColumn("rare", F.pmod(F.floor(F.col("share") * 50), F.lit(50)).cast("int"))
    return split.missing_classes(parts, quality.class_counts(c, ["blk"], "rare"), "blk")


@query("blk s, split s")
def split_coverage_repair(spark, sf):
    c, parts = _parts(spark, sf)
    c = c.withColumn("class", F.pmod(F.floor(F.col("share") * 50), F.lit(50)).cast("int"))
    return split.repair_coverage(parts, c.groupBy("blk", F.col("pred").alias("sensor"), "class").agg(F.count(F.lit(1)).alias("n")), "blk")


@query("truth l, pred l, n l")
def random_forest_confusion(spark, sf):
    _, out = models.random_forest(table(spark, sf, "embeddings"), "embedding", "label", trees=8, depth=5)
    return quality.confusion(out.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


@query(
    "group s, base_miou d, miou d, importance d",
    """WITH e AS (SELECT vec_id, (label % 2)::INT AS truth, embedding[1]::DOUBLE AS x, row_number() OVER (ORDER BY vec_id) AS k, row_number() OVER (ORDER BY md5('0|' || vec_id), vec_id) AS d FROM embeddings),
    p AS (SELECT a.truth, unnest(['base', 'first', 'second']) AS grp, unnest([(a.x >= 0)::INT, (b.x >= 0)::INT, (a.x >= 0)::INT]) AS pred FROM e a JOIN e b ON a.k = b.d),
    i AS (SELECT grp, c, sum((truth = c AND pred = c)::INT) / count(*) AS iou FROM p, range(2) k(c) WHERE truth = c OR pred = c GROUP BY ALL), m AS (SELECT grp, avg(iou) AS miou FROM i GROUP BY grp)
    SELECT m.grp AS "group", b.miou AS base_miou, m.miou AS miou, b.miou - m.miou AS importance FROM m, (SELECT miou FROM m WHERE grp = 'base') b WHERE m.grp <> 'base'""",
)
def permutation_importance(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>")).withColumn("y", F.pmod("label", F.lit(2)).cast("int"))
    rule = lambda f: models.threshold_class(f, [(0, ">=", 0.0, 1)], 0)
    return models.permutation_importance(e, "embedding", "y", {"first": [0], "second": [1]}, rule, ["vec_id"])
