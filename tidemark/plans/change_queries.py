"""Changes between months, breaks, severity and catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, changes, segmentation, severity
from ..schema import sensor_dim
from .catalogue import query
from .standins import BREAKS, MONTHLY, MONTHLY_CLS, MONTHS, OBS, SALES, breaks, monthly_cls, monthly_nir, sales


def _changes_sql(step: int, eligible: str = "") -> str:
    return f"ch AS (SELECT a.px, a.month AS from_month, b.month AS to_month, a.cls AS from_class, b.cls AS to_class, a.cls <> b.cls AS changed FROM mc a JOIN mc b ON a.px = b.px AND b.month = (a.month + to_months({step}))::DATE {eligible})"


@query("px l, from_month s, to_month s, from_class l, to_class l, changed b", f"WITH {MONTHLY_CLS}, {_changes_sql(12)} SELECT * FROM ch")
def annual_change(spark, sf):
    return changes.month_changes(monthly_cls(spark, sf), MONTHS, 12)


@query("px l, from_month s, to_month s, from_class l, to_class l, changed b", f"WITH {MONTHLY_CLS}, {_changes_sql(1, 'WHERE a.cls IN (0, 1) AND b.cls IN (0, 1)')} SELECT * FROM ch")
def month_change(spark, sf):
    return changes.month_changes(monthly_cls(spark, sf), MONTHS, 1, eligible=[0, 1])


@query(
    "px l, from_month s, to_month s, to_class l, persistent b",
    f"""WITH {MONTHLY_CLS}, {_changes_sql(12)}, ms AS (SELECT DISTINCT px % 5 AS tile, month FROM mc), nx AS (SELECT tile, month, lead(month, 1) OVER w AS n1, lead(month, 2) OVER w AS n2 FROM ms WINDOW w AS (PARTITION BY tile ORDER BY month))
    SELECT ch.px, from_month, to_month, to_class, coalesce(c1.cls = to_class, false) AND coalesce(c2.cls = to_class, false) AS persistent FROM ch JOIN nx ON ch.px % 5 = nx.tile AND ch.to_month = nx.month
    LEFT JOIN mc c1 ON c1.px = ch.px AND c1.month = n1 LEFT JOIN mc c2 ON c2.px = ch.px AND c2.month = n2 WHERE changed""",
)
def persistent_change(spark, sf):
    m = monthly_cls(spark, sf).withColumn("tile", F.pmod("px", F.lit(5)))
    s = MONTHS.at(keys=("tile", "px"))
    return changes.confirmed_changes(changes.month_changes(m, s, 12), m, ["tile"], s, follow=2)


@query(
    "px l, from_month s, to_month s, from_class l, to_class l",
    f"WITH {MONTHLY_CLS}, {_changes_sql(12)} SELECT px, from_month, to_month, from_class, to_class FROM ch WHERE changed AND EXISTS (SELECT 1 FROM obs WHERE obs.px = ch.px AND nir > 0.9 AND red >= 0.11 AND abs(obs_date - to_month) <= 45)",
)
def corroborated_change(spark, sf):
    return changes.corroborated_changes(changes.month_changes(monthly_cls(spark, sf), MONTHS, 12), breaks(spark, sf).where("drop >= 0.11"), MONTHS)


@query("px l, t_break s, drop d, break_class l", f"WITH {OBS}, {BREAKS} SELECT px, t_break, drop_ AS drop, break_class FROM br QUALIFY row_number() OVER (PARTITION BY px ORDER BY t_break DESC) = 1")
def latest_break(spark, sf):
    return changes.latest_breaks(breaks(spark, sf), MONTHS, ["drop", "break_class"])


@query(
    "px l, t_break s, before d, after d, difference d",
    f"WITH {MONTHLY}, {BREAKS} SELECT br.px, t_break, a.v AS before, b.v AS after, a.v - b.v AS difference FROM br LEFT JOIN mon a ON a.px = br.px AND a.month = date_trunc('month', t_break) LEFT JOIN mon b ON b.px = br.px AND b.month = (date_trunc('month', t_break) + INTERVAL 1 MONTH)::DATE",
)
def bracket_pair_diff(spark, sf):
    return changes.break_pairs(breaks(spark, sf), monthly_nir(spark, sf), "v", MONTHS)


@query("px l, t_break s, dnbr d", f"WITH {MONTHLY}, {BREAKS}, lb AS (SELECT px, max(t_break) AS t FROM br GROUP BY px) SELECT lb.px, t AS t_break, a.v - b.v AS dnbr FROM lb LEFT JOIN mon a ON a.px = lb.px AND a.month = date_trunc('month', t) LEFT JOIN mon b ON b.px = lb.px AND b.month = (date_trunc('month', t) + INTERVAL 1 MONTH)::DATE")
def break_severity(spark, sf):
    return severity.severity(breaks(spark, sf), monthly_nir(spark, sf), "v", MONTHS)


@query(
    "px l, t_break s, month s, since_months l, v d",
    f"WITH {MONTHLY}, {BREAKS}, fb AS (SELECT px, min(t_break) AS t FROM br GROUP BY px) SELECT fb.px, t AS t_break, month, (year(month) - year(t)) * 12 + month(month) - month(t) AS since_months, v FROM fb JOIN mon ON mon.px = fb.px AND month >= t",
)
def post_break_trajectory(spark, sf):
    first = breaks(spark, sf).groupBy("px").agg(F.min("t_break").alias("t_break"))
    return changes.trajectories(first, monthly_nir(spark, sf), "v", MONTHS)


@query("px l, t_break s, month s, since_months l, v d", f"WITH {MONTHLY}, {BREAKS}, lb AS (SELECT px, max(t_break) AS t FROM br GROUP BY px) SELECT lb.px, t AS t_break, month, (year(month) - year(t)) * 12 + month(month) - month(t) AS since_months, v FROM lb JOIN mon ON mon.px = lb.px AND month >= t")
def regrowth_trajectory(spark, sf):
    return severity.regrowth(breaks(spark, sf), monthly_nir(spark, sf), "v", MONTHS)


@query(
    "px l, break_date s, event_type s, prior_losses l",
    f"""WITH {OBS}, {BREAKS}, p AS (SELECT *, coalesce(sum((event_type IN ('fire', 'cutblock'))::INT) OVER (PARTITION BY px ORDER BY t_break ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_losses FROM br)
    SELECT px, t_break AS break_date, CASE WHEN event_type = 'open_land_disturbance' AND prior_losses > 0 THEN 'regrowth_change' ELSE event_type END AS event_type, prior_losses FROM p""",
)
def prior_loss_flag(spark, sf):
    return changes.prior_loss(breaks(spark, sf).withColumnRenamed("t_break", "break_date"), MONTHS, ["fire", "cutblock"])


def _scenes(spark, sf):
    return sales(spark, sf).select(F.concat(F.lit("t"), "tile").alias("tile_id"), "sensor", "scene_id", F.year("obs_date").alias("year"), F.month("obs_date").alias("month"), (F.col("red") * 300).alias("cloud_pct"), (F.col("blue") * 100).alias("aoi_coverage_pct"), F.col("nir").alias("max_reflectance"), "px")


SCENES = OBS + ", scn AS (SELECT 't' || tile AS tile_id, sensor, scene_id, year(obs_date) AS year, month(obs_date) AS month, red * 300 AS cloud_pct, blue * 100 AS aoi_coverage_pct, nir AS max_reflectance, px FROM obs)"


@query(
    "tile_id s, sensor s, scene_id s, reason s, status s",
    f"""WITH {SCENES}, r AS (SELECT *, CASE WHEN px % 10 = 3 THEN 'cached' WHEN cloud_pct > 20 THEN 'cloud' WHEN aoi_coverage_pct < 50 THEN 'coverage' WHEN max_reflectance < 0.15 THEN 'reflectance' END AS why FROM scn),
    b AS (SELECT *, row_number() OVER (PARTITION BY tile_id, sensor, year, month, why IS NULL ORDER BY cloud_pct, scene_id) AS k FROM r)
    SELECT tile_id, sensor, scene_id, CASE WHEN why IS NULL AND k > 3 THEN 'budget' ELSE why END AS reason, CASE WHEN why IS NULL AND k <= 3 THEN 'kept' ELSE 'rejected' END AS status FROM b""",
)
def catalog_filter_cascade(spark, sf):
    s = _scenes(spark, sf)
    return catalog.cascade(s, s.where("px % 10 = 3"), least_reflectance=0.15, most_a_month=3)


@query("tile_id s, sensor s, year l, month l, scene_id s, rank l", f"WITH {SCENES} SELECT tile_id, sensor, year, month, scene_id, row_number() OVER w AS rank FROM scn WINDOW w AS (PARTITION BY tile_id, sensor, year, month ORDER BY cloud_pct NULLS LAST, scene_id) QUALIFY row_number() OVER w <= 2")
def least_cloudy_topk(spark, sf):
    return catalog.least_cloudy(_scenes(spark, sf), ["tile_id", "sensor", "year", "month"], 2)


@query(
    "scene_id s, sensor s, year l",
    f"WITH {SCENES} SELECT scene_id, sensor, year - 8 + CASE WHEN sensor = 's2' THEN 25 ELSE 10 END AS year FROM scn WHERE CASE sensor WHEN 's2' THEN year + 17 >= 2015 WHEN 'l9' THEN year + 2 >= 2021 WHEN 'l8' THEN year + 2 >= 2013 WHEN 'l7' THEN year + 2 BETWEEN 1999 AND 2002 ELSE year + 2 BETWEEN 1984 AND 2011 END",
)
def admissible_sensor_years(spark, sf):
    s = _scenes(spark, sf).withColumn("year", F.col("year") + F.when(F.col("sensor") == "s2", 17).otherwise(2))
    return catalog.admissible(s, sensor_dim(spark))


@query("tile_id s, max_reflectance d", f"WITH {SCENES} SELECT tile_id || '-' || month AS tile_id, max(greatest(max_reflectance, cloud_pct / 100)) AS max_reflectance FROM scn GROUP BY ALL HAVING max(greatest(max_reflectance, cloud_pct / 100)) >= 0.99")
def plausible_scenes(spark, sf):
    s = _scenes(spark, sf).withColumn("tile_id", F.concat_ws("-", "tile_id", "month")).withColumn("c", F.col("cloud_pct") / 100)
    return catalog.plausible(s, ["tile_id"], ["max_reflectance", "c"], 0.99)


@query("tile_id s, n l, valid_ratio d, passes b", f"WITH {SCENES} SELECT tile_id, count(*) AS n, avg((max_reflectance >= 0.3)::INT) AS valid_ratio, avg((max_reflectance >= 0.3)::INT) >= 0.7 AS passes FROM scn GROUP BY tile_id")
def scene_precheck(spark, sf):
    s = _scenes(spark, sf).withColumn("f", F.when(F.col("max_reflectance") >= 0.3, F.col("max_reflectance")))
    return catalog.valid_share(s, ["tile_id"], ["f"], 0.7)


@query("scene_id s, px l", f"WITH {OBS} SELECT scene_id, px FROM obs WHERE cls <> 2")
def usable_observations(spark, sf):
    return catalog.usable(sales(spark, sf), "cls", [2], ["nir", "red"])


@query("tile_id s, sensor s, scene_id s", f"WITH {SCENES} SELECT tile_id, sensor, scene_id FROM scn WHERE cloud_pct > 20")
def unlabelled_scenes(spark, sf):
    s = _scenes(spark, sf)
    return catalog.missing_from(s, s.where("cloud_pct <= 20").select("tile_id", "sensor", "scene_id"))


@query("tile_id s, sensor s, scene_id s, cloud_pct d", f"WITH {SCENES} SELECT tile_id, sensor, scene_id, CASE WHEN px % 4 = 1 THEN -1 ELSE cloud_pct END AS cloud_pct FROM scn")
def manifest_upsert(spark, sf):
    s = _scenes(spark, sf)
    return catalog.upsert(s, s.where("px % 4 = 1").withColumn("cloud_pct", F.lit(-1.0)))


@query("tile_id s, sensor s, scene_id s, cached_at l", f"WITH {SCENES} SELECT tile_id, sensor, scene_id, month + 100 AS cached_at FROM scn")
def manifest_latest(spark, sf):
    s = _scenes(spark, sf)
    return catalog.latest(s.withColumn("cached_at", F.col("month")).unionByName(s.withColumn("cached_at", F.col("month") + 100)))


@query("px l, seg_index l, t_start s, t_end s, t_break s, n_obs l, seg_class l, persist_flag b")
def break_segments(spark, sf):
    """Structural breaks of the suppliers' monthly prices and quantities."""
    s = sales(spark, sf).groupBy("px", F.trunc("obs_date", "MM").alias("obs_date")).agg(F.avg("nir").alias("NBR"), F.avg("blue").alias("NDVI"), F.min("sensor").alias("sensor"), F.min("cls").alias("cls"))
    p = segmentation.Params(features=("NBR", "NDVI"), season=None, least_rmse=0.01, p_change=0.99, least_magnitude=0.05, least_same_class=0.05, persist_days=0)
    return segmentation.segment(s, SALES, p)


@query("px l, pred l, confidence d", f"WITH {OBS}, o AS (SELECT *, cls AS pred, nir AS confidence, nir >= CASE WHEN cls = 0 THEN 0.7 ELSE 0.9 END AS good FROM obs), s AS (SELECT *, avg(good::INT) OVER (PARTITION BY px) AS share FROM o) SELECT px, pred, confidence FROM s WHERE good AND share >= 0.1")
def pseudo_label_filter(spark, sf):
    return catalog.pseudo_labels(sales(spark, sf).withColumnsRenamed({"cls": "pred", "nir": "confidence"}), ["px"], rare=[0], least_share=0.1)
