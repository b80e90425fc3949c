"""Stored products and the stages over them: every query writes to the shared folder, reads back, and must give the rows of its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.indices import bandpass_table
from ..operators import segmentation, tiles
from ..schema import SCHEMAS
from ..sources import config, products
from . import stages
from .catalogue import query
from .change_queries import _changes_sql
from .grid_queries import GRID
from .series_queries import CURVES, INTERVALS, RULES, _composite_sql
from .standins import BREAKS, MONTHLY, MONTHLY_CLS, OBS, boxes, breaks, cells, monthly_cls, monthly_nir, sales, table, yearly


def _keyed(df):
    """px as tile_id, row and col."""
    px = F.col("px")
    return df.withColumns({"tile_id": F.concat(F.lit("t"), F.pmod(px, F.lit(5))), "row": F.floor(px / 1000).cast("int"), "col": F.pmod(px, F.lit(1000)).cast("int")})


def _to_product(df, name: str):
    """df with the columns of a product, in order and type; columns that it lacks are null."""
    parts, depth, last = [], 0, 0
    for i, c in enumerate(SCHEMAS[name] + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(SCHEMAS[name][last:i].strip().split(" ", 1))
            last = i + 1
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in parts])


def _px(df):
    return df.withColumn("px", F.col("row") * 1000 + F.col("col"))


def _observations(spark, sf):
    return _to_product(_keyed(sales(spark, sf)).withColumn("class_id", F.col("cls")), "observation")


def _segments(spark, sf):
    """Breaks as segments, with a fall of one feature and a gain of the other."""
    own = _keyed(breaks(spark, sf))
    zero = [F.lit(0.0).alias(c) for c in ("level", "slope", "amplitude", "peak_doy", "rmse")]
    feat = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(0.0).alias("magnitude"), *zero, (sign * F.col(c)).alias("resid_magnitude")) for n, sign, c in (("NBR", -1.0, "drop"), ("NDVI", 1.0, "rise"))])
    return _to_product(own.withColumn("feat", feat), "segment")


def _monthly(spark, sf):
    return _to_product(_keyed(monthly_cls(spark, sf)).withColumn("class_id", F.col("cls")), "monthly_class")


def _index(spark, sf, names=("NBR", "NDVI")):
    own = _keyed(monthly_nir(spark, sf)).withColumn("index_name", F.explode(F.array(*[F.lit(n) for n in names])))
    return _to_product(own.withColumn("median", F.col("v")), "monthly_index")


def _store(spark, *rows) -> str:
    root = products.shared_root(spark)
    for df, name in rows:
        products.write_product(df, root, name)
    return root


@query("tile_id s, n l, total d", f"WITH {OBS} SELECT 't' || px % 5 AS tile_id, count(*) AS n, sum(red) AS total FROM obs WHERE sensor = 'l8' GROUP BY ALL")
def stored_scenes(spark, sf):
    """Half of the scenes appended, then all: each is stored once; one sensor is read back, from its own folders."""
    root = products.shared_root(spark)
    obs = _observations(spark, sf)
    products.append_scenes(obs.where(F.pmod(F.xxhash64("scene_id"), F.lit(2)) == 0), root)
    products.append_scenes(obs, root)
    back = products.read_product(spark, root, "observation", ["tile_id", "sensor", "red"]).where("sensor = 'l8'")
    return back.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), F.sum("red").alias("total"))


FILLED = """c0 AS (SELECT (p_partkey % 3)::INT AS tile, floor(p_partkey / 3 / 40)::INT AS row, (floor(p_partkey / 3) % 40)::INT AS col, p_retailprice AS z, floor(p_size / 17)::INT AS truth FROM part),
sh AS (SELECT tile, CASE WHEN count(*) FILTER (truth > 0) >= 100 THEN -median(truth) FILTER (truth > 0) ELSE 0 END AS m FROM c0 GROUP BY tile), cells AS (SELECT c0.tile, row, col, CASE WHEN truth > 0 THEN z ELSE z + truth + m END AS z FROM c0 JOIN sh USING (tile))"""


@query(
    "tile_id s, row l, col l, elevation d, slope d",
    f"""WITH {FILLED}, n AS (SELECT c.tile, c.row, c.col, c.z, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col - 1 THEN n.z END) AS a, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col THEN n.z END) AS b, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col + 1 THEN n.z END) AS c3,
    max(CASE WHEN n.row = c.row AND n.col = c.col - 1 THEN n.z END) AS d, max(CASE WHEN n.row = c.row AND n.col = c.col + 1 THEN n.z END) AS f, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col - 1 THEN n.z END) AS g, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col THEN n.z END) AS h, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col + 1 THEN n.z END) AS i
    FROM cells c LEFT JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 1 AND abs(n.col - c.col) <= 1 GROUP BY ALL), e AS (SELECT *, ((c3 + 2 * f + i) - (a + 2 * d + g)) / 800 AS dx, ((g + 2 * h + i) - (a + 2 * b + c3)) / 800 AS dy FROM n)
    SELECT 't' || tile AS tile_id, row, col, z AS elevation, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM e""",
)
def stored_terrain(spark, sf):
    c = cells(spark, sf).withColumn("tile_id", F.concat(F.lit("t"), "tile"))
    base = c.select("tile_id", "row", "col", F.when(F.col("truth") > 0, F.col("z")).alias("elevation"))
    other = c.select("tile_id", "row", "col", (F.col("z") + F.col("truth")).alias("elevation"))
    root = products.shared_root(spark)
    stages.dem_products(base, other, root, 100.0)
    return products.read_product(spark, root, "dem")


@query("tile_id s, class_id l, n l", f"WITH {OBS} SELECT 't' || px % 5 AS tile_id, cls AS class_id, count(*) AS n FROM obs GROUP BY ALL")
def stored_class_maps(spark, sf):
    root = _store(spark, (_to_product(_observations(spark, sf), "scene_class"), "scene_class"))
    return products.read_product(spark, root, "scene_class").groupBy("tile_id", "class_id").agg(F.count(F.lit(1)).alias("n"))


@query("px l, sensor s, n l", f"WITH {OBS} SELECT px, sensor, count(*) AS n FROM obs WHERE cls <> 2 GROUP BY ALL")
def stage_classified(spark, sf):
    obs = _observations(spark, sf)
    root = _store(spark, (obs, "observation"), (_to_product(obs.where("class_id <> 2"), "scene_class"), "scene_class"))
    return _px(stages.classified(spark, root)).groupBy("px", "sensor").agg(F.count(F.lit(1)).alias("n"))


@query("px l, t_break s, dnbr d", f"WITH {MONTHLY}, {BREAKS}, lb AS (SELECT px, max(t_break) AS t FROM br GROUP BY px) SELECT lb.px, t AS t_break, a.v - b.v AS dnbr FROM lb LEFT JOIN mon a ON a.px = lb.px AND a.month = date_trunc('month', t) LEFT JOIN mon b ON b.px = lb.px AND b.month = (date_trunc('month', t) + INTERVAL 1 MONTH)::DATE")
def stage_severity(spark, sf):
    root = _store(spark, (_segments(spark, sf), "segment"), (_index(spark, sf), "monthly_index"))
    stages.break_severity(spark, root)
    return _px(products.read_product(spark, root, "severity"))


@query(
    "tile_id s, row l, col l, search_minx d, area_km2 d, aoi_id s",
    f"WITH {GRID} SELECT CASE WHEN length(aoi_id) > 6 THEN 'more_' ELSE 'tile_' END || tile_id[6:] AS tile_id, row, col, search_minx, area_km2, aoi_id FROM gr",
)
def stored_registry(spark, sf):
    b = boxes(spark, sf)
    both = tiles.registry_union([tiles.tile_grid(b.where("length(aoi_id) <= 6"), least_cover=5.0), tiles.tile_grid(b.where("length(aoi_id) > 6"), least_cover=5.0, prefix="more")])
    return products.read_product(spark, _store(spark, (_to_product(both, "tile_registry"), "tile_registry")), "tile_registry")


@query("label l, n l, mean d", "SELECT label % 4 AS label, count(*) AS n, avg(embedding[2]::DOUBLE) AS mean FROM embeddings WHERE label % 4 <> 3 GROUP BY ALL")
def stored_features(spark, sf):
    """Features and annotations of scenes, stored, joined and flattened to labelled rows; unlabelled cells are left out."""
    e = table(spark, sf, "embeddings").select(F.concat(F.lit("s"), "vec_id").alias("scene_key"), F.lit("t1").alias("tile_id"), F.lit("l8").alias("sensor"), F.col("embedding").alias("features"))
    root = _store(spark, (_to_product(e, "pixel_features"), "pixel_features"))
    labels = table(spark, sf, "embeddings").select(F.concat(F.lit("s"), "vec_id").alias("scene_key"), F.when(F.pmod("label", F.lit(4)) != 3, F.pmod("label", F.lit(4))).alias("label"))
    rows = products.labelled_rows(products.read_product(spark, root, "pixel_features").drop("label"), labels, ["scene_key"])
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg(F.get("features", F.lit(1))).alias("mean"))


@query("px l, n_segments l, t_break s, break_class l", f"WITH {OBS}, {BREAKS} SELECT px, count(*) AS n_segments, max(t_break) AS t_break, max_by(break_class, t_break) AS break_class FROM br GROUP BY px")
def stored_segments(spark, sf):
    root = _store(spark, (_segments(spark, sf), "segment"))
    return _px(segmentation.summary(products.read_product(spark, root, "segment"), stages.PIXEL))


@query("column s, type s, n l, n_missing l", f"WITH {MONTHLY_CLS}, t AS (SELECT count(*) AS n, count(*) FILTER (cls = 2) AS gone FROM mc) SELECT unnest(['tile_id', 'row', 'col', 'month', 'class_id']) AS column, unnest(['string', 'int', 'int', 'date', 'smallint']) AS type, n, unnest([0, 0, 0, 0, gone]) AS n_missing FROM t")
def described_product(spark, sf):
    return products.described(spark, _store(spark, (_monthly(spark, sf).withColumn("class_id", F.when(F.col("class_id") != 2, F.col("class_id"))), "monthly_class")), "monthly_class")


@query("product s, partitions l", "SELECT unnest(['monthly_class', 'scene_manifest', 'tile_registry']) AS product, unnest([(SELECT count(DISTINCT l_suppkey % 5) FROM lineitem), 0, 0]) AS partitions")
def stored_products(spark, sf):
    root = _store(spark, (_monthly(spark, sf), "monthly_class"), (_to_product(table(spark, sf, "nation").withColumn("tile_id", F.col("n_name")), "tile_registry"), "tile_registry"), (_to_product(table(spark, sf, "nation").withColumn("tile_id", F.col("n_name")), "scene_manifest"), "scene_manifest"))
    return products.stored(spark, root)


@query("product s, status s, n l", f"WITH {MONTHLY_CLS} SELECT 'monthly_class' AS product, 'ok' AS status, count(*) AS n FROM mc UNION ALL SELECT 'event', 'skipped', 0")
def export_status(spark, sf):
    root = _store(spark, (_monthly(spark, sf), "monthly_class"))
    done = products.export_all(spark, root, f"{root}/text", ["monthly_class", "event"])
    text = spark.read.option("header", True).csv(f"{root}/text/monthly_class").agg(F.count(F.lit(1)).alias("n")).select(F.lit("monthly_class").alias("product"), "n")
    return done.join(text, "product", "left").select("product", "status", F.coalesce("n", F.lit(0)).alias("n"))


CONFIG = """
root: ${ROOT}/products
years: [${FIRST:-1984}, 2020]
model: {kind: random_forest, trees: ${TREES:-300}}
"""


@query("key s, value s", "SELECT unnest(['root', 'years', 'model.kind', 'model.trees']) AS key, unnest(['/data/products', '1999,2020', 'random_forest', '300']) AS value")
def config_values(spark, sf):
    found = config.parse_config(CONFIG, {"ROOT": "/data", "FIRST": "1999"})
    flat = [("root", found["root"]), ("years", ",".join(map(str, found["years"]))), *((f"model.{k}", str(v)) for k, v in found["model"].items())]
    return spark.createDataFrame(flat, "key string, value string")


CLASS_FILE = """
classes:
  - {id: 3, name: wet_meadow, color: [10, 20, 30]}
  - {id: 7, name: haze, color: [0, 0, 255], change_eligible: false}
"""


@query("raw_id l, dense_id l, display_name s, blue l, change_eligible b", "SELECT unnest([3, 7]) AS raw_id, unnest([0, 1]) AS dense_id, unnest(['wet meadow', 'haze']) AS display_name, unnest([30, 255]) AS blue, unnest([true, false]) AS change_eligible")
def class_file(spark, sf):
    return config.parse_classes(spark, CLASS_FILE).withColumn("blue", F.get("color", F.lit(2)))


@query("px l, month s, class_id l", f"SELECT px, month, cls AS class_id FROM ({_composite_sql(RULES)}) WHERE cls IS NOT NULL")
def stage_monthly_classes(spark, sf):
    root = _store(spark, (_to_product(_observations(spark, sf), "scene_class"), "scene_class"))
    stages.monthly_classes(spark, root, RULES)
    return _px(products.read_product(spark, root, "monthly_class"))


@query(
    "px l, class_name s, start_month s, end_month s",
    f"""WITH {INTERVALS}, bk AS (SELECT px, obs_date AS t FROM obs WHERE nir > 0.9 GROUP BY ALL HAVING max(red) >= 0.1), nr AS (SELECT iv.px, interval, t, (year(t) - year(start_month)) * 12 + month(t) - month(start_month) AS gap FROM iv JOIN bk USING (px)),
    bs AS (SELECT px, interval, t FROM nr WHERE gap BETWEEN -18 AND 6 QUALIFY row_number() OVER (PARTITION BY px, interval ORDER BY abs(gap), t) = 1)
    SELECT iv.px, 'open' AS class_name, coalesce(date_trunc('month', t)::DATE, start_month) AS start_month, end_month FROM iv LEFT JOIN bs USING (px, interval)""",
)
def stage_persistence(spark, sf):
    root = _store(spark, (_monthly(spark, sf), "monthly_class"), (_segments(spark, sf), "segment"))
    stages.persistence(spark, root, {"open": 1}, start_share=0.6, least_months=6)
    return _px(products.read_product(spark, root, "interval"))


@query(
    "px l, from_month s, to_month s, to_class l, persistent b, corroborated b",
    f"""WITH {MONTHLY_CLS}, {_changes_sql(12)}, ms AS (SELECT DISTINCT px % 5 AS tile, month FROM mc), nx AS (SELECT tile, month, lead(month, 1) OVER w AS n1, lead(month, 2) OVER w AS n2 FROM ms WINDOW w AS (PARTITION BY tile ORDER BY month))
    SELECT ch.px, from_month, to_month, to_class, coalesce(c1.cls = to_class, false) AND coalesce(c2.cls = to_class, false) AS persistent, EXISTS (SELECT 1 FROM obs WHERE obs.px = ch.px AND nir > 0.9 AND abs(obs_date - to_month) <= 45) AS corroborated FROM ch JOIN nx ON ch.px % 5 = nx.tile AND ch.to_month = nx.month
    LEFT JOIN mc c1 ON c1.px = ch.px AND c1.month = n1 LEFT JOIN mc c2 ON c2.px = ch.px AND c2.month = n2 WHERE changed""",
)
def stage_change_map(spark, sf):
    root = _store(spark, (_monthly(spark, sf), "monthly_class"), (_segments(spark, sf), "segment"))
    stages.change_map(spark, root, follow=2)
    return _px(products.read_product(spark, root, "change_12"))


@query(
    "px l, year l, gs_mean d, annual_max d, n_obs l",
    f"""WITH {MONTHLY}, y AS (SELECT px, year(month) AS year, avg(CASE WHEN month(month) BETWEEN 5 AND 10 THEN v END) AS a, max(v) AS b, count(CASE WHEN month(month) BETWEEN 5 AND 10 THEN v END) AS n_obs FROM mon GROUP BY ALL)
    SELECT px, year, CASE WHEN n_obs >= 2 THEN a END AS gs_mean, CASE WHEN n_obs >= 2 THEN b END AS annual_max, n_obs FROM y""",
)
def stage_dynamics(spark, sf):
    root = _store(spark, (_index(spark, sf), "monthly_index"))
    stages.dynamics(spark, root)
    return _px(products.read_product(spark, root, "yearly_index"))


@query("px l, baseline d, trough d, recovery_year l, status s, rate d", f"WITH {CURVES.replace('0.95', '0.8')} SELECT px, baseline, trough, recovery_year, status, rate FROM cu")
def stage_recoveries(spark, sf):
    ev = _keyed(sales(spark, sf).select("px").distinct()).withColumns({"break_date": F.make_date(F.lit(1998), F.lit(7), F.lit(1)), "event_type": F.when(F.col("px") % 2 == 0, "fire").otherwise("cutblock")})
    root = _store(spark, (_to_product(ev, "event"), "event"), (_to_product(_keyed(yearly(spark, sf)).withColumn("gs_mean", F.col("v")), "yearly_index"), "yearly_index"), (_monthly(spark, sf), "monthly_class"))
    stages.recoveries(spark, root)
    return _px(products.read_product(spark, root, "recovery"))


SCENE_STATUS = "CASE WHEN k % 7 = 0 THEN 'skip (already stored)' WHEN k % 7 = 1 THEN 'error (grid: shape)' WHEN k % 7 = 2 THEN 'error (grid: transform)' WHEN k % 7 = 3 THEN 'error (grid: crs)' ELSE 'ok' END"


def _raw(spark, sf):
    """A scene for each supplier: its sales are the cells."""
    own = _observations(spark, sf).withColumns({"scene_id": F.concat(F.lit("s"), _px_of()), "sensor": F.lit("l8"), "col": F.row_number().over(_by_scene())})
    return own.withColumn("row", F.lit(0))


def _px_of():
    return (F.col("row") * 1000 + F.col("col")).cast("string")


def _by_scene():
    from pyspark.sql import Window as W

    return W.partitionBy("row", "col").orderBy("obs_date", "scene_id")


def _processed(spark, sf):
    raw = _raw(spark, sf)
    headers = raw.select("tile_id", "sensor", "scene_id").distinct().withColumn("k", F.pmod(F.substring("scene_id", 2, 20).cast("long"), F.lit(7)))
    headers = headers.select("tile_id", "sensor", "scene_id", F.when(F.col("k") == 1, 849).otherwise(850).alias("n_rows"), F.lit(850).alias("n_cols"), F.when(F.col("k") == 2, 500000.5).otherwise(500000.0).alias("x0"), F.lit(6e6).alias("y0"), F.lit(10.0).alias("res"), F.when(F.col("k") == 3, "EPSG:32609").otherwise("EPSG:32610").alias("crs"))
    grids = raw.select("tile_id").distinct().select("tile_id", F.lit(850).alias("n_rows"), F.lit(850).alias("n_cols"), F.lit(500000.0).alias("x0"), F.lit(6e6).alias("y0"), F.lit(10.0).alias("res"), F.lit("EPSG:32610").alias("crs"))
    root = products.shared_root(spark)
    products.append_scenes(raw.where("substring(scene_id, 2, 20) % 7 = 0"), root)
    return root, stages.process_scenes(spark, root, raw, headers, grids)


@query("tile_id s, scene_id s, status s", f"WITH {OBS} SELECT DISTINCT 't' || px % 5 AS tile_id, 's' || px AS scene_id, {SCENE_STATUS.replace('k %', 'px %')} AS status FROM obs")
def scene_processing_status(spark, sf):
    return _processed(spark, sf)[1]


@query("scene_id s, n l, nir d", f"WITH {OBS} SELECT 's' || px AS scene_id, count(*) AS n, sum(CASE WHEN px % 7 = 0 THEN nir ELSE nir * {bandpass_table()['nir'][0]} + ({bandpass_table()['nir'][1]}) END) AS nir FROM obs WHERE px % 7 = 0 OR px % 7 > 3 GROUP BY px")
def scene_processing(spark, sf):
    """What was stored before stays as it was; scenes that came through are on the common bandpass; scenes off the grid are absent."""
    return products.read_product(spark, _processed(spark, sf)[0], "observation").groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.sum("nir").alias("nir"))


@query(
    "px l, t_break s, n_obs l",
    f"""WITH {MONTHLY}, o AS (SELECT px, month AS d, pow((v - 0.5) / 0.1, 2) > 2.0 AS over FROM mon), g AS (SELECT *, sum((NOT over)::INT) OVER (PARTITION BY px ORDER BY d) AS run FROM o),
    r AS (SELECT px, run, d, row_number() OVER w AS n, min(d) OVER w AS first FROM g WHERE over WINDOW w AS (PARTITION BY px, run ORDER BY d))
    SELECT px, first AS t_break, n AS n_obs FROM r WHERE n >= 3 AND d - first >= 45 QUALIFY row_number() OVER (PARTITION BY px, run ORDER BY d) = 1""",
)
def stream_alerts(spark, sf):
    """Months arrive as a stream and meet a constant model: runs of exceedances are told once, when they are long enough."""
    from ..keys import Series
    from ..streaming import monitor

    root = products.shared_root(spark)
    months = monthly_nir(spark, sf).select("px", F.col("month").alias("d"), "v")
    months.coalesce(1).write.parquet(f"{root}/months")
    models = months.select("px").distinct().select("px", F.to_date(F.lit("1990-01-01")).alias("t_start"), F.lit(0.5).alias("level"), *[F.lit(0.0).alias(c) for c in ("slope", "amplitude", "peak_doy")], F.lit(0.1).alias("rmse"))
    stream = spark.readStream.schema("px long, d date, v double").parquet(f"{root}/months")
    found = monitor.alerts(stream, models, Series(keys=("px",), time="d"), "v", threshold=2.0, conse=3)
    found.writeStream.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(f"{root}/alerts")).outputMode("append").option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("px long, t_break date, n_obs int").parquet(f"{root}/alerts")


@query("sensor s, scenes l, n_obs l, red d", f"WITH {OBS} SELECT sensor, count(DISTINCT scene_id) AS scenes, count(*) AS n_obs, sum(red) AS red FROM obs GROUP BY sensor")
def stream_ingest(spark, sf):
    """Scenes arrive in two deliveries of which the second repeats the first: each is stored once."""
    from ..streaming import ingest

    root = products.shared_root(spark)
    obs = _observations(spark, sf)
    for part in (obs.where(F.pmod(F.xxhash64("scene_id"), F.lit(3)) == 0), obs):
        part.write.mode("append").parquet(f"{root}/inbox")
        ingest.ingest(ingest.observations(spark, f"{root}/inbox"), f"{root}/store", f"{root}/progress").awaitTermination()
    back = products.read_product(spark, f"{root}/store", "observation")
    return back.groupBy("sensor").agg(F.countDistinct("scene_id").alias("scenes"), F.count(F.lit(1)).alias("n_obs"), F.sum("red").alias("red"))
