"""Product stages: each reads stored products, applies operators to all tiles at once, and stores its product.

Stages are independent of tiles' number: a stage is one query over the partitioned tables, and rewriting a tile replaces only that
tile's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.indices import with_indices
from ..keys import Series
from ..operators import changes, composite, events, intervals, phenology, recovery, segmentation, series, severity
from ..sources.products import read_product, write_product

PIXEL = Series()
MONTH = PIXEL.at(time="month")


def classified(spark: SparkSession, root: str) -> DataFrame:
    """Observations with their class, by (tile, sensor, scene, pixel); scenes without a classification are left out."""
    obs = read_product(spark, root, "observation").drop("class_id")
    return obs.join(read_product(spark, root, "scene_class").select("tile_id", "row", "col", "sensor", "scene_id", "class_id"), ["tile_id", "row", "col", "sensor", "scene_id"])


def monthly_classes(spark: SparkSession, root: str, rules: list[tuple], ignored: list[int] | None = None) -> str:
    classes = read_product(spark, root, "scene_class")
    return write_product(composite.monthly_class(classes, rules, PIXEL, ignored or [14, 15]).where("class_id is not null"), root, "monthly_class")


def monthly_indices(spark: SparkSession, root: str, names: list[str], masked: list[int] | None = None) -> str:
    own = classified(spark, root)
    if masked:
        own = own.where(~F.col("class_id").isin(*masked))
    return write_product(composite.monthly_stats(with_indices(own, names), names, PIXEL).withColumn("n_obs", F.col("n_obs").cast("int")), root, "monthly_index")


def segments(spark: SparkSession, root: str, params: segmentation.Params | None = None, masked: list[int] | None = None, days: int = 15) -> str:
    """Breaks of binned observations."""
    p = params or segmentation.Params()
    own = with_indices(classified(spark, root), list(p.features))
    if masked:
        own = own.where(~F.col("class_id").isin(*masked))
    binned = composite.binned_medians(own, list(p.features), ["tile_id"], PIXEL, days).withColumnRenamed("bin_date", "obs_date")
    return write_product(segmentation.segment(binned, PIXEL, p), root, "segment")


def persistence(spark: SparkSession, root: str, targets: dict[str, int], masked: list[int] | None = None, **how: object) -> str:
    monthly, breaks = read_product(spark, root, "monthly_class"), segmentation.breaks_of(read_product(spark, root, "segment"), PIXEL)
    out = None
    for name, cls in targets.items():
        spans = intervals.match_breaks(intervals.intervals(monthly, cls, MONTH, masked, **how), breaks, PIXEL)
        start = F.coalesce(F.trunc("break_date", "MM").cast("date"), "start_month")
        one = spans.select(*PIXEL.keys, F.lit(name).alias("class_name"), start.alias("start_month"), "end_month")
        out = one if out is None else out.unionByName(one)
    return write_product(out, root, "interval")


def named_events(spark: SparkSession, root: str, forest: int = 0, burned: int = 7, bare: int = 1, grass: int = 2, crop: int | None = 3, rules: events.Rules | None = None) -> str:
    """Breaks with a name: seasons around them, the ladder, objects, and cropland."""
    monthly = read_product(spark, root, "monthly_class")
    breaks = segmentation.breaks_of(read_product(spark, root, "segment"), PIXEL).withColumnRenamed("t_break", "break_date").select(*PIXEL.keys, "break_date", "drop", "rise")
    named = events.name_events(events.seasons_around(breaks, monthly, MONTH, forest, burned, bare, rules), PIXEL, rules)
    nbr = read_product(spark, root, "monthly_index").where("index_name = 'NBR'").select(*PIXEL.keys, "month", F.col("median").alias("nbr"))
    paired = changes.break_pairs(named, nbr, "nbr", MONTH, "break_date").withColumnRenamed("difference", "dnbr").drop("before", "after")
    whole = events.refine_objects(paired, ["tile_id"], "row", "col", r=rules)
    fields = events.cropland(monthly, MONTH, ["tile_id"], "row", "col", grass, bare, crop, rules)
    out = events.in_cropland(whole, fields, PIXEL).withColumn("recovery_year", F.col("recovered_year"))
    return write_product(out.drop("recovered_year", "last_year"), root, "event")


def change_map(spark: SparkSession, root: str, step: int = 12, eligible: list[int] | None = None, follow: int = 1, days: int = 45) -> str:
    """Annual or monthly changes with whether they persist and whether a break corroborates them."""
    monthly = read_product(spark, root, "monthly_class")
    breaks = segmentation.breaks_of(read_product(spark, root, "segment"), PIXEL)
    raw = changes.month_changes(monthly, MONTH, step, eligible)
    lasting = changes.confirmed_changes(raw, monthly, ["tile_id"], MONTH, follow)
    seen = changes.corroborated_changes(raw, breaks, PIXEL, days).select(*PIXEL.keys, "from_month", "to_month").withColumn("corroborated", F.lit(True))
    return write_product(lasting.join(seen.hint("merge"), [*PIXEL.keys, "from_month", "to_month"], "left").withColumn("corroborated", F.coalesce("corroborated", F.lit(False))), root, f"change_{step}")


def break_severity(spark: SparkSession, root: str) -> str:
    breaks = segmentation.breaks_of(read_product(spark, root, "segment"), PIXEL)
    index = read_product(spark, root, "monthly_index")
    nbr = index.where("index_name = 'NBR'").select(*PIXEL.keys, "month", F.col("median").alias("nbr"))
    ndvi = index.where("index_name = 'NDVI'").select(*PIXEL.keys, "month", F.col("median").alias("ndvi"))
    write_product(severity.regrowth(breaks, ndvi, "ndvi", MONTH), root, "trajectory")
    return write_product(severity.severity(breaks, nbr, "nbr", MONTH), root, "severity")


def snow_water(spark: SparkSession, root: str, snow: int = 8, firn: int = 16, ice: int = 9, water: int = 5, excluded: tuple[int, ...] = (14, 15), start_month: int = 10) -> str:
    return write_product(series.water_years(read_product(spark, root, "monthly_class"), MONTH, snow, firn, ice, water, list(excluded), start_month), root, "snow_water")


def dynamics(spark: SparkSession, root: str, index: str = "NDVI") -> str:
    """Yearly statistics, phenology, trend, variability and anomalies of an index."""
    v = read_product(spark, root, "monthly_index").where(F.col("index_name") == index).select(*PIXEL.keys, "month", F.col("median").alias("v"))
    years = series.yearly_stats(v, "v", MONTH)
    low = series.low_values(v, "v", MONTH).select(*PIXEL.keys, "low")
    z = series.z_scores(v, "v", MONTH)
    write_product(phenology.phenology(v.join(low, list(PIXEL.keys)), "v", "low", MONTH), root, "phenology")
    write_product(series.trend(years, "gs_mean", PIXEL).join(series.variability(years, "gs_mean", PIXEL).drop("n_years"), list(PIXEL.keys), "left"), root, "trend")
    write_product(series.yearly_anomaly(z, MONTH), root, "anomaly")
    return write_product(years.withColumn("n_obs", F.col("n_obs").cast("int")), root, "yearly_index")


def recoveries(spark: SparkSession, root: str, forest: int = 0, masked: list[int] | None = None) -> str:
    """Recovery of each event: curves, succession, transitions and class shares."""
    own = read_product(spark, root, "event").where("event_type <> 'none' and event_type <> 'gain'").groupBy(*PIXEL.keys).agg(F.year(F.max("break_date")).alias("event_year"), F.max_by("event_type", "break_date").alias("event_type"))
    yearly = read_product(spark, root, "yearly_index")
    seq = recovery.since_event(recovery.dominant_class(read_product(spark, root, "monthly_class"), MONTH, masked=masked), own, PIXEL)
    write_product(recovery.transitions(seq, list(PIXEL.keys), "event_type", "class_id"), root, "transition")
    write_product(recovery.class_shares(seq, "event_type", "class_id"), root, "state_share")
    curves = recovery.curves(yearly, own, "gs_mean", PIXEL)
    steps = recovery.succession(seq, list(PIXEL.keys), "class_id", forest)
    return write_product(curves.join(steps, list(PIXEL.keys), "left"), root, "recovery")


def dem_products(base: DataFrame, other: DataFrame | None, root: str, res: float, by: tuple[str, ...] = ("tile_id",)) -> str:
    """Elevation with gaps filled from a second source, slope and aspect of every tile, stored. base, other: by, row, col, elevation."""
    from ..operators import grid

    whole = grid.fill_gaps(base, other, list(by), "elevation") if other is not None else base
    return write_product(grid.slope_aspect(whole, list(by), res), root, "dem")


def process_scenes(spark: SparkSession, root: str, raw: DataFrame, headers: DataFrame, grids: DataFrame, sun: DataFrame | None = None, bands: tuple[str, ...] = ("blue", "green", "red", "nir", "swir1", "swir2")) -> DataFrame:
    """tile_id, sensor, scene_id, status: every raw scene brought to the common bandpass, corrected for terrain and stored.

    Scenes already stored are skipped and scenes whose grid isn't their tile's are errors, each with the reason; the others are ok. sun has the
    sun's elevation and azimuth of each scene; with it, terrain comes from the stored dem. All scenes go through one plan.
    """
    from ..functions import radiometry
    from ..operators import catalog
    from ..sources.products import append_scenes

    key = catalog.SCENE
    checked = catalog.grid_check(headers, grids)
    good = checked.where("problem is null").select(*key)
    try:
        known = read_product(spark, root, "observation", key).distinct()
        known.limit(1).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = headers.select(*key).limit(0)
    own = radiometry.harmonize(raw.join(good, key, "left_semi").join(known, key, "left_anti"))
    if sun is not None:
        dem = read_product(spark, root, "dem").select("tile_id", "row", "col", "slope", "aspect")
        lit = own.join(dem, ["tile_id", "row", "col"], "left").join(sun, key)
        own = radiometry.scs_c(lit, key, list(bands)).drop("slope", "aspect", "sun_elevation", "sun_azimuth", "illumination", "scs_c", "scs_ratio")
    before = known.withColumn("_known", F.lit(True))
    status = F.when(F.col("_known"), "skip (already stored)").when(F.col("problem").isNotNull(), F.concat(F.lit("error (grid: "), "problem", F.lit(")"))).otherwise("ok")
    out = checked.join(before, key, "left").select(*key, status.alias("status"))
    rows = out.sparkSession.createDataFrame(out.collect(), out.schema)  # a row for each scene, taken before the scenes are stored
    append_scenes(own.select(*read_columns()), root)
    return rows


def read_columns() -> list[str]:
    from ..schema import SCHEMAS

    return [c.strip().split(" ")[0] for c in SCHEMAS["observation"].split(",")]
