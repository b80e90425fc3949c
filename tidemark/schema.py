"""Table schemas and the small dimensions. Missing is NULL inside the engine; sentinels exist only in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIXEL = "tile_id string, row int, col int"
SCHEMAS: dict[str, str] = {
    "class_dim": "raw_id short, dense_id short, name string, display_name string, color array<int>, change_eligible boolean",
    "sensor_dim": "sensor string, first_year int, last_year int, resolution_m double, scale_divisor double, priority int",
    "tile_registry": "tile_id string, row int, col int, search_minx double, search_miny double, search_maxx double, search_maxy double, window_minx double, window_miny double, window_maxx double, window_maxy double, tile_size_m double, buffer_m double, area_km2 double, aoi_cover_pct double, aoi_id string, aoi_name string, mode string, crs string, dem_source_priority string",
    "split_assignment": "tile_id string, split_index int, split_name string",
    "scene_catalog": "tile_id string, sensor string, scene_id string, year int, month int, cloud_pct double, aoi_coverage_pct double, max_reflectance double",
    "scene_manifest": "tile_id string, sensor string, scene_id string, year int, month int, status string, reason string, cloud_pct double",
    "observation": f"{PIXEL}, sensor string, scene_id string, obs_date date, blue double, green double, red double, nir double, swir1 double, swir2 double, class_id short",
    "scene_class": f"{PIXEL}, sensor string, scene_id string, obs_date date, class_id short",
    "dem": f"{PIXEL}, elevation double, slope double, aspect double",
    "composite_rules": "class_id short, rule string, priority int, min_count int, doy_start int, doy_end int",
    "monthly_class": f"{PIXEL}, month date, class_id short",
    "monthly_index": f"{PIXEL}, month date, index_name string, median double, min double, max double, n_obs int",
    "segment": f"{PIXEL}, seg_index short, t_start date, t_end date, t_break date, n_obs int, seg_class short, seg_class_frac double, break_class short, break_class_frac double, persist_flag boolean, feat array<struct<name: string, magnitude: double, level: double, slope: double, amplitude: double, peak_doy: double, rmse: double, resid_magnitude: double>>",
    "interval": f"{PIXEL}, class_name string, start_month date, end_month date",
    "event": f"{PIXEL}, break_date date, event_type string, drop double, rise double, dnbr double, pre_forest boolean, cleared_seasons int, burned_fraction double, bare_fraction double, recovered boolean, recovery_year int, duration_months int, object_px int",
    "yearly_index": f"{PIXEL}, year int, gs_mean double, annual_max double, n_obs int",
    "pixel_features": "scene_key string, tile_id string, sensor string, label short, features array<double>",
    "scores": "scene_key string, row int, col int, truth short, probs array<double>",
}

#: Sentinels of the file formats.
CLASS_NODATA, REFLECTANCE_NODATA, REFLECTANCE_SCALE = 255, 65535, 10000

#: Raw id, name, colour, whether a change of the class counts. The dense id is the position.
CLASSES = [
    (0, "forest", (34, 94, 42), True),
    (1, "bare_ground", (200, 170, 130), True),
    (2, "grassland_herbaceous", (140, 200, 90), True),
    (3, "cultivated_agriculture", (230, 182, 92), True),
    (4, "wetland_marsh", (66, 168, 154), True),
    (5, "open_water", (40, 96, 191), True),
    (6, "cutblock_harvest", (176, 124, 60), True),
    (7, "burned_disturbed", (140, 60, 40), True),
    (8, "snow_cover", (235, 245, 255), True),
    (9, "ice_cover", (180, 220, 235), True),
    (10, "rock_alpine_bare", (153, 153, 153), True),
    (13, "built_up_infrastructure", (200, 30, 30), True),
    (14, "cloud", (225, 225, 230), False),
    (15, "shadow", (40, 40, 40), False),
    (16, "firn", (200, 215, 240), True),
    (17, "sand_gravel", (245, 226, 160), True),
]

#: Sensor, first and last year, resolution, divisor of stored values, place in composites.
SENSORS = [
    ("s2", 2015, None, 10.0, 10000.0, 0),
    ("l9", 2021, None, 30.0, 1.0, 1),
    ("l8", 2013, None, 30.0, 1.0, 2),
    ("l7", 1999, 2002, 30.0, 1.0, 3),
    ("l5", 1984, 2011, 30.0, 1.0, 4),
]


def class_dim(spark: SparkSession, classes: list[tuple] | None = None) -> DataFrame:
    """class_dim from (raw id, name, colour, eligible); repeated ids or names are an error."""
    classes = CLASSES if classes is None else classes
    for what in (0, 1):
        seen = [c[what] for c in classes]
        if len(set(seen)) != len(seen):
            raise ValueError(f"repeated class {'name' if what else 'id'}: {sorted({x for x in seen if seen.count(x) > 1})}")
    rows = [(raw, n, name, name.replace("_", " "), list(color), eligible) for n, (raw, name, color, eligible) in enumerate(classes)]
    return spark.createDataFrame(rows, SCHEMAS["class_dim"])


def sensor_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SENSORS, SCHEMAS["sensor_dim"])


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in all float columns: Spark would order it as the largest value and aggregate it."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in df.dtypes if t in ("double", "float")})
