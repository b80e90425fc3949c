"""Scene catalogues: admission, filter cascade with reasons, manifests and resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCENE = ["tile_id", "sensor", "scene_id"]


def admissible(scenes: DataFrame, sensors: DataFrame, no_l7_from: int = 2003) -> DataFrame:
    """Scenes of known sensors in the years of their service; l7 from no_l7_from on is never admitted."""
    dim = F.broadcast(sensors.select("sensor", "first_year", "last_year"))  # a row for each sensor
    own = scenes.join(dim, "sensor").where((F.col("year") >= F.col("first_year")) & (F.col("last_year").isNull() | (F.col("year") <= F.col("last_year"))))
    return own.where((F.col("sensor") != "l7") | (F.col("year") < no_l7_from)).drop("first_year", "last_year")


def coverage_pct(box: dict[str, Column], foot: dict[str, Column]) -> Column:
    """Percent of a tile's box (minx, miny, maxx, maxy) under a footprint's box."""
    zero = F.lit(0.0)
    wide = F.greatest(zero, F.least(box["maxx"], foot["maxx"]) - F.greatest(box["minx"], foot["minx"]))
    high = F.greatest(zero, F.least(box["maxy"], foot["maxy"]) - F.greatest(box["miny"], foot["miny"]))
    return F.coalesce(F.try_divide(100.0 * wide * high, (box["maxx"] - box["minx"]) * (box["maxy"] - box["miny"])), zero)


def cascade(scenes: DataFrame, done: DataFrame | None = None, most_cloud: float = 20.0, least_cover: float = 50.0, least_reflectance: float | None = None, most_a_month: int | None = None) -> DataFrame:
    """scenes with status and reason: cached, cloud, coverage, reflectance or budget, the first that applies; kept else.

    Unknown cloud is a rejection. The monthly budget keeps the least cloudy of what passed, by scene id on ties, through one
    window; done is an anti-join's other side and may be large.
    """
    own = scenes
    if done is not None:
        own = own.join(done.select(*SCENE).distinct().withColumn("_done", F.lit(True)), SCENE, "left")
    else:
        own = own.withColumn("_done", F.lit(None).cast("boolean"))
    reason = F.when(F.col("_done"), "cached").when(F.col("cloud_pct").isNull() | (F.col("cloud_pct") > most_cloud), "cloud").when(F.coalesce("aoi_coverage_pct", F.lit(0.0)) < least_cover, "coverage")
    if least_reflectance is not None:
        reason = reason.when(F.coalesce("max_reflectance", F.lit(0.0)) < least_reflectance, "reflectance")
    own = own.withColumn("reason", reason)
    if most_a_month is not None:
        rank = F.row_number().over(W.partitionBy("tile_id", "sensor", "year", "month", F.col("reason").isNull()).orderBy("cloud_pct", "scene_id"))
        own = own.withColumn("_rank", rank).withColumn("reason", F.when(F.col("reason").isNull() & (F.col("_rank") > most_a_month), "budget").otherwise(F.col("reason"))).drop("_rank")
    return own.withColumn("status", F.when(F.col("reason").isNull(), "kept").otherwise("rejected")).drop("_done")


def least_cloudy(scenes: DataFrame, by: list[str], k: int, cloud: str = "cloud_pct", scene: str = "scene_id") -> DataFrame:
    """The k least cloudy scenes of each group, by scene id on ties, with their rank."""
    return scenes.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.col(cloud).asc_nulls_last(), scene))).where(F.col("rank") <= k)


def plausible(obs: DataFrame, scene: list[str], bands: list[str], least: float = 0.15) -> DataFrame:
    """Scenes whose greatest reflectance reaches `least`."""
    top = F.greatest(*[F.max(b) for b in bands]) if len(bands) > 1 else F.max(bands[0])
    return obs.groupBy(*scene).agg(top.alias("max_reflectance")).where(F.col("max_reflectance") >= least)


def valid_share(obs: DataFrame, scene: list[str], features: list[str], least: float = 0.3) -> DataFrame:
    """scene, n, valid_ratio, passes: share of pixels with all features finite."""
    ok = F.lit(True)
    for f in features:
        ok = ok & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return obs.groupBy(*scene).agg(F.count(F.lit(1)).alias("n"), F.avg(ok.cast("double")).alias("valid_ratio")).withColumn("passes", F.col("valid_ratio") >= least)


def usable(obs: DataFrame, label: str, masked: list, features: list[str]) -> DataFrame:
    """Observations of an unmasked class with all features there."""
    ok = F.col(label).isNotNull() & ~F.col(label).isin(*masked)
    for f in features:
        ok = ok & F.col(f).isNotNull()
    return obs.where(ok)


def latest(manifest: DataFrame, at: str = "cached_at") -> DataFrame:
    """The last record of each scene: an upsert by reading."""
    return manifest.withColumn("_r", F.row_number().over(W.partitionBy(*SCENE).orderBy(F.desc(at)))).where("_r = 1").drop("_r")


def upsert(manifest: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """manifest with the rows of new in place of those with their keys."""
    keys = keys or SCENE
    return manifest.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def missing_from(stored: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Stored scenes without a counterpart in done: not yet labelled, or not yet built."""
    return stored.join(done, keys or SCENE, "left_anti")


def stale(items: DataFrame, outputs: DataFrame, keys: list[str], sig: str = "signature") -> DataFrame:
    """Items whose output is missing or was made under another signature."""
    return items.join(outputs.select(*keys, sig), [*keys, sig], "left_anti")


def pseudo_labels(pixels: DataFrame, scene: list[str], confidence: str = "confidence", label: str = "pred", rare: list | None = None, common_least: float = 0.9, rare_least: float = 0.7, least_share: float = 0.05) -> DataFrame:
    """Confident pixels, with a lower bar for rare classes, of scenes where enough pixels are confident."""
    bar = F.when(F.col(label).isin(*(rare or [])), rare_least).otherwise(common_least) if rare else F.lit(common_least)
    own = pixels.withColumn("_ok", F.col(confidence) >= bar)
    return own.withColumn("_share", F.avg(F.col("_ok").cast("double")).over(W.partitionBy(*scene))).where(F.col("_ok") & (F.col("_share") >= least_share)).drop("_ok", "_share")


def grid_check(headers: DataFrame, expected: DataFrame, keys: list[str] | None = None, tolerance: float = 1e-6) -> DataFrame:
    """headers with problem: missing, crs, shape or transform, the first that applies; null where a grid is its tile's.

    expected has a row for each tile: n_rows, n_cols, x0, y0, res and crs; headers the same columns for each stored array.
    """
    keys = keys or ["tile_id"]
    grid = ("n_rows", "n_cols", "x0", "y0", "res", "crs")
    own = headers.join(expected.select(*keys, *[F.col(c).alias(f"_{c}") for c in grid]), keys, "left")
    off = F.lit(False)
    for c in ("x0", "y0", "res"):
        off = off | (F.abs(F.col(c) - F.col(f"_{c}")) > tolerance)
    problem = F.when(F.col("_n_rows").isNull(), "missing").when(F.col("crs") != F.col("_crs"), "crs").when((F.col("n_rows") != F.col("_n_rows")) | (F.col("n_cols") != F.col("_n_cols")), "shape").when(off, "transform")
    return own.withColumn("problem", problem).drop(*[f"_{c}" for c in grid])


def counters(manifest: DataFrame, by: list[str], statuses: tuple[str, ...] = ("kept", "rejected")) -> DataFrame:
    """by, total and the number of scenes of each status: counters of parts add up to those of the whole."""
    return manifest.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == x).alias(x) for x in statuses])


def discover(scenes: DataFrame, sensors: DataFrame, done: DataFrame, footprints: DataFrame, tiles: DataFrame, most_cloud: float = 20.0, least_cover: float = 50.0, most_a_month: int | None = None, reflectance: DataFrame | None = None, least_reflectance: float = 0.15) -> DataFrame:
    """Manifest of a search: what needs the catalogue alone comes first, then coverage, then the budget, then reflectance.

    scenes: the catalogue. footprints(scene keys, minx, miny, maxx, maxy) and tiles(tile_id and box) give the coverage of those that
    are left; reflectance(scene keys, max_reflectance) the last check. Rejected scenes keep the reason of the step that turned them down.
    """
    cheap = cascade(admissible(scenes, sensors).drop("aoi_coverage_pct", "max_reflectance").withColumn("aoi_coverage_pct", F.lit(100.0)), done, most_cloud, 0.0)
    left = cheap.where("status = 'kept'").drop("aoi_coverage_pct", "status", "reason")
    box = lambda side: {c: F.col(f"{side}_{c}") for c in ("minx", "miny", "maxx", "maxy")}
    feet = footprints.select(*SCENE, *[F.col(c).alias(f"f_{c}") for c in box("f")])
    own = left.join(feet, SCENE, "left").join(tiles.select("tile_id", *[F.col(c).alias(f"t_{c}") for c in box("t")]), "tile_id", "left")
    covered = own.withColumn("aoi_coverage_pct", coverage_pct(box("t"), box("f"))).drop(*[f"{x}_{c}" for x in "ft" for c in box(x)])
    fitting = cascade(covered, None, most_cloud, least_cover, most_a_month=most_a_month)
    if reflectance is not None:
        top = reflectance.select(*SCENE, F.col("max_reflectance").alias("_top"))
        dim = (F.col("status") == "kept") & (F.coalesce("_top", F.lit(0.0)) < least_reflectance)
        fitting = fitting.join(top, SCENE, "left").withColumn("reason", F.when(dim, "reflectance").otherwise(F.col("reason"))).withColumn("status", F.when(dim, "rejected").otherwise(F.col("status"))).drop("_top")
    columns = [*SCENE, "year", "month", "status", "reason", "cloud_pct"]
    return cheap.where("status <> 'kept'").select(*columns).unionByName(fitting.select(*columns))
