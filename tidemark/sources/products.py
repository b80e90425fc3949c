"""Product tables on storage: partitioned Parquet, idempotent appends, wide and text exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SCHEMAS

#: How each product lies on storage; a filter on these columns prunes folders.
LAYOUT: dict[str, list[str]] = {
    "observation": ["tile_id", "sensor"],
    "scene_class": ["tile_id", "sensor"],
    "monthly_class": ["tile_id"],
    "monthly_index": ["tile_id"],
    "segment": ["tile_id"],
    "interval": ["tile_id"],
    "event": ["tile_id"],
    "yearly_index": ["tile_id"],
    "dem": ["tile_id"],
    "tile_registry": [],
    "split_assignment": [],
    "scene_manifest": [],
    "scene_catalog": [],
}


def path_of(root: str, product: str) -> str:
    return f"{root.rstrip('/')}/{product}"


def read_product(spark: SparkSession, root: str, product: str, columns: list[str] | None = None) -> DataFrame:
    """The product, by its declared schema; no file is opened to find out about columns."""
    df = spark.read.schema(SCHEMAS[product]).parquet(path_of(root, product)) if product in SCHEMAS else spark.read.parquet(path_of(root, product))
    return df.select(*columns) if columns else df


def write_product(df: DataFrame, root: str, product: str, mode: str = "overwrite") -> str:
    """Rows sorted by cell inside files; overwrite replaces only the partitions that df has."""
    parts = LAYOUT.get(product, [c for c in ("tile_id",) if c in df.columns])
    order = [c for c in ("row", "col", "obs_date", "month", "year") if c in df.columns]
    out = df.repartition(*parts) if parts else df
    writer = (out.sortWithinPartitions(*parts, *order) if order else out).write.mode(mode).option("compression", "zstd")
    if parts:
        writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path_of(root, product))
    return path_of(root, product)


def append_scenes(df: DataFrame, root: str, product: str = "observation", key: tuple[str, ...] = ("tile_id", "sensor", "scene_id")) -> int:
    """Append the scenes that aren't stored yet; returns how many. Storing a scene again changes nothing.

    Scenes are told by their keys alone, which are read first; the rows are read once, to be written.
    """
    spark = df.sparkSession
    new = df.select(*key).distinct()
    try:
        new = new.join(read_product(spark, root, product, list(key)).distinct(), list(key), "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    n = new.count()
    if n:
        write_product(df.join(new, list(key), "left_semi").select(*df.columns), root, product, "append")
    return n


def scenes(df: DataFrame) -> DataFrame:
    """The stored scenes of an observation table, by sensor and scene."""
    return df.select("tile_id", "sensor", "scene_id", "obs_date").distinct().orderBy("tile_id", "sensor", "scene_id")


def months(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return df.select(*(by or []), "month").distinct().orderBy("month")


def classified_scenes(obs: DataFrame, classes: DataFrame, first: int, last: int) -> DataFrame:
    """Scenes of the years that have a classification, by date."""
    own = obs.where(F.year("obs_date").between(first, last)).select("tile_id", "sensor", "scene_id", "obs_date").distinct()
    return own.join(classes.select("tile_id", "sensor", "scene_id").distinct(), ["tile_id", "sensor", "scene_id"], "left_semi").orderBy("obs_date", "sensor", "scene_id")


def mask_labels(mask: DataFrame, dim: DataFrame, nodata: int | None = None) -> DataFrame:
    """Cells (r, g, b, a) as dense labels by the classes' colours; no match, or a = 0, is nodata. The dimension has a row a class."""
    own = F.broadcast(dim.select("dense_id", F.col("color")[0].alias("r"), F.col("color")[1].alias("g"), F.col("color")[2].alias("b")))
    return mask.join(own, ["r", "g", "b"], "left").withColumn("label", F.coalesce(F.when(F.col("a") > 0, F.col("dense_id")), F.lit(nodata).cast("short"))).drop("dense_id")


def wide_bands(df: DataFrame, by: list[str], period: str, values: list[str], periods: list) -> DataFrame:
    """A column for each value and period, <value>_<period>: the layout of a raster with bands."""
    return df.groupBy(*by).agg(*[F.max(F.when(F.col(period) == p, F.col(v))).alias(f"{v}_{p}") for p in periods for v in values])


def flat_columns(df: DataFrame, lengths: dict[str, list[str]]) -> DataFrame:
    """Array columns as one column for each label, <column>_<label>."""
    out = []
    for c in df.columns:
        out += [F.get(F.col(c), F.lit(i)).alias(f"{c}_{label}") for i, label in enumerate(lengths[c])] if c in lengths else [F.col(c)]
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def export_all(spark: SparkSession, root: str, out: str, products: list[str]) -> DataFrame:
    """Each product as text; a row with ok, skipped or error for each. The list is short and goes through the driver."""
    rows = []
    for p in products:
        try:
            df = read_product(spark, root, p)
            arrays = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
            write_csv(df.withColumns({c: F.to_json(c) for c in arrays}), f"{out}/{p}")
            rows.append((p, "ok", None))
        except Exception as e:
            rows.append((p, "skipped" if "PATH_NOT_FOUND" in str(e) else "error", str(e)[:200]))
    return spark.createDataFrame(rows, "product string, status string, message string")


def report(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.to_json(F.struct(*columns)).alias("report"))


def palette(dim: DataFrame, name: str = "classes") -> DataFrame:
    """The annotation palette as one JSON row."""
    return dim.agg(F.to_json(F.struct(F.lit(name).alias("name"), F.sort_array(F.collect_list(F.struct("raw_id", "name", "color"))).alias("classes"))).alias("palette"))


def register_views(spark: SparkSession, root: str, products: list[str]) -> None:
    for p in products:
        read_product(spark, root, p).createOrReplaceTempView(p)


def shared_root(spark: SparkSession) -> str:
    """A new folder for products in the one that driver and executors share, spark.checkpoint.dir; a session in one process that sets
    none has it beside its warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.checkpoint"
    return f"{found.rstrip('/')}/tidemark-products/{uuid.uuid4().hex}"


def stored(spark: SparkSession, root: str) -> DataFrame:
    """product, partitions: the products under a root that have rows on storage, and how many folders their first partition column has."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for entry in fs.listStatus(path) if fs.exists(path) else []:
        if entry.isDirectory():
            inside = [x.getPath().getName() for x in fs.listStatus(entry.getPath())]
            if any(x.endswith(".parquet") or "=" in x for x in inside):
                rows.append((entry.getPath().getName(), sum("=" in x for x in inside)))
    return spark.createDataFrame(sorted(rows), "product string, partitions int")


def described(spark: SparkSession, root: str, product: str) -> DataFrame:
    """column, type, n, n_missing of a stored product, in one pass."""
    df = read_product(spark, root, product)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("_n").alias("n"), (F.col("_n") - F.col(f"n_{i}")).alias("n_missing")) for i, (c, t) in enumerate(df.dtypes)])))


def labelled_rows(features: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Annotated cells with their features: what a training table holds. Cells without label or with a missing feature are left out."""
    own = features.join(labels.where(F.col("label").isNotNull()).select(*key, "label"), key)
    return own.where(F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))))


def preview(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows by an order."""
    return df.orderBy(*order).limit(n)


def pixel_major(classes: DataFrame, keys: list[str], time: str, value: str, months: list, missing: int | None = None) -> DataFrame:
    """keys, values: each series as one array over the given months, `missing` where it has none."""
    own = classes.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(time).cast("string"), F.col(value)))).alias("_m"))
    return own.select(*keys, F.transform(F.array(*[F.lit(str(m)) for m in months]), lambda m: F.coalesce(F.try_element_at("_m", m), F.lit(missing))).alias("values"))


def rounded_doy(x: Column) -> Column:
    """A day of the year, or of a longer count, as a long; 0 where missing or not finite."""
    return F.coalesce(F.bround(x.cast("double")).try_cast("long"), F.lit(0).cast("long"))
