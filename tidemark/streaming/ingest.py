"""Structured Streaming forms of the incremental behaviours: idempotent scene ingest and binned medians."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SCHEMAS
from ..sources.products import append_scenes


def observations(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """Observations as they arrive as Parquet files in a folder."""
    return spark.readStream.schema(SCHEMAS["observation"]).option("maxFilesPerTrigger", files).parquet(path)


def ingest(stream: DataFrame, root: str, checkpoint: str):
    """Store each scene once, whatever is delivered again: every batch goes through the same idempotent append as a
    file load does. Runs over what is there, then stops."""

    def store(batch: DataFrame, _: int) -> None:
        append_scenes(batch, root)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def binned(stream: DataFrame, values: list[str], keys: list[str], days: int = 15, start: str = "0 days", late: str = "30 days") -> DataFrame:
    """Mean and count of each series and sensor in periods of so many days. Observations later than `late` after the newest
    are dropped; a batch run over everything is the way to take them in."""
    timed = stream.withColumn("_ts", F.col("obs_date").cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", f"{days} days", startTime=start), *keys, "sensor").agg(*[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("n_obs")).select(*keys, "sensor", F.col("window.start").cast("date").alias("bin_start"), *values, "n_obs")
