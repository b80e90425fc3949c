"""The engine's tables in terms of the relational test tables, and the same as SQL.

A series is a supplier's sales (dense) or a customer's orders (sparse); a month of sales is a month of observations;
return flags are classes, line numbers sensors, and scaled prices and discounts bands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..keys import Series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SALES = Series(keys=("px",), time="obs_date", label="cls", source="sensor", scene="scene_id")
MONTHS = SALES.at(time="month")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.col("l_suppkey").alias("px"),
        F.to_date("l_shipdate").alias("obs_date"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("cls"),
        F.element_at(F.array(*[F.lit(x) for x in ("l5", "l7", "l8", "l9", "s2", "l5", "l8")]), F.col("l_linenumber")).alias("sensor"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate")).alias("scene_id"),
        (F.col("l_quantity") / 50).alias("blue"),
        (F.col("l_tax") + 0.05).alias("green"),
        (F.col("l_discount") + 0.02).alias("red"),
        (F.col("l_extendedprice") / 105000).alias("nir"),
        (F.col("l_quantity") / 60 + 0.01).alias("swir1"),
        (F.col("l_discount") + F.col("l_tax")).alias("swir2"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.pmod("l_suppkey", F.lit(5)).alias("tile"),
    )


OBS = """obs AS (
  SELECT l_suppkey AS px, l_shipdate::DATE AS obs_date, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS cls,
    (['l5','l7','l8','l9','s2','l5','l8'])[l_linenumber] AS sensor, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE) AS scene_id,
    l_quantity / 50 AS blue, l_tax + 0.05 AS green, l_discount + 0.02 AS red, l_extendedprice / 105000 AS nir, l_quantity / 60 + 0.01 AS swir1,
    l_discount + l_tax AS swir2, l_orderkey AS ok, l_linenumber AS ln, l_suppkey % 5 AS tile
  FROM lineitem)"""


def monthly_nir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """px, month, v: one value for each supplier and month."""
    return sales(spark, sf_dir).groupBy("px", F.trunc("obs_date", "MM").alias("month")).agg(F.median("nir").alias("v"))


MONTHLY = OBS + """, mon AS (SELECT px, date_trunc('month', obs_date)::DATE AS month, median(nir) AS v FROM obs GROUP BY ALL)"""


def monthly_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """px, month, cls: the commonest class of each supplier and month, smallest on ties."""
    c = sales(spark, sf_dir).groupBy("px", F.trunc("obs_date", "MM").alias("month"), "cls").count()
    return c.groupBy("px", "month").agg(F.min_by("cls", F.struct(-F.col("count"), F.col("cls"))).alias("cls"))


MONTHLY_CLS = OBS + """, cc AS (SELECT px, date_trunc('month', obs_date)::DATE AS month, cls, count(*) AS n FROM obs GROUP BY ALL),
mc AS (SELECT px, month, cls FROM cc QUALIFY row_number() OVER (PARTITION BY px, month ORDER BY n DESC, cls) = 1)"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """px, year, v of each supplier's year, by month medians."""
    return monthly_nir(spark, sf_dir).groupBy("px", F.year("month").alias("year")).agg(F.avg("v").alias("v"))


YEARLY = MONTHLY + """, yr AS (SELECT px, year(month) AS year, avg(v) AS v FROM mon GROUP BY ALL)"""


def breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """px, t_break, drop, rise, break_class, event_type: large sales stand for breaks."""
    s = sales(spark, sf_dir).where("nir > 0.9")
    g = s.groupBy("px", F.col("obs_date").alias("t_break")).agg(F.max("red").alias("drop"), F.max("green").alias("rise"), F.min("cls").alias("break_class"))
    kind = F.when(F.col("drop") >= 0.1, "open_land_disturbance").when(F.col("break_class") == 0, "fire").when(F.col("rise") >= 0.1, "cutblock").otherwise("other_loss")
    return g.withColumn("event_type", kind)


BREAKS = """br AS (SELECT *, CASE WHEN drop_ >= 0.1 THEN 'open_land_disturbance' WHEN break_class = 0 THEN 'fire' WHEN rise >= 0.1 THEN 'cutblock' ELSE 'other_loss' END AS event_type
  FROM (SELECT px, obs_date AS t_break, max(red) AS drop_, max(green) AS rise, min(cls) AS break_class FROM obs WHERE nir > 0.9 GROUP BY ALL))"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, row, col, z, truth, pred, burned: a grid of cells of 40 columns for each tile, from the parts."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    return p.select(
        F.pmod(n, F.lit(3)).cast("int").alias("tile"),
        F.floor(n / 3 / 40).cast("int").alias("row"),
        F.pmod(F.floor(n / 3), F.lit(40)).cast("int").alias("col"),
        F.col("p_retailprice").alias("z"),
        F.floor(F.col("p_size") / 17).cast("int").alias("truth"),
        F.floor(F.pmod(F.col("p_size") * 7, F.lit(51)) / 17).cast("int").alias("pred"),
        (F.col("p_size") / 50).alias("share"),
    )


CELLS = """cells AS (
  SELECT (p_partkey % 3)::INT AS tile, floor(p_partkey / 3 / 40)::INT AS row, (floor(p_partkey / 3) % 40)::INT AS col, p_retailprice AS z,
    floor(p_size / 17)::INT AS truth, floor(((p_size * 7) % 51) / 17)::INT AS pred, p_size / 50 AS share FROM part)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """aoi_id, minx, miny, maxx, maxy: a box for each nation."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("aoi_id"), (n * 3700.0).alias("minx"), (n * 2100.0 - 9000.0).alias("miny"), (n * 3700.0 + 9000.0 + n * 500.0).alias("maxx"), (n * 2100.0 + n * 700.0).alias("maxy"))


BOXES = "boxes AS (SELECT n_name AS aoi_id, n_nationkey * 3700.0::DOUBLE AS minx, n_nationkey * 2100.0::DOUBLE - 9000 AS miny, n_nationkey * 3700.0::DOUBLE + 9000 + n_nationkey * 500.0 AS maxx, n_nationkey * 2100.0::DOUBLE + n_nationkey * 700.0 AS maxy FROM nation)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, truth, probs: four class probabilities of each vector from its components, and its label."""
    e = table(spark, sf_dir, "embeddings")
    up = [F.exp(F.get("embedding", F.lit(i)).cast("double") * 4) for i in range(4)]
    total = up[0] + up[1] + up[2] + up[3]
    return e.select(F.col("vec_id").alias("id"), F.pmod("label", F.lit(4)).cast("int").alias("truth"), F.array(*[u / total for u in up]).alias("probs"))


SCORED = """raw AS (SELECT vec_id AS id, (label % 4)::INT AS truth, [exp(embedding[i]::DOUBLE * 4) for i in [1, 2, 3, 4]] AS u FROM embeddings),
sc AS (SELECT id, truth, [x / list_sum(u) for x in u] AS probs FROM raw)"""
