"""Files, configuration and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.schema import SCHEMAS
from tidemark.sources import config, products
from tidemark.streaming import ingest


def scene(spark, sid, day=1, n=4):
    rows = [("t1", i, i, "s2", sid, dt.date(2020, 1, day), *[0.1 * i] * 6, i) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMAS["observation"])


def test_append_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    assert products.append_scenes(scene(spark, "a"), root) == 1
    assert products.append_scenes(scene(spark, "a").unionByName(scene(spark, "b", 2)), root) == 1
    assert products.append_scenes(scene(spark, "b"), root) == 0
    back = products.read_product(spark, root, "observation")
    assert back.count() == 8 and products.scenes(back).count() == 2


def test_partitions_are_pruned_and_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("t1", 0, 0, dt.date(2020, 1, 1), 3), ("t2", 0, 0, dt.date(2020, 1, 1), 4)], SCHEMAS["monthly_class"])
    products.write_product(df, root, "monthly_class")
    products.write_product(df.where("tile_id = 't1'").withColumn("class_id", F.lit(9).cast("short")), root, "monthly_class")
    back = products.read_product(spark, root, "monthly_class")
    assert {r["tile_id"]: r["class_id"] for r in back.collect()} == {"t1": 9, "t2": 4}
    plan = back.where("tile_id = 't2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tile_id" in plan


def test_config_variables(tmp_path, monkeypatch):
    path = tmp_path / "c.yaml"
    path.write_text("a: ${X_SET}\nb: ${X_NONE:-7}\n")
    monkeypatch.setenv("X_SET", "hello")
    assert config.load_config(str(path)) == {"a": "hello", "b": 7}
    path.write_text("a: ${X_NONE}\n")
    with pytest.raises(KeyError):
        config.load_config(str(path))


def test_feature_order():
    assert config.feature_names(["NDVI"], ("slope", "aspect"), True, True, True) == ["NDVI", "slope", "aspect_sin", "aspect_cos", "doy_sin", "doy_cos", "lat_norm", "lon_norm", "cos_incidence", "cast_shadow"]


def test_stream_ingest_and_bins(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    scene(spark, "a").unionByName(scene(spark, "b", 20)).write.parquet(src)
    ingest.ingest(ingest.observations(spark, src), root, str(tmp_path / "ck1")).awaitTermination()
    scene(spark, "a").write.mode("append").parquet(src)
    ingest.ingest(ingest.observations(spark, src), root, str(tmp_path / "ck1")).awaitTermination()
    assert products.read_product(spark, root, "observation").count() == 8
    bins = ingest.binned(ingest.observations(spark, src), ["nir"], ["tile_id", "row", "col"])
    q = bins.writeStream.format("memory").queryName("bins").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("bins").agg(F.sum("n_obs")).first()[0] == 12


def test_export(spark, tmp_path):
    root = str(tmp_path / "p")
    products.write_product(scene(spark, "a"), root, "observation")
    status = {r["product"]: r["status"] for r in products.export_all(spark, root, str(tmp_path / "csv"), ["observation", "event"]).collect()}
    assert status == {"observation": "ok", "event": "skipped"}


def test_stream_alerts_follow_runs_over_batches(spark, tmp_path):
    from tidemark.keys import Series
    from tidemark.streaming import monitor

    s = Series(keys=("px",), time="d")
    src = str(tmp_path / "obs")
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    first = [(px, day(16 * i), 0.2 if px == 1 and i >= 8 else 0.6) for px in (1, 2) for i in range(10)]
    second = [(px, day(16 * i), 0.2 if px == 1 else 0.6 if i != 12 else 0.1) for px in (1, 2) for i in range(10, 16)]
    models = spark.createDataFrame([(px, day(0), 0.6, 0.0, 0.0, 0.0, 0.03) for px in (1, 2)], "px int, t_start date, level double, slope double, amplitude double, peak_doy double, rmse double")
    for n, rows in enumerate((first, second)):
        spark.createDataFrame(rows, "px int, d date, v double").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("px int, d date, v double").parquet(src)
        out = monitor.alerts(stream, models, s, "v")
        q = out.writeStream.foreachBatch(lambda b, _: b.write.mode("append").parquet(str(tmp_path / "out"))).outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = [(r["px"], r["t_break"], r["n_obs"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [(1, day(128), 4)]
