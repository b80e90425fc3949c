"""The product stages over a small forest with a cut."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions.features import feature_stack, gray_world, scene_context, utm_to_lonlat
from tidemark.operators import events, segmentation
from tidemark.plans import stages
from tidemark.schema import SCHEMAS, class_dim
from tidemark.sources.products import mask_labels, read_product, write_product

CUT = dt.date(2006, 7, 10)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("products"))
    rows = []
    for r in range(4):
        for c in range(4):
            cut = c < 2
            d = dt.date(2000, 1, 4)
            n = 0
            while d < dt.date(2014, 1, 1):
                gone = cut and d >= CUT
                season = 0.02 * math.cos(2 * math.pi * (d.timetuple().tm_yday - 200) / 365.25)
                noise = 0.004 * math.sin(n * 12.9898 + r * 3 + c)
                nir = (0.18 if gone else 0.40) + season + noise
                red, swir2 = (0.15, 0.20) if gone else (0.04, 0.08)
                sensor = "l8" if n % 2 else "l7"
                rows.append(("t1", r, c, sensor, f"LE07_0_{d:%Y%m%d}", d, 0.04, 0.06, red, nir, swir2 + 0.03, swir2, 1 if gone else 0))
                d += dt.timedelta(days=16)
                n += 1
    obs = spark.createDataFrame(rows, SCHEMAS["observation"])
    write_product(obs, where, "observation")
    write_product(obs.select("tile_id", "row", "col", "sensor", "scene_id", "obs_date", "class_id"), where, "scene_class")
    return where


def test_stages(spark, root):
    p = segmentation.Params(features=("NBR", "NDVI"), season=None)
    rules = events.Rules(object_px=10_000, line_extent=99)
    stages.monthly_classes(spark, root, [])
    stages.monthly_indices(spark, root, ["NBR", "NDVI"])
    stages.segments(spark, root, p)
    seg = read_product(spark, root, "segment")
    breaks = seg.where("t_break is not null").select("col", "t_break").collect()
    assert {b["col"] for b in breaks} == {0, 1} and all(abs((b["t_break"] - CUT).days) < 40 for b in breaks) and len(breaks) == 8
    stages.persistence(spark, root, {"bare": 1})
    spans = read_product(spark, root, "interval").collect()
    assert len(spans) == 8 and all(s["end_month"] is None and abs((s["start_month"] - CUT).days) < 40 for s in spans)
    stages.named_events(spark, root, rules=rules)
    ev = read_product(spark, root, "event").collect()
    assert {e["event_type"] for e in ev} == {"cutblock"} and all(e["pre_forest"] and e["object_px"] == 8 for e in ev)
    stages.change_map(spark, root)
    ch = spark.read.parquet(f"{root}/change_12")
    assert ch.where("changed and persistent").select("col").distinct().count() == 2
    assert ch.where("corroborated").count() >= 8
    stages.break_severity(spark, root)
    sev = spark.read.parquet(f"{root}/severity").collect()
    assert len(sev) == 8
    stages.snow_water(spark, root)
    stages.dynamics(spark, root)
    years = read_product(spark, root, "yearly_index")
    assert years.where("col = 0 and year = 2008").first()["gs_mean"] < 0.3 < years.where("col = 3 and year = 2008").first()["gs_mean"]
    stages.recoveries(spark, root)
    rec = spark.read.parquet(f"{root}/recovery").collect()
    assert len(rec) == 8 and all(r["status"] == "censored" and r["dropped"] for r in rec)


def test_inverse_projection(spark):
    x, y = utm_to_lonlat(F.lit(448251.8), F.lit(5411943.8), F.lit(31), F.lit(True))
    lon, lat = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert lon == pytest.approx(2.2945, abs=2e-4) and lat == pytest.approx(48.8582, abs=2e-4)


def test_vectors(spark):
    d = spark.createDataFrame([("s2", dt.date(2020, 7, 1), 45.0, 90.0, 0.1, 0.3)], "sensor string, d date, lat double, lon double, a double, b double")
    v = d.select(scene_context(F.col("sensor"), F.col("d"), F.col("lat"), F.col("lon")).alias("v")).first()["v"]
    assert v[0] == 4 and v[3:] == [0.5, 0.5] and math.hypot(v[1], v[2]) == pytest.approx(1)
    assert feature_stack(d, ["b", "a"]).first()["features"] == [0.3, 0.1]
    with pytest.raises(ValueError):
        feature_stack(d, ["zzz"])
    g = gray_world(d, ["sensor"], ["a", "b"]).first()
    assert g["a"] == pytest.approx(0.2) and g["b"] == pytest.approx(0.2)


def test_mask_labels(spark):
    mask = spark.createDataFrame([(34, 94, 42, 255), (34, 94, 42, 0), (1, 2, 3, 255)], "r int, g int, b int, a int")
    out = {(r["r"], r["a"]): r["label"] for r in mask_labels(mask, class_dim(spark)).collect()}
    assert out == {(34, 255): 0, (34, 0): None, (1, 255): None}


def test_change_map_sends_no_series_whole(spark, tmp_path, monkeypatch):
    """Of all joins only that with the tiles' months, a row a month, may be by broadcast, however small the stored series are."""
    months = [(f"t{i % 2}", i, 0, dt.date(2000 + m // 12, m % 12 + 1, 1), (i + m // 7) % 3) for i in range(6) for m in range(30)]
    write_product(spark.createDataFrame(months, SCHEMAS["monthly_class"]), str(tmp_path), "monthly_class")
    write_product(spark.createDataFrame([], SCHEMAS["segment"]), str(tmp_path), "segment")
    monkeypatch.setattr(stages, "write_product", lambda df, root, product: df)
    out = stages.change_map(spark, str(tmp_path), follow=2)
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= 1
    assert out.count() == sum((i + m // 7) % 3 != (i + (m + 12) // 7) % 3 for i in range(6) for m in range(18))
