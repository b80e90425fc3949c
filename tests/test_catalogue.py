"""Every query against its SQL, or against what is known of its result where SQL can't say it."""

import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import both, connect
from tidemark.plans import catalogue, model_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, con, name):
    got, want = both(con, catalogue.QUERIES[name](spark, SF), catalogue.ORACLES[name])
    assert got == want


def test_only_these_have_no_sql():
    """Detection, forests, determinants and greedy moves are beyond SQL; test_kernels and the tests below hold them against plain versions."""
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"break_segments", "jm_separability", "balanced_cross_validation_folds", "split_coverage_repair", "random_forest_confusion"}


def test_break_segments_cover_their_series(spark):
    """Segments of a series follow one another, breaks lie between them, and a series without break is one segment."""
    rows = {}
    for r in catalogue.QUERIES["break_segments"](spark, SF).collect():
        rows.setdefault(r["px"], []).append(r)
    assert rows
    for own in rows.values():
        own.sort(key=lambda r: r["seg_index"])
        assert [r["seg_index"] for r in own] == list(range(len(own)))
        assert own[-1]["t_break"] is None and all(r["t_break"] is not None for r in own[:-1])
        for a, b in zip(own, own[1:]):
            assert a["t_start"] <= a["t_end"] < a["t_break"] <= b["t_start"]


def test_separability_against_numpy(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(e["embedding"]).astype(float)
    fits = {c: (x[e["label"] == c].mean(axis=0), np.cov(x[e["label"] == c], rowvar=False) + 1e-6 * np.eye(64)) for c in sorted(set(e["label"]))}
    want = {}
    for a in fits:
        for b in fits:
            if a < b:
                (ma, sa), (mb, sb) = fits[a], fits[b]
                mid = (sa + sb) / 2
                far = (ma - mb) @ np.linalg.inv(mid) @ (ma - mb) / 8 + 0.5 * (np.linalg.slogdet(mid)[1] - 0.5 * (np.linalg.slogdet(sa)[1] + np.linalg.slogdet(sb)[1]))
                want[a, b] = 2 * (1 - np.exp(-far))
    got = {(r["class_a"], r["class_b"]): r["jm"] for r in catalogue.QUERIES["jm_separability"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_folds_and_repaired_splits_hold_every_group_once(spark):
    folds = catalogue.QUERIES["balanced_cross_validation_folds"](spark, SF).collect()
    keys = {r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().collect()}
    assert {r["key"] for r in folds} == keys and len(folds) == len(keys)
    sizes = Counter(r["fold"] for r in folds)
    assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 0.2 * len(keys)
    moved = {r["blk"]: r["split"] for r in catalogue.QUERIES["split_coverage_repair"](spark, SF).collect()}
    assert set(moved.values()) <= {"train", "val", "test"} and len(moved) == len({r["blk"] for r in model_queries._parts(spark, SF)[1].collect()})


def test_forest_tells_what_a_tree_can(spark):
    """Rows of two classes apart in one feature: all are told; the query's table counts every labelled row once."""
    from tidemark.operators import models

    rows = [([float(i % 2) + 0.001 * (i % 7), float(i % 5)], i % 2) for i in range(400)]
    _, out = models.random_forest(spark.createDataFrame(rows, "f array<double>, y int"), "f", "y", trees=4, depth=3)
    assert out.where("prediction <> y").count() == 0
    table = catalogue.QUERIES["random_forest_confusion"](spark, SF).collect()
    labels = Counter(r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("label").collect())
    assert {t: sum(r["n"] for r in table if r["truth"] == t) for t in labels} == dict(labels)
    assert sum(r["n"] for r in table if r["truth"] == r["pred"]) > 2 * max(labels.values())


def test_models_by_kind(spark):
    from tidemark.operators import models

    rows = [([float(i % 3), 0.1 * (i % 4), 0.0], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "f array<double>, y int")
    for kind, options in (("centroids", {"places": [0, 1]}), ("random_forest", {"trees": 4, "depth": 3}), ("boosted", {"rounds": 2, "depth": 2}), ("precomputed", {})):
        model = models.Fitted(kind, "f", "y", **options)
        with pytest.raises(ValueError, match="fitted"):
            model.predict(df)
        out = model.fit(df).predict(df)
        assert out.count() == 300 and (kind == "precomputed" or out.where("prediction <> y").count() == 0), kind
    two = models.Fitted("threshold", "f", "y", classes=[0, 2], n_features=2, grid=[0.25, 0.75]).fit(df.where("y <> 1")).predict(df.where("y <> 1"))
    assert two.where("prediction <> y").count() == 0
    with pytest.raises(ValueError, match="unknown kind"):
        models.Fitted("network", "f", "y")


def test_search_is_the_best_of_its_plans(spark):
    """Of random rule lists, the one found has the greatest macro IoU, worked out row by row."""
    from tidemark.operators import models

    e = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("y", F.pmod("label", F.lit(3)))
    rules, best = models.search_thresholds(e, "embedding", "y", [0, 1, 2], 64, trials=12, seed=3)
    rows = [(np.asarray(r["embedding"], float), r["y"]) for r in e.collect()]

    def miou(plan):
        hits = Counter()
        for x, y in rows:
            hits[y, next((c for i, way, bound, c in plan if (x[i] < bound if way == "<" else x[i] >= bound)), 0)] += 1
        return np.mean([hits[c, c] / sum(n for k, n in hits.items() if c in k) for c in range(3) if any(c in k for k in hits)])

    assert best == pytest.approx(miou(rules))
    others = [models.search_thresholds(e, "embedding", "y", [0, 1, 2], 64, trials=n, seed=3)[1] for n in (1, 4, 8)]
    assert others == sorted(others) and others[-1] <= best


def test_pilot_and_split_arguments(spark):
    from tidemark.operators import tiles

    box = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0)], "aoi_id string, minx double, miny double, maxx double, maxy double")
    with pytest.raises(ValueError, match="meets no area"):
        tiles.clip_boxes(box, 2.0, 2.0, 3.0, 3.0)
    assert tiles.clip_boxes(box, 2.0, 2.0, 3.0, 3.0, required=False).count() == 0
    assert tiles.resolve_splits("all", 3) == [0, 1, 2] and tiles.resolve_splits("2", 3) == [2]
    for bad in ("3", "-1", "x"):
        with pytest.raises(ValueError):
            tiles.resolve_splits(bad, 3)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_no_cross_products(spark):
    for name in ("annual_change", "persistent_change", "interval_break_match", "corroborated_change", "post_break_trajectory"):
        plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scan_reads_only_needed_columns(spark):
    plan = catalogue.QUERIES["monthly_vote_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_extendedprice" not in schema and "l_returnflag" in schema


def test_resampling_takes_every_row(spark):
    """Of a grid of more than ten rows a tile, every cell is a target."""
    sf = "/root/testdata/sf0.01"
    for name in ("resample_nearest", "resample_bilinear"):
        got, want = both(connect(sf), catalogue.QUERIES[name](spark, sf), catalogue.ORACLES[name])
        assert got == want and len(got) == spark.read.parquet(f"{sf}/part.parquet").count(), name


def test_correlation_has_all_pairs(spark, con):
    got, want = both(con, catalogue.QUERIES["feature_correlation"](spark, SF), catalogue.ORACLES["feature_correlation"])
    assert got == want and max(r[1] for r in got) == 63


def test_bootstrap_counts_end_where_the_sql_ends(spark, tmp_path):
    """Keys that a round draws eight times or more: the query counts them as its SQL does, the operator in full."""
    import hashlib
    import shutil

    from tidemark.operators import split

    u = lambda r, k: int(hashlib.md5(f"1|{r}|{k}".encode()).hexdigest()[:8], 16) / 2**32
    often = [k for k in range(60_000) if max(u(r, k) for r in range(4)) >= 0.99999]
    assert often
    shutil.copytree(SF, tmp_path, dirs_exist_ok=True)
    os.remove(tmp_path / "supplier.parquet")
    own = spark.createDataFrame([(k,) for k in [*often, 1, 2, 3]], "s_suppkey long")
    own.write.parquet(str(tmp_path / "supplier.parquet"))
    got, want = both(connect(str(tmp_path)), catalogue.QUERIES["bootstrap_samples"](spark, str(tmp_path)), catalogue.ORACLES["bootstrap_samples"])
    assert got == want
    below = lambda x: next(k for k in range(20) if x < sum(np.exp(-1) / math.factorial(i) for i in range(k + 1)))
    full = {(r["round"], r["s_suppkey"]): r["times"] for r in split.bootstrap(own, ["s_suppkey"], 4, 1).collect()}
    assert max(full.values()) >= 8 and full == {(r, k): below(u(r, k)) for r in range(4) for k in [*often, 1, 2, 3] if below(u(r, k))}


def test_pixel_arrays_of_numbers_beyond_a_short(spark, tmp_path):
    """Days are held whole whatever their size; what is no number is 0."""
    import shutil

    from tidemark.sources import products

    shutil.copytree(SF, tmp_path, dirs_exist_ok=True)
    os.remove(tmp_path / "lineitem.parquet")
    l = spark.read.parquet(f"{SF}/lineitem.parquet")
    l.withColumn("l_suppkey", F.col("l_suppkey") * 3_000_000_001 + 32_770).write.parquet(str(tmp_path / "lineitem.parquet"))
    got, want = both(connect(str(tmp_path)), catalogue.QUERIES["pixel_arrays"](spark, str(tmp_path)), catalogue.ORACLES["pixel_arrays"])
    assert got == want and max(r[3] for r in got) > 2**31
    odd = spark.createDataFrame([(1, 2.5), (2, 3.5), (3, float("nan")), (4, float("inf")), (5, None), (6, -1.2)], "id int, x double")
    assert {r[0]: r[1] for r in odd.select("id", products.rounded_doy(F.col("x"))).collect()} == {1: 2, 2: 4, 3: 0, 4: 0, 5: 0, 6: -1}


def test_boundary_f1_sends_no_cells_whole(spark):
    """Places near cells are nine times the cells, however few the planner takes them for."""
    plan = catalogue.QUERIES["boundary_f1"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
