"""Cells, neighbourhoods, tiles and mosaics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events, grid, quality, tiles
from .catalogue import query
from .standins import BOXES, CELLS, boxes, cells, table


@query("tile l, row l, col l, slope d, aspect d", f"""WITH {CELLS}, k AS (SELECT c.tile, c.row, c.col, c.z, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col - 1 THEN n.z END) AS a, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col THEN n.z END) AS b, max(CASE WHEN n.row = c.row - 1 AND n.col = c.col + 1 THEN n.z END) AS c3,
  max(CASE WHEN n.row = c.row AND n.col = c.col - 1 THEN n.z END) AS d, max(CASE WHEN n.row = c.row AND n.col = c.col + 1 THEN n.z END) AS f, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col - 1 THEN n.z END) AS g, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col THEN n.z END) AS h, max(CASE WHEN n.row = c.row + 1 AND n.col = c.col + 1 THEN n.z END) AS i
  FROM cells c LEFT JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 1 AND abs(n.col - c.col) <= 1 GROUP BY ALL),
  e AS (SELECT *, ((c3 + 2 * f + i) - (a + 2 * d + g)) / 800 AS dx, ((g + 2 * h + i) - (a + 2 * b + c3)) / 800 AS dy FROM k), x AS (SELECT *, degrees(atan2(-dx, dy)) AS t FROM e)
  SELECT tile, row, col, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope, CASE WHEN dx <> 0 OR dy <> 0 THEN t - 360 * floor(t / 360) END AS aspect FROM x""")
def slope_aspect(spark, sf):
    return grid.slope_aspect(cells(spark, sf), ["tile"], 100.0, z="z")


@query("tile l, row l, col l, local_mean d", f"WITH {CELLS} SELECT c.tile, c.row, c.col, avg(n.share) AS local_mean FROM cells c JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 2 AND abs(n.col - c.col) <= 2 GROUP BY ALL")
def local_mean(spark, sf):
    return grid.local_mean(cells(spark, sf), ["tile"], "row", "col", "share", 2)


COMPONENTS = CELLS + """, k AS (SELECT tile, row, col, row * 1000 + col AS id FROM cells WHERE truth = 1), e AS (SELECT a.tile, a.id, b.id AS nb FROM k a JOIN k b ON a.tile = b.tile AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1)"""


@query("tile l, row l, col l, first l, component_px l", f"WITH RECURSIVE {COMPONENTS}, r AS (SELECT tile, id, id AS root FROM k UNION SELECT r.tile, e.nb, r.root FROM r JOIN e ON r.tile = e.tile AND r.id = e.id), m AS (SELECT tile, id, min(root) AS root FROM r GROUP BY ALL) SELECT m.tile, id // 1000 AS row, id % 1000 AS col, root AS first, count(*) OVER (PARTITION BY m.tile, root) AS component_px FROM m")
def connected_components(spark, sf):
    c = grid.components(cells(spark, sf).where("truth = 1").select("tile", "row", "col"), ["tile"])
    first = c.groupBy("tile", "component").agg(F.min(F.col("row") * 1000 + F.col("col")).alias("first"))
    return c.join(first, ["tile", "component"])


@query("tile l, row l, col l, wide b", f"WITH {CELLS}, k AS (SELECT tile, row, col FROM cells WHERE truth >= 1), f AS (SELECT a.tile, a.row AS r0, a.col AS c0 FROM (SELECT tile, row - i AS row, col - j AS col FROM k, range(2) t(i), range(2) u(j)) a GROUP BY ALL HAVING count(*) = 4) SELECT k.*, EXISTS (SELECT 1 FROM f WHERE f.tile = k.tile AND k.row BETWEEN r0 AND r0 + 1 AND k.col BETWEEN c0 AND c0 + 1) AS wide FROM k")
def morphological_opening(spark, sf):
    return grid.opening(cells(spark, sf).where("truth >= 1").select("tile", "row", "col"), ["tile"], 2)


@query("tile l, row l, col l, shaded b", f"WITH {CELLS}, s AS (SELECT DISTINCT round(k * sin(radians(135)))::INT AS dx, round(-k * cos(radians(135)))::INT AS dy FROM range(1, 6) t(k)) SELECT c.tile, c.row, c.col, coalesce(bool_or(n.z - sqrt(dx * dx + dy * dy) * 30 * tan(radians(80)) > c.z), false) AS shaded FROM cells c CROSS JOIN s LEFT JOIN cells n ON n.tile = c.tile AND n.row = c.row + dy AND n.col = c.col + dx GROUP BY ALL")
def cast_shadow(spark, sf):
    return grid.cast_shadow(cells(spark, sf).withColumnRenamed("z", "elevation"), ["tile"], 30.0, 80.0, 135.0, 150.0)


@query("tile l, row l, col l, z d", f"WITH {CELLS}, a AS (SELECT tile, row, col, CASE WHEN truth > 0 THEN z END AS z FROM cells), b AS (SELECT tile, row, col, z + truth AS z FROM cells), s AS (SELECT a.tile, CASE WHEN count(a.z - b.z) >= 100 THEN median(a.z - b.z) ELSE 0 END AS m FROM a JOIN b USING (tile, row, col) GROUP BY ALL) SELECT a.tile, a.row, a.col, coalesce(a.z, b.z + m) AS z FROM a JOIN b USING (tile, row, col) JOIN s ON s.tile = a.tile")
def fill_gap_offset(spark, sf):
    c = cells(spark, sf)
    return grid.fill_gaps(c.select("tile", "row", "col", F.when(F.col("truth") > 0, F.col("z")).alias("z")), c.select("tile", "row", "col", (F.col("z") + F.col("truth")).alias("z")), ["tile"], "z")


@query("tile l, min d, max d, mean d, valid_pct d", f"WITH {CELLS} SELECT tile, min(v) AS min, max(v) AS max, avg(v) AS mean, 100.0 * count(v) / count(*) AS valid_pct FROM (SELECT tile, CASE WHEN truth < 2 THEN z END AS v FROM cells) GROUP BY tile")
def elevation_stats(spark, sf):
    return grid.elevation_stats(cells(spark, sf).withColumn("v", F.when(F.col("truth") < 2, F.col("z"))), ["tile"], "v")


@query("tile l, share d, n l", f"WITH {CELLS}, p AS (SELECT tile, share, (row * 40 + col) % 256 AS pl FROM cells), w AS (SELECT *, greatest(1e-3, 0.5 - 0.5 * cos(2 * pi() * (floor(pl / 16) + 0.5) / 16)) * greatest(1e-3, 0.5 - 0.5 * cos(2 * pi() * (pl % 16 + 0.5) / 16)) AS w FROM p) SELECT tile, sum(share * w) / sum(w) AS share, count(*) AS n FROM w GROUP BY tile")
def hann_overlap_mean(spark, sf):
    return grid.overlap_mean(cells(spark, sf).withColumn("pl", F.pmod(F.col("row") * 40 + F.col("col"), F.lit(256))), ["tile"], "pl", 16, "share")


@query("tile l, row l, col l, truth l", f"WITH {CELLS}, k AS (SELECT tile, row // 4 AS row, col // 4 AS col, CASE WHEN truth < 2 THEN truth END AS truth, count(*) AS n FROM cells GROUP BY ALL) SELECT tile, row, col, truth FROM k QUALIFY row_number() OVER (PARTITION BY tile, row, col ORDER BY n DESC, truth IS NULL, truth) = 1")
def majority_downsample(spark, sf):
    return quality.majority_blocks(cells(spark, sf).withColumn("truth", F.when(F.col("truth") < 2, F.col("truth"))), ["tile"], "row", "col", "truth", 4)


@query("tile l, row l, col l, on_boundary b", f"WITH {CELLS} SELECT c.tile, c.row, c.col, bool_or(n.truth <> c.truth) AS on_boundary FROM cells c JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 1 AND abs(n.col - c.col) <= 1 GROUP BY ALL")
def boundary_band(spark, sf):
    return quality.boundary(cells(spark, sf), ["tile"], "row", "col", "truth", 1)


@query("truth l, pred l, n l", f"WITH {CELLS}, k AS (SELECT c.tile, c.row, c.col, c.truth, c.pred, bool_or(n.truth = c.pred) AS ok FROM cells c JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 1 AND abs(n.col - c.col) <= 1 GROUP BY ALL) SELECT truth, CASE WHEN ok THEN truth ELSE pred END AS pred, count(*) AS n FROM k GROUP BY 1, 2")
def dilated_confusion(spark, sf):
    return quality.tolerant_hits(cells(spark, sf), ["tile"], "row", "col", "truth", "pred", 1)


@query("class l, support l, predicted l, f1 d", f"WITH {CELLS}, b AS (SELECT c.tile, c.row, c.col, c.truth, c.pred FROM cells c JOIN cells n ON n.tile = c.tile AND abs(n.row - c.row) <= 1 AND abs(n.col - c.col) <= 1 GROUP BY ALL HAVING bool_or(n.truth <> c.truth)), k AS (SELECT unnest([0, 1, 2]) AS class), s AS (SELECT class, count(*) FILTER (truth = class) AS support, count(*) FILTER (pred = class) AS predicted, count(*) FILTER (truth = class AND pred = class) AS tp FROM k, b GROUP BY class) SELECT class, support, predicted, 2 * tp / (support + predicted) AS f1 FROM s WHERE support + predicted > 0")
def boundary_f1(spark, sf):
    b = quality.boundary(cells(spark, sf), ["tile"], "row", "col", "truth", 1).where("on_boundary")
    return quality.class_metrics(quality.confusion(b, "truth", "pred"))


GRID = BOXES + """, o AS (SELECT *, floor(minx / 8000.0) * 8000.0 AS x0, floor(miny / 8000.0) * 8000.0 AS y0 FROM boxes), n AS (SELECT *, greatest(1, ceil((maxx - x0 - 0.01) / 8000))::INT AS nx, greatest(1, ceil((maxy - y0 - 0.01) / 8000))::INT AS ny FROM o),
ce AS (SELECT n.*, c AS col, r AS row, x0 + c * 8000.0 AS a, y0 + r * 8000.0 AS b FROM n, unnest(range(nx)) t(c), unnest(range(ny)) u(r)), ov AS (SELECT *, least(a + 8000, maxx) - greatest(a, minx) AS w, least(b + 8000, maxy) - greatest(b, miny) AS h FROM ce),
gr AS (SELECT 'tile_' || aoi_id || '_' || lpad(row::VARCHAR, 4, '0') || '_' || lpad(col::VARCHAR, 4, '0') AS tile_id, aoi_id, row, col, a AS search_minx, b AS search_miny, a + 8000 AS search_maxx, b + 8000 AS search_maxy, a - 250 AS window_minx, b + 8250 AS window_maxy, 64.0 AS area_km2, 100 * w * h / 64e6 AS aoi_cover_pct FROM ov WHERE w > 0.01 AND h > 0.01 AND 100 * w * h / 64e6 >= 5)"""


def _registry(spark, sf):
    return tiles.tile_grid(boxes(spark, sf), least_cover=5.0)


@query("tile_id s, row l, col l, search_minx d, search_maxy d, window_minx d, window_maxy d, area_km2 d, aoi_cover_pct d, aoi_id s", f"WITH {GRID} SELECT * FROM gr")
def tile_grid(spark, sf):
    return _registry(spark, sf)


@query("aoi_id s, minx d, miny d, maxx d, maxy d", f"WITH {BOXES}, o AS (SELECT *, floor(minx / 10) * 10 AS x, floor(miny / 10) * 10 AS y FROM boxes), s AS (SELECT *, greatest(500, ceil(greatest(maxx - x, maxy - y) / 10) * 10) AS side FROM o) SELECT aoi_id, x AS minx, y AS miny, x + side AS maxx, y + side AS maxy FROM s")
def single_tile_bounds(spark, sf):
    b = boxes(spark, sf)
    return b.select("aoi_id", *[v.alias(k) for k, v in tiles.single_tile(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")]).items()])


@query("aoi_id s, n_tiles l, area_km2 d, mean_cover_pct d", f"WITH {GRID} SELECT aoi_id, count(*) AS n_tiles, sum(area_km2) AS area_km2, avg(aoi_cover_pct) AS mean_cover_pct FROM gr GROUP BY aoi_id")
def registry_summary(spark, sf):
    return tiles.registry_summary(_registry(spark, sf))


@query("aoi_id s, n_tiles l", f"WITH {GRID} SELECT aoi_id, count(*) AS n_tiles FROM gr GROUP BY aoi_id HAVING count(*) > 1")
def mosaic_groups(spark, sf):
    return tiles.mosaic_groups(_registry(spark, sf))


@query("aoi_id s, x0 d, y0 d, n_cols l, n_rows l", f"WITH {GRID} SELECT aoi_id, min(search_minx) AS x0, max(search_maxy) AS y0, ceil((max(search_maxx) - min(search_minx)) / 30.0) AS n_cols, ceil((max(search_maxy) - min(search_miny)) / 30.0) AS n_rows FROM gr GROUP BY aoi_id")
def mosaic_grid(spark, sf):
    return tiles.mosaic_grid(_registry(spark, sf).withColumn("res", F.lit(30.0)), "aoi_id", "res")


@query("x l, y l, truth l", f"WITH {CELLS}, p AS (SELECT 't' || tile AS tile_id, col - tile AS x, row AS y, truth FROM cells), rg AS (SELECT unnest(['t0', 't1', 't2']) AS tile_id, unnest([0, 10, 20]) AS x0, unnest([15, 25, 40]) AS x1) SELECT x, y, max_by(truth, p.tile_id) AS truth FROM p JOIN rg USING (tile_id) WHERE x >= x0 AND x < x1 GROUP BY x, y")
def period_mosaic(spark, sf):
    c = cells(spark, sf).select(F.concat(F.lit("t"), "tile").alias("tile_id"), (F.col("col") - F.col("tile")).alias("x"), F.col("row").alias("y"), "truth")
    reg = spark.createDataFrame([("t0", 0.0, 0.0, 15.0, 1e6), ("t1", 10.0, 0.0, 25.0, 1e6), ("t2", 20.0, 0.0, 40.0, 1e6)], "tile_id string, search_minx double, search_miny double, search_maxx double, search_maxy double")
    return tiles.mosaic(c, reg, [], "truth")


@query(
    "tile_id s, split_index l, split_name s",
    """WITH RECURSIVE o AS (SELECT s_name AS tile_id, abs(s_acctbal) AS a, row_number() OVER (ORDER BY abs(s_acctbal) DESC, s_name) AS k, avg(abs(s_acctbal)) OVER () AS m FROM supplier),
    r AS (SELECT 0::BIGINT AS k, NULL::VARCHAR AS tile_id, 0::BIGINT AS i, [0, 0, 0, 0]::DOUBLE[] AS loads
      UNION ALL SELECT o.k, o.tile_id, list_position(loads, list_min(loads)) - 1, [CASE WHEN j = list_position(loads, list_min(loads)) THEN loads[j] + 1 + a / m ELSE loads[j] END for j in [1, 2, 3, 4]] FROM r JOIN o ON o.k = r.k + 1)
    SELECT tile_id, i AS split_index, 'split_' || i AS split_name FROM r WHERE k > 0""",
)
def lpt_assignment(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("tile_id"), F.abs("s_acctbal").alias("area_km2"))
    return tiles.assign_lpt(s, 4)


@query("p_brand s, n_tiles l, area d, share_tiles d, share_area d", "SELECT p_brand, count(*) AS n_tiles, sum(p_retailprice) AS area, count(*) / sum(count(*)) OVER () AS share_tiles, sum(p_retailprice) / sum(sum(p_retailprice)) OVER () AS share_area FROM part GROUP BY p_brand")
def split_balance(spark, sf):
    return tiles.balance(table(spark, sf, "part"), "p_brand", "p_retailprice")


@query("tile_id l", "SELECT p_partkey AS tile_id FROM part WHERE p_size % 3 = 1")
def tiles_of_split(spark, sf):
    p = table(spark, sf, "part").withColumnRenamed("p_partkey", "tile_id")
    return tiles.tiles_of_split(p.select("tile_id"), p.select("tile_id", F.pmod("p_size", F.lit(3)).alias("split_index")), 1)


TARGET = "tg AS (SELECT tile, row, col, col * 7.0 + 3.0 AS x, -row * 7.0 - 3.0 AS y FROM cells)"


def _target(spark, sf):
    return cells(spark, sf).select("tile", "row", "col", (F.col("col") * 7.0 + 3.0).alias("x"), (-F.col("row") * 7.0 - 3.0).alias("y"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("res"))


@query("tile l, row l, col l, truth l", f"WITH {CELLS}, {TARGET} SELECT tg.tile, tg.row, tg.col, c.truth FROM tg LEFT JOIN cells c ON c.tile = tg.tile AND c.row = floor(-y / 10) AND c.col = floor(x / 10)")
def resample_nearest(spark, sf):
    return tiles.resample_nearest(cells(spark, sf), _target(spark, sf), ["tile"], "truth")


@query("tile l, row l, col l, z d", f"WITH {CELLS}, {TARGET}, f AS (SELECT *, x / 10 - 0.5 AS fx, -y / 10 - 0.5 AS fy FROM tg), k AS (SELECT f.*, floor(fx) + j AS cc, floor(fy) + i AS rr, (1 - abs(fy - floor(fy) - i)) * (1 - abs(fx - floor(fx) - j)) AS w FROM f, range(2) t(i), range(2) u(j)) SELECT k.tile, k.row, k.col, sum(w * c.z) / sum(CASE WHEN c.z IS NOT NULL THEN w END) AS z FROM k LEFT JOIN cells c ON c.tile = k.tile AND c.row = rr AND c.col = cc GROUP BY k.tile, k.row, k.col")
def resample_bilinear(spark, sf):
    return tiles.resample_bilinear(cells(spark, sf), _target(spark, sf), ["tile"], "z")


def _patches(name: str, of: str, near: int = 1) -> str:
    """Connected cells of a table (grp, row, col, id), as tables <name>_r (every cell with every cell that it reaches) and <name> (cell with its patch)."""
    return f"""{name}_e AS (SELECT a.grp, a.id, b.id AS nb FROM {of} a JOIN {of} b ON a.grp = b.grp AND abs(a.row - b.row) <= {near} AND abs(a.col - b.col) <= {near}),
    {name}_r AS (SELECT grp, id, id AS root FROM {of} UNION SELECT r.grp, e.nb, r.root FROM {name}_r r JOIN {name}_e e ON r.grp = e.grp AND r.id = e.id),
    {name} AS (SELECT {of}.*, root, count(*) OVER (PARTITION BY grp, root) AS px FROM {of} JOIN (SELECT grp, id, min(root) AS root FROM {name}_r GROUP BY ALL) USING (grp, id))"""


def _opened(name: str, of: str, k: int) -> str:
    """Cells of a table (grp, row, col) that a square of k x k cells inside it covers."""
    return f"""{name}_f AS (SELECT grp, r0, c0 FROM (SELECT DISTINCT grp, row - i AS r0, col - j AS c0, i, j FROM {of}, range({k}) t(i), range({k}) u(j)) GROUP BY ALL HAVING count(*) = {k * k}),
    {name} AS (SELECT {of}.* FROM {of} WHERE EXISTS (SELECT 1 FROM {name}_f f WHERE f.grp = {of}.grp AND {of}.row BETWEEN r0 AND r0 + {k - 1} AND {of}.col BETWEEN c0 AND c0 + {k - 1}))"""


@query(
    "tile l, row l, col l, event_type s, object_px l",
    f"""WITH RECURSIVE {CELLS}, ev AS (SELECT tile * 100 + truth AS grp, tile, row, col, row * 1000 + col AS id, CASE pred WHEN 0 THEN 'gain' WHEN 1 THEN 'cutblock' ELSE 'other_loss' END AS event_type, share AS burned, share / 2 AS dnbr FROM cells),
    part AS (SELECT * FROM ev WHERE event_type <> 'gain'), {_patches("ob", "part")},
    fi AS (SELECT *, px >= 20 AND (avg(burned) OVER w >= 0.10 OR (avg(dnbr) OVER w >= 0.45 AND avg(burned) OVER w >= 0.05)) AS fire FROM ob WINDOW w AS (PARTITION BY grp, root)),
    lm AS (SELECT a.grp, a.id, avg(b.burned) AS near FROM part a JOIN part b ON a.grp = b.grp AND abs(a.row - b.row) <= 5 AND abs(a.col - b.col) <= 5 GROUP BY ALL),
    af AS (SELECT fi.*, fire AND near >= 0.03 AS as_fire FROM fi JOIN lm USING (grp, id)),
    rest AS (SELECT grp, row, col, id FROM af WHERE NOT as_fire), {_opened("wide", "rest", 2)}, thin AS (SELECT * FROM rest ANTI JOIN wide USING (grp, id)),
    rch AS (SELECT DISTINCT grp, row + i AS row, col + j AS col, (row + i + 10) * 1000 + col + j + 10 AS id FROM thin, range(-1, 2) t(i), range(-1, 2) u(j)), {_patches("st", "rch")},
    lo AS (SELECT grp, root FROM st GROUP BY ALL HAVING greatest(max(row) - min(row), max(col) - min(col)) + 1 - 2 >= 4),
    li AS (SELECT thin.grp, thin.id FROM thin JOIN st ON st.grp = thin.grp AND st.row = thin.row AND st.col = thin.col SEMI JOIN lo ON lo.grp = st.grp AND lo.root = st.root)
    SELECT ev.tile, ev.row, ev.col, CASE WHEN coalesce(as_fire, false) THEN 'fire' WHEN li.id IS NOT NULL THEN 'linear_feature' ELSE ev.event_type END AS event_type, coalesce(af.px, 0) AS object_px FROM ev LEFT JOIN af USING (grp, id) LEFT JOIN li ON li.grp = ev.grp AND li.id = ev.id""",
)
def object_refinement(spark, sf):
    e = cells(spark, sf).select("tile", "row", "col", F.make_date(F.lit(2000) + F.col("truth"), F.lit(7), F.lit(1)).alias("break_date"), F.when(F.col("pred") == 0, "gain").when(F.col("pred") == 1, "cutblock").otherwise("other_loss").alias("event_type"), F.col("share").alias("burned_fraction"), (F.col("share") / 2).alias("dnbr"))
    return events.refine_objects(e, ["tile"], "row", "col", r=events.Rules(object_px=20, line_extent=4, line_width=2, line_gap=1))


@query("tile l, row l, col l, z d, share d", f"WITH {CELLS} SELECT a.tile, a.row, a.col, b.z, b.share FROM cells a LEFT JOIN (SELECT * FROM cells WHERE truth = 2) b USING (tile, row, col)")
def scatter_to_grid(spark, sf):
    from ..functions.features import scatter

    c = cells(spark, sf)
    return scatter(c, c.where("truth = 2").select("tile", "row", "col", "z", "share"), ["tile", "row", "col"])


@query("tile l, row l, col l, x d, y d", f"WITH {CELLS} SELECT tile, row, col, 500 + (col + 0.5) * 10 AS x, 900 - (row + 0.5) * 10 AS y FROM cells")
def cell_centres(spark, sf):
    from ..functions.features import cell_centre

    x, y = cell_centre(F.col("row"), F.col("col"), F.lit(500.0), F.lit(900.0), F.lit(10.0))
    return cells(spark, sf).select("tile", "row", "col", x.alias("x"), y.alias("y"))


@query("tile l, row l, col l, elevation d, slope d", f"WITH {CELLS} SELECT e.tile, e.row, e.col, t.z AS elevation, t.share AS slope FROM (SELECT * FROM cells WHERE pred = 1) e LEFT JOIN (SELECT * FROM cells WHERE truth <> 1) t USING (tile, row, col)")
def event_terrain(spark, sf):
    c = cells(spark, sf)
    terrain = c.where("truth <> 1").select("tile", "row", "col", F.col("z").alias("elevation"), F.col("share").alias("slope"))
    return c.where("pred = 1").select("tile", "row", "col").join(terrain, ["tile", "row", "col"], "left")


@query("tile l, row l, col l", f"WITH RECURSIVE {CELLS}, fit AS (SELECT tile AS grp, row, col, row * 1000 + col AS id FROM cells WHERE truth >= 1), {_opened('wide', 'fit', 2)}, {_patches('pa', 'wide')} SELECT grp AS tile, row, col FROM pa WHERE px >= 3")
def cropland_patches(spark, sf):
    """Cells whose stand-in series is open throughout, in wide patches."""
    import datetime

    from ..keys import Series

    c = cells(spark, sf)
    months = [datetime.date(y, m, 1) for y in range(2000, 2009) for m in (6, 7, 8)]
    obs = c.withColumn("month", F.explode(F.array(*[F.lit(d) for d in months]))).withColumn("cls", F.when(F.col("truth") >= 1, 1).otherwise(0))
    s = Series(keys=("tile", "row", "col"), time="month", label="cls")
    return events.cropland(obs, s, ["tile"], "row", "col", 1, 9, r=events.Rules(crop_width=2, crop_patch=3))
