"""Tile grids, registries, mosaics and balanced assignment."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_CELLS = 5_000_000
#: A cell counts as overlapping when it does so by more than this, in metres.
SLACK = 0.01


def tile_grid(boxes: DataFrame, size: float = 8000.0, buffer: float = 250.0, anchor: str = "global", least_cover: float = 0.0, prefix: str = "tile") -> DataFrame:
    """boxes(aoi_id, minx, miny, maxx, maxy) cut into cells: a registry row for each cell that overlaps its box.

    anchor global: cell borders lie at multiples of the size; bbox: they start in the box's lower left corner. The window
    is the cell grown by the buffer. aoi_cover_pct is the share of the cell in the box. Boxes with more than
    MOST_CELLS cells are an error. Cells come from sequences, so a box is cut where its row is.
    """
    x0 = F.when(F.lit(anchor == "global"), F.floor(F.col("minx") / size) * size).otherwise(F.col("minx"))
    y0 = F.when(F.lit(anchor == "global"), F.floor(F.col("miny") / size) * size).otherwise(F.col("miny"))
    nx, ny = (F.greatest(F.lit(1), F.ceil((F.col(hi) - lo - SLACK) / size)).cast("int") for hi, lo in (("maxx", x0), ("maxy", y0)))
    own = boxes.withColumns({"_x": x0.cast("double"), "_y": y0.cast("double"), "_nx": nx, "_ny": ny})
    fits = F.col("_nx").cast("long") * F.col("_ny") <= MOST_CELLS
    own = own.withColumn("_nx", F.when(fits, F.col("_nx")).otherwise(F.raise_error(F.lit("a box has too many cells")).cast("int")))
    cells = own.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1))).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
    a, b = F.col("_x") + F.col("col") * size, F.col("_y") + F.col("row") * size
    cells = cells.withColumns({"search_minx": a, "search_miny": b, "search_maxx": a + size, "search_maxy": b + size})
    wide = F.least("search_maxx", "maxx") - F.greatest("search_minx", "minx")
    high = F.least("search_maxy", "maxy") - F.greatest("search_miny", "miny")
    cells = cells.where((wide > SLACK) & (high > SLACK)).withColumn("aoi_cover_pct", 100.0 * wide * high / (size * size)).where(F.col("aoi_cover_pct") >= least_cover)
    grow = {f"window_{c}": F.col(f"search_{c}") + (buffer if c.startswith("max") else -buffer) for c in ("minx", "miny", "maxx", "maxy")}
    name = F.concat_ws("_", F.lit(prefix), F.col("aoi_id").cast("string"), F.lpad(F.col("row").cast("string"), 4, "0"), F.lpad(F.col("col").cast("string"), 4, "0"))
    return cells.withColumns(grow).select(name.alias("tile_id"), "row", "col", *[f"{w}_{c}" for w in ("search", "window") for c in ("minx", "miny", "maxx", "maxy")], F.lit(size).alias("tile_size_m"), F.lit(buffer).alias("buffer_m"), F.lit(size * size / 1e6).alias("area_km2"), "aoi_cover_pct", "aoi_id")


def single_tile(minx: Column, miny: Column, maxx: Column, maxy: Column, least: float = 500.0, pixel: float = 10.0) -> dict[str, Column]:
    """A square of whole pixels that holds the box: side rounded up to pixels, origin on the pixel grid; the side grows by the
    distance that the snapping took."""
    x, y = F.floor(minx / pixel) * pixel, F.floor(miny / pixel) * pixel
    side = F.greatest(F.lit(least), F.ceil(F.greatest(maxx - x, maxy - y) / pixel) * pixel)
    return {"minx": x, "miny": y, "maxx": x + side, "maxy": y + side}


def registry_union(registries: list[DataFrame]) -> DataFrame:
    """All registries; a tile id that occurs twice is an error when it's read."""
    out = registries[0]
    for r in registries[1:]:
        out = out.unionByName(r)
    from pyspark.sql import Window as W

    n = F.count(F.lit(1)).over(W.partitionBy("tile_id"))
    return out.withColumn("_n", n).withColumn("tile_id", F.when(F.col("_n") == 1, F.col("tile_id")).otherwise(F.raise_error(F.concat(F.lit("repeated tile id "), F.col("tile_id"))))).drop("_n")


def registry_summary(registry: DataFrame, by: str = "aoi_id") -> DataFrame:
    return registry.groupBy(by).agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("area_km2").alias("area_km2"), F.avg("aoi_cover_pct").alias("mean_cover_pct"))


def mosaic_groups(registry: DataFrame, by: str = "aoi_id") -> DataFrame:
    """Groups to be made a mosaic: the only one there is, or of several those with more than one tile."""
    from pyspark.sql import Window as W

    counts = registry.groupBy(by).agg(F.count(F.lit(1)).alias("n_tiles"))
    return counts.withColumn("_all", F.count(F.lit(1)).over(W.partitionBy())).where((F.col("_all") == 1) | (F.col("n_tiles") > 1)).drop("_all")


def mosaic_grid(registry: DataFrame, by: str, resolution: str) -> DataFrame:
    """by, x0, y0, resolution, n_cols, n_rows of the finest grid over each group's search boxes."""
    g = registry.groupBy(by).agg(F.min("search_minx").alias("x0"), F.max("search_maxy").alias("y0"), F.max("search_maxx").alias("_x1"), F.min("search_miny").alias("_y1"), F.min(resolution).alias("resolution"))
    return g.select(by, "x0", "y0", "resolution", F.ceil((F.col("_x1") - F.col("x0")) / F.col("resolution")).cast("int").alias("n_cols"), F.ceil((F.col("y0") - F.col("_y1")) / F.col("resolution")).cast("int").alias("n_rows"))


def mosaic(cells: DataFrame, registry: DataFrame, by: list[str], value: str, x: str = "x", y: str = "y") -> DataFrame:
    """by, x, y, value: cells inside their tile's unbuffered box; where tiles meet, the later tile id wins. The registry side has a row
    for each tile and is left to the planner to send."""
    own = cells.join(registry.select("tile_id", "search_minx", "search_miny", "search_maxx", "search_maxy"), "tile_id")
    inside = (F.col(x) >= F.col("search_minx")) & (F.col(x) < F.col("search_maxx")) & (F.col(y) >= F.col("search_miny")) & (F.col(y) < F.col("search_maxy"))
    return own.where(inside & F.col(value).isNotNull()).groupBy(*by, x, y).agg(F.max_by(value, "tile_id").alias(value))


def assign_lpt(tiles: DataFrame, n: int, area: str = "area_km2", names: list[str] | None = None) -> DataFrame:
    """tile_id, split_index, split_name: tiles by falling area to the split with the least load, which is its number of tiles plus its
    area over the mean area. Greedy and so sequential: the registry has a row for each tile and goes through the driver."""
    rows = sorted(((float(r[1] or 0.0), r[0]) for r in tiles.select("tile_id", area).collect()), key=lambda r: (-r[0], r[1]))
    mean = sum(r[0] for r in rows) / len(rows) if rows else 1.0
    names = names or [f"split_{i}" for i in range(n)]
    heap, out = [(0.0, i) for i in range(n)], []
    for size, tile in rows:
        load, i = heapq.heappop(heap)
        out.append((tile, i, names[i]))
        heapq.heappush(heap, (load + 1 + size / mean if mean else load + 1, i))
    return tiles.sparkSession.createDataFrame(out, "tile_id string, split_index int, split_name string")


def balance(loads: DataFrame, by: str, area: str) -> DataFrame:
    """by, n_tiles, area, share_tiles, share_area."""
    from pyspark.sql import Window as W

    g = loads.groupBy(by).agg(F.count(F.lit(1)).alias("n_tiles"), F.sum(area).alias("area"))
    whole = W.partitionBy()
    return g.withColumn("share_tiles", F.col("n_tiles") / F.sum("n_tiles").over(whole)).withColumn("share_area", F.col("area") / F.sum("area").over(whole))


def tiles_of_split(registry: DataFrame, assignment: DataFrame, split: int) -> DataFrame:
    return registry.join(assignment.where(F.col("split_index") == split).select("tile_id"), "tile_id", "left_semi")


def resample_nearest(cells: DataFrame, grid: DataFrame, by: list[str], value: str) -> DataFrame:
    """grid(by, row, col, x, y) with the value of the source cell that holds the point. cells carry x0, y0 (upper left corner) and res of
    their grid; the target's header columns x0, y0, res of the source are in grid, so the join is on cell numbers."""
    at = grid.withColumn("_c", F.floor((F.col("x") - F.col("x0")) / F.col("res")).cast("int")).withColumn("_r", F.floor((F.col("y0") - F.col("y")) / F.col("res")).cast("int"))
    src = cells.select(*by, F.col("row").alias("_r"), F.col("col").alias("_c"), value)
    return at.join(src, [*by, "_r", "_c"], "left").select(*by, "row", "col", value)


def resample_bilinear(cells: DataFrame, grid: DataFrame, by: list[str], value: str) -> DataFrame:
    """grid with the value between the four cell centres around each point; weights of missing cells are left out."""
    fx, fy = (F.col("x") - F.col("x0")) / F.col("res") - 0.5, (F.col("y0") - F.col("y")) / F.col("res") - 0.5
    at = grid.withColumn("_fx", fx).withColumn("_fy", fy).withColumn("_c0", F.floor("_fx").cast("int")).withColumn("_r0", F.floor("_fy").cast("int"))
    corners = F.array(*[F.struct((F.col("_r0") + i).alias("_r"), (F.col("_c0") + j).alias("_c"), ((1 - F.abs(F.col("_fy") - F.col("_r0") - i)) * (1 - F.abs(F.col("_fx") - F.col("_c0") - j))).alias("_w")) for i in (0, 1) for j in (0, 1)])
    src = cells.where(F.col(value).isNotNull()).select(*by, F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v"))
    return at.select(*by, "row", "col", F.inline(corners)).join(src, [*by, "_r", "_c"], "left").groupBy(*by, "row", "col").agg(F.try_divide(F.sum(F.col("_w") * F.col("_v")), F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")))).alias(value))


def bounding_registry(spark: SparkSession, boxes: list[tuple]) -> DataFrame:
    return spark.createDataFrame(boxes, "aoi_id string, minx double, miny double, maxx double, maxy double")


def union_bounds(boxes: DataFrame, by: list[str]) -> DataFrame:
    """by, minx, miny, maxx, maxy: the box around all boxes of each group."""
    return boxes.groupBy(*by).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def clip_boxes(boxes: DataFrame, minx: float, miny: float, maxx: float, maxy: float, required: bool = True) -> DataFrame:
    """boxes cut to one box; those outside go. With required it is an error if none is left."""
    cut = boxes.withColumns({"minx": F.greatest("minx", F.lit(minx)), "miny": F.greatest("miny", F.lit(miny)), "maxx": F.least("maxx", F.lit(maxx)), "maxy": F.least("maxy", F.lit(maxy))}).where("minx < maxx and miny < maxy")
    if required and cut.isEmpty():
        raise ValueError("the pilot box meets no area")
    return cut


def plan_moves(current: DataFrame, target: DataFrame) -> DataFrame:
    """tile_id, from_split, to_split of tiles whose split changes; tiles without a target stay."""
    own = current.select("tile_id", F.col("split_name").alias("from_split")).join(target.select("tile_id", F.col("split_name").alias("to_split")), "tile_id")
    return own.where("from_split <> to_split")


def resolve_splits(asked: str, n: int) -> list[int]:
    """Split numbers from `all` or one number; out of range or no number is an error."""
    if asked == "all":
        return list(range(n))
    if not asked.lstrip("-").isdigit() or not 0 <= int(asked) < n:
        raise ValueError(f"a split is all or a number from 0 to {n - 1}, not {asked!r}")
    return [int(asked)]
