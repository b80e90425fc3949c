"""Neighbourhood operators on cells keyed by row and column: joins on cell numbers, or one tile at a time in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def slope_aspect(dem: DataFrame, by: list[str], res: float, row: str = "row", col: str = "col", z: str = "elevation") -> DataFrame:
    """by, row, col, z, slope, aspect in degrees by the 3 x 3 weighted differences; null where a neighbour is missing; a flat
    cell has slope 0 and a null aspect. Rows grow southward. Two windows: along rows, then along columns."""
    along = W.partitionBy(*by, row).orderBy(col)

    def side(n: int):
        f = F.lead if n > 0 else F.lag
        return F.when(f(col, 1).over(along) == F.col(col) + n, f(z, 1).over(along))

    # East minus west, and the weighted sum of three in the row; neighbouring rows come by the second window.
    own = dem.withColumn("_w", side(-1)).withColumn("_e", side(1))
    own = own.withColumn("_d", F.col("_e") - F.col("_w")).withColumn("_s", F.col("_w") + 2 * F.col(z) + F.col("_e"))
    down = W.partitionBy(*by, col).orderBy(row)
    up = F.lag(row).over(down) == F.col(row) - 1
    below = F.lead(row).over(down) == F.col(row) + 1
    dx = (F.when(up, F.lag("_d").over(down)) + 2 * F.col("_d") + F.when(below, F.lead("_d").over(down))) / (8 * res)
    dy = (F.when(below, F.lead("_s").over(down)) - F.when(up, F.lag("_s").over(down))) / (8 * res)
    out = own.withColumn("_dx", dx).withColumn("_dy", dy)
    slope = F.degrees(F.atan(F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))))
    # Downslope direction, clockwise from north: east is -dx, north is dy as rows grow southward.
    aspect = F.pmod(F.degrees(F.atan2(-F.col("_dx"), F.col("_dy"))), F.lit(360.0))
    return out.select(*by, row, col, z, slope.alias("slope"), F.when((F.col("_dx") != 0) | (F.col("_dy") != 0), aspect).alias("aspect"))


def box_sums(cells: DataFrame, by: list[str], row: str, col: str, values: list[str], reach: int) -> DataFrame:
    """cells with <value>_box: sums over the (2 reach + 1)^2 cells around, missing cells as 0, at the cells that exist.

    A tile at a time, which is of bounded size: its cells become an array, and running sums along rows, then along columns,
    give all boxes at once; no cell is sent to those around it.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in cells.dtypes) + "".join(f", `{v}_box` double" for v in values)

    def swept(a: np.ndarray, axis: int) -> np.ndarray:
        pad = [(0, 0), (0, 0)]
        pad[axis] = (reach + 1, reach)
        total = np.cumsum(np.pad(a, pad), axis=axis)
        n = a.shape[axis]
        return np.take(total, range(2 * reach + 1, 2 * reach + 1 + n), axis=axis) - np.take(total, range(n), axis=axis)

    def one(part: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return part.assign(**{f"{v}_box": np.zeros(0) for v in values})
        r, c = (part[n].to_numpy() - part[n].min() for n in (row, col))
        out = {}
        for v in values:
            land = np.zeros((int(r.max()) + 1, int(c.max()) + 1))
            np.add.at(land, (r, c), part[v].to_numpy(float))
            out[f"{v}_box"] = swept(swept(land, 0), 1)[r, c]
        return part.assign(**out)

    return cells.groupBy(*by).applyInPandas(one, schema)


def local_mean(cells: DataFrame, by: list[str], row: str, col: str, value: str, reach: int = 5) -> DataFrame:
    """cells with local_mean: mean of the present cells within reach."""
    own = cells.withColumn("_one", F.when(F.col(value).isNotNull(), 1.0).otherwise(0.0)).withColumn("_v", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    return box_sums(own, by, row, col, ["_v", "_one"], reach).withColumn("local_mean", F.try_divide(F.col("_v_box"), F.col("_one_box"))).drop("_v", "_one", "_v_box", "_one_box")


def label_components(r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Number of the 8-connected component of each cell, by its smallest cell in reading order.

    Cells side by side are runs; runs of neighbouring rows that touch are linked, and every run takes the least of what it is linked to until
    nothing changes, following links of links at each turn.
    """
    order = np.lexsort((c, r))
    r, c = r[order].astype(np.int64), c[order].astype(np.int64)
    wide = int(c.max() - c.min()) + 3
    place = (r - r.min()) * wide + c - c.min() + 1
    first = np.flatnonzero(np.diff(place, prepend=-2) > 1)  # repeated cells belong to one run
    last = np.r_[first[1:], len(place)] - 1
    run = np.repeat(np.arange(len(first)), last - first + 1)
    # Runs of the next row from one column before to one after: theirs end at or after the first and begin at or before the last.
    low = np.searchsorted(place[last], place[first] + wide - 1)
    high = np.searchsorted(place[first], place[last] + wide + 1, side="right")
    n = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(first)), n)
    b = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    up = np.arange(len(first))
    while True:
        least = np.minimum(up[a], up[b])
        new = up.copy()
        np.minimum.at(new, up[a], least)
        np.minimum.at(new, up[b], least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, up):
            break
        up = new
    out = np.empty(len(order), np.int64)
    out[order] = first[up[run]]
    return out


def components(cells: DataFrame, by: list[str], row: str = "row", col: str = "col") -> DataFrame:
    """cells with component and component_px, 8-connected within each group (a tile and year, of bounded size)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in cells.dtypes)

    def one(part: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return part.assign(component=np.zeros(0, np.int64), component_px=np.zeros(0, np.int64))
        lab = label_components(part[row].to_numpy(), part[col].to_numpy())
        return part.assign(component=lab, component_px=np.bincount(lab)[lab])

    return cells.groupBy(*by).applyInPandas(one, f"{schema}, component long, component_px long")


def opening(cells: DataFrame, by: list[str], k: int, row: str = "row", col: str = "col") -> DataFrame:
    """cells with wide: whether the cell stays when the set of cells is opened by a k x k square.

    A square fits where k cells in a row follow one another, k rows deep; a cell stays if a fitting square covers it. Both are
    windows along rows, then along columns: every cell is one row throughout.
    """
    along, down = W.partitionBy(*by, row).orderBy(col), W.partitionBy(*by, col).orderBy(row)
    one = cells.select(*by, row, col).distinct()
    one = one.withColumn("_long", F.coalesce(F.lead(col, k - 1).over(along) == F.col(col) + (k - 1), F.lit(False)))
    # Down a column, the last of k places counts the rows that are long; they follow one another if their row numbers do.
    square = (F.sum(F.col("_long").cast("int")).over(down.rowsBetween(0, k - 1)) == k) & (F.lead(row, k - 1).over(down) == F.col(row) + (k - 1))
    one = one.withColumn("_fits", F.coalesce(square, F.lit(False)))
    one = one.withColumn("_some", F.max("_fits").over(along.rangeBetween(-(k - 1), 0)))
    kept = one.withColumn("wide", F.max("_some").over(down.rangeBetween(-(k - 1), 0))).select(*by, row, col, "wide")
    return cells.join(kept, [*by, row, col], "left")


def cast_shadow(dem: DataFrame, by: list[str], res: float, sun_elevation: float, sun_azimuth: float, reach: float = 2500.0, row: str = "row", col: str = "col", z: str = "elevation") -> DataFrame:
    """dem with shaded: whether a cell toward the sun rises above the ray, up to reach.

    A tile at a time: the ray crosses some hundred cells, and shifting a tile's array by each step costs far less than
    sending each cell to all those that it may shade. Tiles are of bounded size; cells outside the tile shade nothing.
    """
    if sun_elevation <= 0.5:
        return dem.withColumn("shaded", F.col(z).isNotNull())
    east, north, rise = np.sin(np.radians(sun_azimuth)), np.cos(np.radians(sun_azimuth)), np.tan(np.radians(sun_elevation))
    steps = list(dict.fromkeys(s for k in range(1, int(reach / res) + 1) if (s := (int(round(k * east)), int(round(-k * north)))) != (0, 0)))
    schema = ", ".join(f"`{n}` {t}" for n, t in dem.dtypes)

    def one(part: pd.DataFrame) -> pd.DataFrame:
        r, c = (part[n].to_numpy() - part[n].min() for n in (row, col))
        high, wide = int(r.max()) + 1, int(c.max()) + 1
        land = np.full((high, wide), -np.inf)
        land[r, c] = part[z].astype(float).fillna(-np.inf)
        needed = np.full((high, wide), -np.inf)
        for dx, dy in steps:
            if abs(dx) < wide and abs(dy) < high:
                to = needed[max(0, -dy) : high - max(0, dy), max(0, -dx) : wide - max(0, dx)]
                np.maximum(to, land[max(0, dy) : high + min(0, dy), max(0, dx) : wide + min(0, dx)] - np.hypot(dx, dy) * res * rise, out=to)
        own = land[r, c]
        return part.assign(shaded=(needed[r, c] > own) & np.isfinite(own))

    return dem.groupBy(*by).applyInPandas(one, f"{schema}, shaded boolean")


def fill_gaps(base: DataFrame, other: DataFrame, by: list[str], value: str, least: int = 100) -> DataFrame:
    """base with gaps filled from other, shifted by their median difference where `least` cells are common, else as it is."""
    both = base.withColumnRenamed(value, "_a").join(other.select(*by, "row", "col", F.col(value).alias("_b")), [*by, "row", "col"], "left")
    shift = both.groupBy(*by).agg(F.median(F.col("_a") - F.col("_b")).alias("_m"), F.count(F.col("_a") - F.col("_b")).alias("_n")).select(*by, F.when(F.col("_n") >= least, F.col("_m")).otherwise(0.0).alias("_shift"))
    return both.join(shift, by).withColumn(value, F.coalesce(F.col("_a"), F.col("_b") + F.col("_shift"))).drop("_a", "_b", "_shift")


def elevation_stats(dem: DataFrame, by: list[str], z: str = "elevation") -> DataFrame:
    return dem.groupBy(*by).agg(F.min(z).alias("min"), F.max(z).alias("max"), F.avg(z).alias("mean"), (100.0 * F.count(z) / F.count(F.lit(1))).alias("valid_pct"))


def overlap_mean(patches: DataFrame, by: list[str], place: str, size: int, value: str) -> DataFrame:
    """by, value: mean over overlapping patches with a raised-cosine weight by the place inside the patch (row * size + column)."""
    r, c = F.floor(F.col(place) / size), F.pmod(F.col(place), F.lit(size))
    hann = lambda x: F.greatest(F.lit(1e-3), 0.5 - 0.5 * F.cos(2 * F.pi() * (x + 0.5) / size))
    w = hann(r) * hann(c)
    return patches.where(F.col(value).isNotNull()).groupBy(*by).agg((F.sum(F.col(value) * w) / F.sum(w)).alias(value), F.count(F.lit(1)).alias("n"))


def clip_to_bounds(cells: DataFrame, x: str, y: str, minx: float, miny: float, maxx: float, maxy: float, value: str) -> DataFrame:
    """cells whose value is null where the centre lies outside the bounds; every cell stays."""
    inside = (F.col(x) >= minx) & (F.col(x) <= maxx) & (F.col(y) >= miny) & (F.col(y) <= maxy)
    return cells.withColumn(value, F.when(inside, F.col(value)))


def north_up(cells: DataFrame, by: list[str], rising: str, row: str = "row") -> DataFrame:
    """Rows counted from the north: rows of the groups whose y rises with the row are turned round."""
    last = F.max(row).over(W.partitionBy(*by))
    return cells.withColumn(row, F.when(F.col(rising), last - F.col(row)).otherwise(F.col(row)).cast(dict(cells.dtypes)[row]))
