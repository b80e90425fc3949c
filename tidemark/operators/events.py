"""Names for breaks: what a series' seasons before and after them say, by a ladder of rules; objects and cropland."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..keys import Series
from . import grid
from .changes import prior_loss
from .quality import neighbours
from .series import season_shares

#: The names, and those that are a loss of forest or may be a line.
EVENTS = ("none", "fire", "cutblock", "permanent_clearing", "canopy_decline", "other_loss", "gain", "recent_clearing", "linear_feature", "open_land_disturbance", "regrowth_change", "cropland_change")
FOREST_LOSS = ["fire", "cutblock", "permanent_clearing", "recent_clearing"]
LINE_FROM = ["cutblock", "recent_clearing", "other_loss", "open_land_disturbance", "regrowth_change", "permanent_clearing"]


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules."""

    min_drop: float = 0.15
    forest: float = 0.8
    cleared: float = 0.2
    burned: float = 0.4
    season: tuple[int, int] = (5, 10)
    season_obs: int = 2
    pre_seasons: int = 2
    pre_forest: float = 0.5
    cleared_years: int = 3
    gap_seasons: int = 1
    permanent_months: int = 96
    permanent_bare: float = 0.6
    fire_months: tuple[int, int] = (6, 8)
    crop_season: tuple[int, int] = (6, 9)
    crop_years: int = 8
    crop_open: float = 0.8
    crop_closed: float = 0.2
    crop_bare: float = 0.03
    crop_bare_years: float = 0.15
    crop_start_years: int = 1
    crop_end_years: int = 2
    crop_patch: int = 300
    crop_width: int = 5
    object_px: int = 2000
    object_burned: float = 0.10
    object_dnbr: float = 0.45
    object_dnbr_burned: float = 0.05
    local_burned: float = 0.03
    line_width: int = 3
    line_extent: int = 15
    line_gap: int = 3


def seasons_around(breaks: DataFrame, classes: DataFrame, s: Series, forest: object, burned: object, bare: object, r: Rules | None = None) -> DataFrame:
    """breaks(keys, break_date, ...) with pre_forest, cleared_seasons, burned_fraction, bare_fraction, recovered_year,
    last_year, n_years of the series' stack.

    A season counts with season_obs observed months. Before: the last pre_seasons counted seasons ahead of the break's year are
    forest by pre_forest on average. After, from the break's year if the break lies ahead of the season, else the next: seasons with at most
    `cleared` forest follow each other; a season between cleared and forest is stepped over once if the next counted one is
    cleared. Burned and bare shares are means over the (first) cleared seasons. Then the first season that is forest again.
    The seasons of a series are one array in year order, a fold goes over it once.
    """
    r = r or Rules()
    shares = season_shares(classes, s, {"f": [forest], "b": [burned], "g": [bare]}, r.season).where(F.col("n_obs") >= r.season_obs)
    stack = classes.groupBy(*s.keys).agg(F.max(F.year(s.time)).alias("_last_year"))
    arrays = shares.groupBy(*s.keys).agg(F.sort_array(F.collect_list(F.struct(F.col("year").alias("y"), "f", "b", "g"))).alias("_s"))
    own = breaks.join(arrays, list(s.keys), "left").join(stack, list(s.keys), "left").withColumn("_s", F.coalesce("_s", F.array().cast("array<struct<y:int,f:double,b:double,g:double>>")))
    year = F.year("break_date")
    before = F.slice(F.reverse(F.filter("_s", lambda q: q["y"] < year)), 1, r.pre_seasons)
    total = F.aggregate(before, F.lit(0.0), lambda a, q: a + q["f"])
    pre = (F.size(before) >= r.pre_seasons) & (total / F.greatest(F.size(before), F.lit(1)) >= r.pre_forest)
    first = F.when(F.month("break_date") < r.season[0], year).otherwise(year + 1)
    after = F.filter("_s", lambda q: q["y"] >= first)
    ahead = F.transform(after, lambda q, i: F.struct(q["y"].alias("y"), q["f"].alias("f"), q["b"].alias("b"), q["g"].alias("g"), F.get(after, i + 1)["f"].alias("n")))
    zero = F.struct(F.lit(0).alias("stage"), F.lit(0).alias("cleared"), F.lit(0).alias("gaps"), F.lit(0.0).alias("burned"), F.lit(0.0).alias("bare"), F.lit(None).cast("int").alias("back"), F.lit(None).cast("int").alias("last"))

    def step(a: Column, q: Column) -> Column:
        noisy = (q["f"] > r.cleared) & (q["f"] < r.forest) & (a["gaps"] < r.gap_seasons) & (a["cleared"] >= 1) & F.coalesce(q["n"] <= r.cleared, F.lit(False))
        clear = (a["stage"] == 0) & ((q["f"] <= r.cleared) | noisy)
        back = (a["stage"] < 2) & ~clear & (q["f"] >= r.forest)
        return F.struct(
            F.when(clear, 0).when(back, 2).when(a["stage"] == 0, 1).otherwise(a["stage"]).alias("stage"),
            (a["cleared"] + clear.cast("int")).alias("cleared"),
            (a["gaps"] + (clear & noisy).cast("int")).alias("gaps"),
            (a["burned"] + F.when(clear & (a["cleared"] < r.cleared_years), q["b"]).otherwise(0.0)).alias("burned"),
            (a["bare"] + F.when(clear, q["g"]).otherwise(0.0)).alias("bare"),
            F.when(back, q["y"]).otherwise(a["back"]).alias("back"),
            F.when(a["stage"] < 2, q["y"]).otherwise(a["last"]).alias("last"),
        )

    own = own.withColumn("_a", F.aggregate(ahead, zero, step)).withColumn("pre_forest", pre)
    n = F.col("_a.cleared")
    return own.select(
        *breaks.columns,
        "pre_forest",
        n.alias("cleared_seasons"),
        (F.col("_a.burned") / F.greatest(F.least(n, F.lit(r.cleared_years)), F.lit(1))).alias("burned_fraction"),
        (F.col("_a.bare") / F.greatest(n, F.lit(1))).alias("bare_fraction"),
        F.col("_a.back").alias("recovered_year"),
        F.col("_a.last").alias("last_year"),
        "_last_year",
    )


def name_events(seen: DataFrame, s: Series, r: Rules | None = None) -> DataFrame:
    """event_type of each break from its seasons, drop and rise; later rules of the ladder win. Then losses on open land after a
    forest loss of the same series become changes during regrowth."""
    r = r or Rules()
    big, gain, pre = F.coalesce(F.col("drop") >= r.min_drop, F.lit(False)), F.coalesce(F.col("rise") >= r.min_drop, F.lit(False)), F.col("pre_forest")
    back, cleared = F.col("recovered_year").isNotNull(), F.col("cleared_seasons")
    year = F.year("break_date")
    months = (F.coalesce("recovered_year", F.greatest(F.coalesce("last_year", year), year)) - year) * 12
    burned = (F.col("burned_fraction") >= r.burned) & F.month("break_date").between(*r.fire_months)
    cut = big & pre & (cleared >= r.cleared_years) & ~burned
    recent = big & pre & ~back & (cleared >= 1) & (cleared < r.cleared_years) & (F.col("_last_year") - year <= r.cleared_years)
    ladder = [
        (gain, "gain"),
        (big, "other_loss"),
        (big & ~pre, "open_land_disturbance"),
        (big & pre & (cleared == 0), "canopy_decline"),
        (recent, "recent_clearing"),
        (cut, "cutblock"),
        (cut & ~back & (months >= r.permanent_months) & (F.col("bare_fraction") >= r.permanent_bare), "permanent_clearing"),
        (big & burned & pre & (cleared >= 1), "fire"),
    ]
    kind = F.lit("none")
    for when, name in ladder:
        kind = F.when(when, name).otherwise(kind)
    named = seen.withColumn("event_type", kind).withColumn("duration_months", months).withColumn("recovered", back).drop("_last_year")
    return prior_loss(named, s, FOREST_LOSS).drop("prior_losses")


def open_runs(classes: DataFrame, s: Series, grass: object, bare: object, crop: object | None = None, r: Rules | None = None) -> DataFrame:
    """keys, start_year, end_year, years, closed_share, bare_share, bare_years: each series' last run of crop_years or more open years.

    A run begins with a year open by crop_open and goes on while half open; one closed year is stepped over if the next counted one is open.
    """
    r = r or Rules()
    open_ = [c for c in (grass, bare, crop) if c is not None]
    shares = season_shares(classes, s, {"o": open_, "g": [bare]}, r.crop_season).where(F.col("n_obs") >= r.season_obs)
    years = shares.groupBy(*s.keys).agg(F.sort_array(F.collect_list(F.struct(F.col("year").alias("y"), "o", "g", "n_obs"))).alias("_s"))
    ahead = F.transform("_s", lambda q, i: F.struct(q["y"].alias("y"), q["o"].alias("o"), q["g"].alias("g"), q["n_obs"].alias("n"), F.get("_s", i + 1)["o"].alias("next")))
    run = "struct<start:int,last:int,seen:int,total:double,open:double,bare:double,bare_years:int>"
    none = F.lit(None).cast(run)

    def settle(now: Column, best: Column) -> Column:
        return F.when(F.coalesce(now["seen"] >= r.crop_years, F.lit(False)), now).otherwise(best)

    def step(a: Column, q: Column) -> Column:
        now, going = a["now"], a["now"].isNotNull()
        on = (q["o"] >= 0.5) & (going | (q["o"] >= r.crop_open))
        skip = (q["o"] < 0.5) & going & F.coalesce(q["next"] >= r.crop_open, F.lit(False))
        zero = lambda name, d: F.coalesce(now[name], F.lit(d))
        grown = F.struct(
            F.coalesce(now["start"], q["y"]).alias("start"),
            q["y"].alias("last"),
            (zero("seen", 0) + 1).alias("seen"),
            (zero("total", 0.0) + q["n"]).alias("total"),
            (zero("open", 0.0) + q["o"] * q["n"]).alias("open"),
            (zero("bare", 0.0) + q["g"] * q["n"]).alias("bare"),
            (zero("bare_years", 0) + (q["g"] > 0).cast("int")).alias("bare_years"),
        ).cast(run)
        over = ~on & ~skip & (q["o"] < 0.5)
        return F.struct(F.when(on, grown).when(over, none).otherwise(now).alias("now"), F.when(over, settle(now, a["best"])).otherwise(a["best"]).alias("best"))

    start = F.struct(none.alias("now"), none.alias("best"))
    own = years.withColumn("_r", F.aggregate(ahead, start, step, lambda a: settle(a["now"], a["best"]))).where("_r is not null")
    return own.select(*s.keys, F.col("_r.start").alias("start_year"), F.col("_r.last").alias("end_year"), F.col("_r.seen").alias("years"), (1 - F.col("_r.open") / F.col("_r.total")).alias("closed_share"), (F.col("_r.bare") / F.col("_r.total")).alias("bare_share"), F.col("_r.bare_years").alias("bare_years"))


def cropland(classes: DataFrame, s: Series, tile: list[str], row: str, col: str, grass: object, bare: object, crop: object | None = None, r: Rules | None = None) -> DataFrame:
    """Cells whose open run is worked land or as old as the series, lasts to its end, and lies in wide patches."""
    r = r or Rules()
    ends = classes.groupBy(*tile).agg(F.min(F.year(s.time)).alias("_y0"), F.max(F.year(s.time)).alias("_y1"))
    runs = open_runs(classes, s, grass, bare, crop, r).join(ends, tile)
    worked = (F.col("bare_share") >= r.crop_bare) & (F.col("bare_years") >= r.crop_bare_years * F.col("years"))
    old = F.col("start_year") - F.col("_y0") <= r.crop_start_years
    fits = runs.where((F.col("closed_share") <= r.crop_closed) & (worked | old) & (F.col("end_year") >= F.col("_y1") - r.crop_end_years))
    wide = grid.opening(fits, tile, max(r.crop_width, 1), row, col).where("wide").drop("wide", "_y0", "_y1")
    return grid.components(wide, tile, row, col).where(F.col("component_px") >= r.crop_patch).drop("component", "component_px")


def in_cropland(events: DataFrame, fields: DataFrame, s: Series) -> DataFrame:
    """Events inside fields, other than none, become changes of cropland."""
    inside = fields.select(*s.keys).distinct().withColumn("_in", F.lit(True))
    return events.join(inside, list(s.keys), "left").withColumn("event_type", F.when(F.col("_in") & (F.col("event_type") != "none"), "cropland_change").otherwise(F.col("event_type"))).drop("_in")


def refine_objects(events: DataFrame, tile: list[str], row: str, col: str, dnbr: str = "dnbr", r: Rules | None = None) -> DataFrame:
    """Events with object_px, retyped by the patch that they lie in (8-connected, one tile and break year at a time).

    A patch of object_px cells, half of them dated in fire months, with a mean burned share of object_burned, or a mean fall of
    object_dnbr and a little burn, is a fire in the cells dated so whose surroundings are burned. Of the rest, what an opening of line_width removes is thin;
    thin cells joined over gaps of line_gap that run line_extent cells long are linear features.
    """
    r = r or Rules()
    by = [*tile, "_y"]
    own = events.withColumn("_y", F.year("break_date")).withColumn("_summer", F.month("break_date").between(*r.fire_months))
    part = (F.col("event_type") != "none") & (F.col("event_type") != "gain")
    cells = grid.components(own.where(part).select(*by, row, col, "event_type", "burned_fraction", F.col(dnbr).alias("_dnbr"), "_summer").dropDuplicates([*by, row, col]), by, row, col)
    obj = cells.groupBy(*by, "component").agg(F.avg("burned_fraction").alias("_mb"), F.avg("_dnbr").alias("_md"), F.avg(F.col("_summer").cast("double")).alias("_ms"), F.count(F.lit(1)).alias("_n"))
    fire = (F.col("_n") >= r.object_px) & (F.col("_ms") >= 0.5) & ((F.col("_mb") >= r.object_burned) | ((F.col("_md") >= r.object_dnbr) & (F.col("_mb") >= r.object_dnbr_burned)))
    cells = cells.join(obj.withColumn("_fire", fire).select(*by, "component", "_fire"), [*by, "component"])
    cells = grid.local_mean(cells, by, row, col, "burned_fraction", 5)
    cells = cells.withColumn("_as_fire", F.coalesce(F.col("_fire") & F.col("_summer") & (F.col("local_mean") >= r.local_burned), F.lit(False)))
    rest = cells.where(~F.col("_as_fire") & F.col("event_type").isin(*LINE_FROM)).select(*by, row, col)
    thin = grid.opening(rest, by, r.line_width, row, col).where(~F.col("wide")).select(*by, row, col)
    pad = (r.line_gap + 1) // 2
    reach = neighbours(thin.withColumn("_one", F.lit(1)), by, row, col, pad, "_one").select(*by, row, col).distinct()
    strips = grid.components(reach, by, row, col)
    long_ = strips.groupBy(*by, "component").agg((F.greatest(F.max(row) - F.min(row), F.max(col) - F.min(col)) + 1 - 2 * pad).alias("_extent")).where(F.col("_extent") >= r.line_extent)
    line = thin.join(strips, [*by, row, col]).join(long_, [*by, "component"], "left_semi").select(*by, row, col).withColumn("_line", F.lit(True))
    found = cells.join(line, [*by, row, col], "left").select(*by, row, col, F.col("component_px").cast("int").alias("object_px"), "_as_fire", F.coalesce("_line", F.lit(False)).alias("_line"))
    out = own.join(found, [*by, row, col], "left")
    kind = F.when(part & F.col("_as_fire"), "fire").when(part & F.col("_line") & F.col("event_type").isin(*LINE_FROM), "linear_feature").otherwise(F.col("event_type"))
    return out.withColumn("event_type", kind).withColumn("object_px", F.when(part, F.coalesce("object_px", F.lit(0))).otherwise(0)).drop("_y", "_summer", "_as_fire", "_line")


def latest_event(events: DataFrame, s: Series) -> DataFrame:
    """keys, event_type, event_year, cut_months of each series' latest event other than none, and its latest cutblock's duration."""
    own = events.where(F.col("event_type") != "none")
    is_cut = F.col("event_type").isin("cutblock", "permanent_clearing")
    return own.groupBy(*s.keys).agg(F.max_by("event_type", "break_date").alias("event_type"), F.year(F.max("break_date")).alias("event_year"), F.max_by(F.when(is_cut, F.col("duration_months")), F.when(is_cut, F.col("break_date"))).alias("cut_months"))
