"""Scene ids, labels and bins as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_S2 = r"^(\d{4})(\d{2})(\d{2})T\d{6}"
_LANDSAT = r"_(\d{4})(\d{2})(\d{2})$"


def scene_date(sensor: Column, scene_id: Column) -> Column:
    """Acquisition date written in a scene id; null where the id has none."""

    def part(pattern: str, n: int) -> Column:
        return F.regexp_extract(scene_id, pattern, n).try_cast("int")

    def date(pattern: str) -> Column:
        return F.try_to_date(F.concat_ws("-", *[F.regexp_extract(scene_id, pattern, n) for n in (1, 2, 3)]), "yyyy-MM-dd")

    return F.when(F.lower(sensor) == "s2", date(_S2)).otherwise(date(_LANDSAT))


def split_scene_key(key: Column) -> dict[str, Column]:
    """tile_id, sensor and scene_id of '<tile>_<sensor>_<scene>', at the first known sensor; empty where there is none."""
    pattern = r"(?i)^(.+?)_(l5|l7|l8|l9|s2)_(.+)$"
    return {"tile_id": F.regexp_extract(key, pattern, 1), "sensor": F.lower(F.regexp_extract(key, pattern, 2)), "scene_id": F.regexp_extract(key, pattern, 3)}


def safe_label(name: Column) -> Column:
    """Letters, digits, dot, dash and underscore; runs of others become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.trim(name), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def bin_index(value: Column, edges: list[float]) -> Column:
    """Bin of a value by inner edges, left-closed: below the first edge is bin 0, above the last the last bin, null -1."""
    out = F.lit(0)
    for n, edge in enumerate(edges[1:-1], start=1):
        out = F.when(value >= edge, n).otherwise(out)
    return F.when(value.isNull() | F.isnan(value.cast("double")), -1).otherwise(out)


def bin_labels(edges: list[float], unit: str = "") -> list[str]:
    return [f"{a:g}-{b:g}{unit}" for a, b in zip(edges, edges[1:])]


def utm_zone(lon: Column) -> Column:
    return F.least(F.lit(60), F.greatest(F.lit(1), (F.floor((lon + 180) / 6) + 1).cast("int")))


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, F.lit(32600)).otherwise(32700) + utm_zone(lon)


def signature(*columns: str) -> Column:
    """SHA-1 of the columns as JSON, in alphabetical order of their names."""
    return F.sha1(F.to_json(F.struct(*sorted(columns))))


#: What a name holds, and the unit that it stands for; the first that applies.
UNITS = (("yyyymm", "YYYYMM"), ("year", "year"), ("duration_months", "months"), ("n_segments", "number of segments"), ("n_months", "number of months"), ("n_intervals", "number of intervals"), ("n_", "count"), ("month", "month"), ("dnbr", "dNBR"), ("ndvi", "NDVI"), ("slope", "slope"), ("elevation", "m"))


def readable(name: Column) -> Column:
    """`latest_event_type` as "Latest event type", `ndvi__2019` as "Ndvi - 2019"."""
    parts = F.split(name, "__")
    head = F.replace(F.get(parts, F.lit(0)), F.lit("_"), F.lit(" "))
    head = F.concat(F.upper(F.substring(head, 1, 1)), F.substring(head, 2, 1 << 20))
    return F.when(F.size(parts) == 1, head).otherwise(F.concat(head, F.lit(" - "), F.array_join(F.slice(parts, 2, 1 << 20), " ")))


def unit_of(name: Column) -> Column:
    out = F.lit("value")
    for key, unit in reversed(UNITS):
        out = F.when(F.contains(F.lower(name), F.lit(key)), unit).otherwise(out)
    return out


def product_of(path: Column) -> Column:
    """The kind of product that a stored file is of, by its name."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    return F.when(stem.startswith("monthly_anomaly_"), "monthly_anomaly").when(stem.startswith("regrowth_severity"), "regrowth_severity").when(stem.startswith("block_"), "block").otherwise(stem)
