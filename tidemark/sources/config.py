"""Configuration and class files."""

from __future__ import annotations

import os
import re
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from ..schema import class_dim

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def load_config(path: str, env_file: str | None = None) -> dict:
    """A YAML file by parse_config, with the names of env_file and the environment."""
    values = dict(os.environ)
    if env_file and Path(env_file).exists():
        for line in Path(env_file).read_text().splitlines():
            name, eq, value = line.partition("=")
            if eq and not name.lstrip().startswith("#"):
                values.setdefault(name.strip(), value.strip().strip("'\""))
    return parse_config(Path(path).read_text(), values)


def parse_config(text: str, values: dict[str, str]) -> dict:
    """YAML with ${NAME} and ${NAME:-default} replaced; an unset name without a default is an error."""

    def one(m: re.Match) -> str:
        if (found := values.get(m[1], m[2])) is None:
            raise KeyError(f"{m[1]} is not set")
        return found

    return yaml.safe_load(_VARIABLE.sub(one, text)) or {}


def load_classes(spark: SparkSession, path: str) -> DataFrame:
    """The class dimension of a YAML list of id, name, color and change_eligible; colours have three parts from 0 to 255."""
    return parse_classes(spark, Path(path).read_text())


def parse_classes(spark: SparkSession, text: str) -> DataFrame:
    rows = []
    for c in yaml.safe_load(text)["classes"]:
        color = tuple(int(x) for x in c["color"])
        if len(color) != 3 or not all(0 <= x <= 255 for x in color):
            raise ValueError(f"class {c['name']}: colour {color}")
        rows.append((int(c["id"]), str(c["name"]), color, bool(c.get("change_eligible", True))))
    return class_dim(spark, rows)


def feature_names(indices: list[str], dem: tuple[str, ...] = (), doy: bool = False, place: bool = False, light: bool = False) -> list[str]:
    """Features in the fixed order: indices, terrain, day of year, place, illumination."""
    terrain = [n for d in dem for n in ((("aspect_sin", "aspect_cos")) if d == "aspect" else (d,))]
    return [*indices, *terrain, *(["doy_sin", "doy_cos"] if doy else []), *(["lat_norm", "lon_norm"] if place else []), *(["cos_incidence", "cast_shadow"] if light else [])]
