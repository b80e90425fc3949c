"""The shape of a long observation table, shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Series:
    """keys: what identifies a series (a pixel: tile, row, column). time: a DATE column. label: the class column.
    source: the sensor. scene: what identifies one acquisition."""

    keys: tuple[str, ...] = ("tile_id", "row", "col")
    time: str = "obs_date"
    label: str = "class_id"
    source: str = "sensor"
    scene: str = "scene_id"

    def by(self, *more: str) -> list[str]:
        return [*self.keys, *more]

    def at(self, **changes: object) -> Series:
        return replace(self, **changes)
