"""Spectral indices as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-6
BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
#: The two bands of each normalised difference.
NORMALIZED = {
    "NDVI": ("nir", "red"),
    "NDSI": ("green", "swir1"),
    "NDWI_GAO": ("nir", "swir1"),
    "NBR": ("nir", "swir2"),
    "ND_SWIR1_SWIR2": ("swir1", "swir2"),
    "ND_BLUE_RED": ("blue", "red"),
    "ND_BLUE_NIR": ("blue", "nir"),
    "ND_GREEN_RED": ("green", "red"),
    "NDBI": ("swir1", "nir"),
    "NDWI_MCFEETERS": ("green", "nir"),
}
CHROMATICITY = {"CHROMA_R": "red", "CHROMA_G": "green", "CHROMA_B": "blue"}
#: Tasseled cap weights of BANDS, by sensor, for brightness, greenness and wetness.
TASSELED_CAP = {
    "l5": ((0.3037, 0.2793, 0.4743, 0.5585, 0.5082, 0.1863), (-0.2848, -0.2435, -0.5436, 0.7243, 0.0840, -0.1800), (0.1509, 0.1973, 0.3279, 0.3406, -0.7112, -0.4572)),
    "l7": ((0.3561, 0.3972, 0.3904, 0.6966, 0.2286, 0.1596), (-0.3344, -0.3544, -0.4556, 0.6966, -0.0242, -0.2630), (0.2626, 0.2141, 0.0926, 0.0656, -0.7629, -0.5388)),
    "l8": ((0.3029, 0.2786, 0.4733, 0.5599, 0.5080, 0.1872), (-0.2941, -0.2430, -0.5424, 0.7276, 0.0713, -0.1608), (0.1511, 0.1973, 0.3283, 0.3407, -0.7117, -0.4559)),
    "l9": ((0.3029, 0.2786, 0.4733, 0.5599, 0.5080, 0.1872), (-0.2941, -0.2430, -0.5424, 0.7276, 0.0713, -0.1608), (0.1511, 0.1973, 0.3283, 0.3407, -0.7117, -0.4559)),
    "s2": ((0.3510, 0.3813, 0.3437, 0.7196, 0.2396, 0.1949), (-0.3599, -0.3533, -0.4734, 0.6633, 0.0087, -0.2856), (0.2578, 0.2305, 0.0883, 0.1071, -0.7611, -0.5308)),
}
TC_NAMES = ("TC_BRIGHTNESS", "TC_GREENNESS", "TC_WETNESS")
#: Rank of how a band was made; an index is as good as its worst band.
PROVENANCE = ("native", "resampled")


def normalized_difference(a: Column, b: Column, eps: float = EPS) -> Column:
    return F.try_divide(a - b, a + b + F.lit(eps))


def index(name: str, eps: float = EPS) -> Column:
    """The index over columns named as BANDS; tasseled cap needs tasseled_cap()."""
    c = {b: F.col(b) for b in BANDS}
    if name in NORMALIZED:
        a, b = NORMALIZED[name]
        return normalized_difference(c[a], c[b], eps)
    if name in CHROMATICITY:
        return F.try_divide(c[CHROMATICITY[name]], c["red"] + c["green"] + c["blue"] + F.lit(eps))
    if name == "BSI":
        up, down = c["swir1"] + c["red"], c["nir"] + c["blue"]
        return F.try_divide(up - down, up + down + F.lit(eps))
    if name == "EVI":
        under = c["nir"] + 6.0 * c["red"] - 7.5 * c["blue"] + 1.0
        value = 2.5 * (c["nir"] - c["red"]) / F.when(F.abs(under) < eps, F.lit(eps)).otherwise(under)
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.nanvl(value, F.lit(0.0))))
    if name == "SAVI":
        return F.try_divide(1.5 * (c["nir"] - c["red"]), c["nir"] + c["red"] + 0.5)
    raise KeyError(f"no index {name!r}; known: {[*NORMALIZED, *CHROMATICITY, 'BSI', 'EVI', 'SAVI', *TC_NAMES]}")


def tasseled_cap(sensor: Column, component: int) -> Column:
    """Weighted sum of the six bands by the sensor's weights; an unknown sensor is an error when its row is read."""
    out = F.raise_error(F.concat(F.lit("no tasseled cap weights for sensor "), F.coalesce(sensor, F.lit("null")))).cast("double")
    for key, weights in TASSELED_CAP.items():
        terms = [F.col(b) * F.lit(w) for b, w in zip(BANDS, weights[component], strict=True)]
        out = F.when(F.lower(sensor) == key, sum(terms[1:], terms[0])).otherwise(out)
    return out


def with_indices(df: DataFrame, names: list[str], sensor_col: str = "sensor") -> DataFrame:
    """df with a column for each index: one projection, so a scan reads just the bands that they need."""
    return df.withColumns({n: tasseled_cap(F.col(sensor_col), TC_NAMES.index(n)) if n in TC_NAMES else index(n) for n in names})


def worst_provenance(*tags: Column) -> Column:
    """The worst of some bands' provenance; unknown tags are the worst and give 'unknown'."""
    ranks = [F.when(t == "native", 0).when(t == "resampled", 1).otherwise(2) for t in tags]
    worst = F.greatest(*ranks) if len(ranks) > 1 else ranks[0]
    return F.element_at(F.array(*[F.lit(x) for x in (*PROVENANCE, "unknown")]), worst + 1)


def needed_bands(names: list[str]) -> list[str]:
    use: set[str] = set()
    for n in names:
        if n in NORMALIZED:
            use |= {*NORMALIZED[n]}
        elif n in CHROMATICITY:
            use |= {"red", "green", "blue"}
        else:
            use |= {"BSI": {"blue", "red", "nir", "swir1"}, "EVI": {"blue", "red", "nir"}, "SAVI": {"red", "nir"}}.get(n, {*BANDS})
    return [b for b in BANDS if b in use]


def bandpass_table() -> Mapping[str, tuple[float, float]]:
    """Scale and offset by band that bring the older sensors to the newest one's response."""
    return {
        "blue": (1.022704, 0.004091),
        "green": (0.994728, 0.000895),
        "red": (1.024066, -0.000922),
        "nir": (1.001703, 0.000100),
        "swir1": (1.001302, 0.001101),
        "swir2": (0.997009, 0.001196),
    }
