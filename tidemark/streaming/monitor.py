"""Breaks as observations arrive: runs of exceedances of stored models, kept as state for each series."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..keys import Series

YEAR = 365.25


def expected(segments: DataFrame, s: Series, feature: str) -> DataFrame:
    """keys, t_start, level, slope, amplitude, peak_doy, rmse of a feature in each series' open segment."""
    own = segments.where(F.col("t_break").isNull())
    f = F.get(F.filter("feat", lambda x: x["name"] == F.lit(feature)), F.lit(0))
    return own.select(*s.keys, "t_start", f.alias("f")).select(*s.keys, "t_start", "f.level", "f.slope", "f.amplitude", "f.peak_doy", "f.rmse")


def alerts(stream: DataFrame, models: DataFrame, s: Series, value: str, threshold: float = 10.8, conse: int = 4, span: int = 45) -> DataFrame:
    """keys, t_break, n_obs: runs of at least conse observations over span days that all exceed the stored model.

    Each run is told once, when it is long enough. The state of a series is the run that is going on: four numbers. An observation older
    than the last one of its series is dropped; a batch run of the detector takes such observations in.
    """
    years = F.datediff(F.col(s.time), F.col("t_start")) / F.lit(YEAR)
    wave = F.col("amplitude") * F.cos(2 * F.pi() * (F.dayofyear(F.col(s.time)) - F.col("peak_doy")) / F.lit(YEAR))
    z = (F.col(value) - (F.col("level") + F.col("slope") * years + wave)) / F.col("rmse")
    scored = stream.join(models, list(s.keys)).where(F.col(value).isNotNull()).select(*s.keys, F.unix_date(F.col(s.time)).alias("_d"), (z * z > threshold).alias("_over"))
    kinds = dict(scored.dtypes)
    keys = ", ".join(f"`{k}` {kinds[k]}" for k in s.keys)

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n, told = state.get if state.exists else (0, -1, 0, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values("_d")
        for d, over in zip(rows["_d"].tolist(), rows["_over"].tolist()):
            if d < last:
                continue
            last = d
            if not over:
                first, n, told = 0, 0, 0
                continue
            first, n = (d, 1) if n == 0 else (first, n + 1)
            if not told and n >= conse and d - first >= span:
                told = 1
                out.append((*key, (pd.Timestamp("1970-01-01") + pd.Timedelta(days=first)).date(), n))
        state.update((first, last, n, told))
        yield pd.DataFrame(out, columns=[*s.keys, "t_break", "n_obs"])

    return scored.groupBy(*s.keys).applyInPandasWithState(follow, f"{keys}, t_break date, n_obs int", "first int, last int, n int, told int", "append", GroupStateTimeout.NoTimeout)
