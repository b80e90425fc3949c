"""Structural breaks in irregular multivariate series, by a harmonic model that is monitored observation by observation."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..keys import Series

YEAR = 365.25
RIDGE = 1e-8
#: Observations from which a second and a third harmonic are fitted.
MORE_HARMONICS = (18, 24)
#: Rows of observations that one task's group is meant to hold.
GROUP_ROWS = 200_000


@lru_cache
def chi2_quantile(p: float, dof: int) -> float:
    """Quantile of the chi-square distribution, by its finite sums and bisection."""

    def above(x: float) -> float:
        half, total = x / 2, 0.0
        if dof % 2 == 0:
            term = 1.0
            for i in range(dof // 2):
                total += term
                term *= half / (i + 1)
            return math.exp(-half) * total
        term = 1.0
        for i in range(1, (dof - 1) // 2 + 1):
            total += term
            term *= x / (2 * i + 1)
        return math.erfc(math.sqrt(half)) + math.sqrt(2 * x / math.pi) * math.exp(-half) * total

    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - above(mid) < p else (low, mid)
    return (low + high) / 2


@dataclass(frozen=True)
class Params:
    """magnitude_on: the features whose residual must reach least_magnitude. season: days of year that take part; a window
    that drops observations allows one harmonic only. as_published: solve the first 2 + 2k + s columns of a fixed
    layout instead of the columns in use, so sensors' offsets enter only with three harmonics."""

    features: tuple[str, ...] = ("NBR", "NDVI", "NDWI_GAO", "TC_BRIGHTNESS")
    magnitude_on: tuple[str, ...] = ("NBR", "NDVI")
    p_change: float = 0.999
    p_outlier: float = 0.999999
    conse: int = 4
    init_obs: int = 18
    init_span: float = 365.0
    stability: float = 3.0
    least_rmse: float = 0.03
    harmonics: int = 3
    most_segments: int = 16
    least_magnitude: float = 0.1
    least_same_class: float = 0.2
    break_span: float = 45.0
    refit: int = 3
    persist_days: float = 300.0
    persist_obs: int = 4
    least_year_obs: int = 8
    season: tuple[int, int] | None = (152, 258)
    as_published: bool = False


def _mode(values: np.ndarray) -> tuple[int | None, float]:
    """Commonest class and its share, the smallest on ties."""
    seen = Counter(int(v) for v in values if v >= 0)
    if not seen:
        return None, 0.0
    best = min(seen, key=lambda c: (-seen[c], c))
    return best, seen[best] / sum(seen.values())


@dataclass
class _Fit:
    coef: np.ndarray
    rmse: np.ndarray
    inverse: np.ndarray
    columns: np.ndarray

    def residual(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return y - x[..., self.columns] @ self.coef

    def statistics(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of each row, squared residuals by the error of prediction, which grows with the leverage."""
        own = x[:, self.columns]
        z = (y - own @ self.coef) / self.rmse
        return (z * z).sum(axis=1) / (1.0 + ((own @ self.inverse) * own).sum(axis=1))


@dataclass
class Detector:
    """One series: days t (ordered), values y, class ids (-1 unknown) and sensors."""

    p: Params
    t: np.ndarray
    y: np.ndarray
    cls: np.ndarray
    sensor: np.ndarray
    doy: np.ndarray
    harmonics: int
    dead: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.dead = np.zeros(len(self.t), bool)
        turn = 2 * np.pi * self.doy / YEAR
        waves = [f(k * turn) for k in (1, 2, 3) for f in (np.cos, np.sin)]
        firsts = list(dict.fromkeys(self.sensor.tolist()))[1:]  # the first seen is the reference
        offsets = [(self.sensor == s).astype(float) for s in firsts]
        self.n_offsets = len(offsets)
        self.x = np.column_stack([np.ones(len(self.t)), np.zeros(len(self.t)), *waves, *offsets])
        self.chi = chi2_quantile(self.p.p_change, self.y.shape[1])
        self.out = chi2_quantile(self.p.p_outlier, self.y.shape[1])
        self.gate = [self.p.features.index(f) for f in self.p.magnitude_on if f in self.p.features]

    def fit(self, rows: np.ndarray) -> _Fit | None:
        n = len(rows)
        k = min(self.harmonics, 1 + sum(n >= m for m in MORE_HARMONICS))
        size = 2 + 2 * k + self.n_offsets
        columns = np.arange(size) if self.p.as_published else np.r_[np.arange(2 + 2 * k), np.arange(8, 8 + self.n_offsets)]
        columns = columns[columns < self.x.shape[1]]
        if n < size + 1:
            return None
        x, y = self.x[rows][:, columns], self.y[rows]
        a = x.T @ x + RIDGE * np.diag(np.r_[0.0, np.ones(len(columns) - 1)])
        try:
            np.linalg.cholesky(a)
            inverse = np.linalg.inv(a)
        except np.linalg.LinAlgError:
            return None
        coef = inverse @ (x.T @ y)
        left = y - x @ coef
        rmse = np.maximum(self.p.least_rmse, np.sqrt((left * left).sum(axis=0) / (n - size)))
        return _Fit(coef, rmse, inverse, columns)

    def window(self, start: int) -> tuple[np.ndarray, _Fit] | None:
        """First stable window of live observations from start on."""
        while True:
            live = start + np.flatnonzero(~self.dead[start:])
            if len(live) < self.p.init_obs:
                return None
            enough = np.flatnonzero((np.arange(len(live)) >= self.p.init_obs - 1) & (self.t[live] - self.t[live[0]] >= self.p.init_span))
            if not len(enough):
                return None
            rows = live[: enough[0] + 1]
            self.since(rows[0])
            model = self.fit(rows)
            if model is None:
                start = rows[0] + 1
                continue
            left = model.residual(self.x[rows], self.y[rows])
            scale = np.maximum(self.p.least_rmse, 1.4826 * np.median(np.abs(left), axis=0))
            far = ((left / scale) ** 2).sum(axis=1)
            if far.max() > self.out:
                self.dead[rows[far.argmax()]] = True
                continue
            drift = np.abs(model.coef[1]) * (self.t[rows[-1]] - self.t[rows[0]]) / YEAR
            worst = np.maximum(drift, np.maximum(np.abs(left[0]), np.abs(left[-1]))) / model.rmse
            if (worst > self.p.stability).any():
                start = rows[0] + 1
                continue
            return rows, model

    def since(self, row: int) -> None:
        self.x[:, 1] = (self.t - self.t[row]) / YEAR

    def exceeding(self, model: _Fit, at: int) -> list[int] | None:
        """The run of exceedances from at on, if it's long enough in number and time."""
        live = at + np.flatnonzero(~self.dead[at:])
        enough = np.flatnonzero((np.arange(len(live)) >= self.p.conse - 1) & (self.t[live] - self.t[at] >= self.p.break_span))
        if not len(enough):
            return None
        run = live[: enough[0] + 1]
        return run.tolist() if (model.statistics(self.x[run[1:]], self.y[run[1:]]) > self.chi).all() else None

    def believed(self, model: _Fit, rows: np.ndarray, run: list[int]) -> tuple[bool, bool, np.ndarray]:
        """(whether the run is a break, whether its persistence was seen, its median residual)."""
        p, gate = self.p, self.gate
        shift = np.median(model.residual(self.x[run], self.y[run]), axis=0)
        strongest = max((abs(shift[g]) for g in gate), default=0.0)
        if p.least_magnitude > 0 and strongest < p.least_magnitude:
            return False, False, shift
        if p.least_year_obs and int((~self.dead & (np.abs(self.t - self.t[run[0]]) <= 365)).sum()) < p.least_year_obs:
            return False, False, shift
        if p.least_same_class > p.least_magnitude and _mode(self.cls[rows])[0] == _mode(self.cls[run])[0] and strongest < p.least_same_class:
            return False, False, shift
        later = [q for q in range(run[-1] + 1, len(self.t)) if not self.dead[q] and self.t[q] - self.t[run[0]] >= p.persist_days][: p.persist_obs]
        if p.persist_days <= 0 or len(later) < 2:
            return True, False, shift
        then = np.median(model.residual(self.x[later], self.y[later]), axis=0)
        return any(then[g] * shift[g] > 0 and abs(then[g]) >= 0.5 * p.least_magnitude for g in gate), True, shift

    def segments(self) -> Iterator[dict]:
        start, n = 0, 0
        while start < len(self.t) and n < self.p.most_segments and (found := self.window(start)):
            first, model = found
            rows, broke, seen, shift = list(first), None, False, None
            waiting, at = 0, 0
            # Only rows ahead are looked at, and those that die lie behind: what is alive ahead stays as it is.
            live = int(first[-1]) + 1 + np.flatnonzero(~self.dead[int(first[-1]) + 1 :])
            while at < len(live):
                # All observations up to the next fit meet the same model, so they are scored at once.
                due = live[at : at + max(1, min(self.p.refit - waiting, 1 if len(rows) < 30 else self.p.refit))]
                over = np.flatnonzero(model.statistics(self.x[due], self.y[due]) > self.chi)
                if len(over):
                    due = due[: over[0]]
                rows += due.tolist()
                waiting += len(due)
                at += len(due)
                if len(over):
                    q = int(live[at])
                    at += 1
                    run = self.exceeding(model, q)
                    if run is None:
                        self.dead[q] = True
                    else:
                        real, seen, shift = self.believed(model, np.array(rows), run)
                        if real:
                            broke = run
                            break
                        rows.append(q)
                        waiting += 1
                if waiting and (waiting >= self.p.refit or len(rows) < 30):
                    model, waiting = self.fit(np.array(rows)) or model, 0
            if waiting:
                model = self.fit(np.array(rows)) or model
            yield self.record(n, np.array(rows), model, broke, seen, shift)
            n += 1
            if broke is None:
                return
            start = broke[0]

    def record(self, n: int, rows: np.ndarray, model: _Fit, run: list[int] | None, seen: bool, shift: np.ndarray | None) -> dict:
        cls, share = _mode(self.cls[rows])
        out = {"seg_index": n, "t_start": self.t[rows[0]], "t_end": self.t[rows[-1]], "t_break": None, "n_obs": len(rows), "seg_class": cls, "seg_class_frac": share, "break_class": None, "break_class_frac": None, "persist_flag": seen}
        raw = np.zeros(self.y.shape[1])
        if run:
            out["t_break"] = self.t[run[0]]
            out["break_class"], out["break_class_frac"] = _mode(self.cls[run])
            raw = np.median(self.y[run], axis=0) - np.median(self.y[rows[-self.p.conse :]], axis=0)
        c = model.coef
        phase = np.arctan2(c[3], c[2]) % (2 * np.pi)
        out["feat"] = [
            {"name": f, "magnitude": float(raw[i]), "level": float(c[0, i]), "slope": float(c[1, i]), "amplitude": float(np.hypot(c[2, i], c[3, i])), "peak_doy": float(phase[i] / (2 * np.pi) * YEAR), "rmse": float(model.rmse[i]), "resid_magnitude": float(shift[i]) if run else 0.0}
            for i, f in enumerate(self.p.features)
        ]
        return out


FEAT = "array<struct<name: string, magnitude: double, level: double, slope: double, amplitude: double, peak_doy: double, rmse: double, resid_magnitude: double>>"
RECORD = f"seg_index int, t_start date, t_end date, t_break date, n_obs int, seg_class int, seg_class_frac double, break_class int, break_class_frac double, persist_flag boolean, feat {FEAT}"


def detect(part: pd.DataFrame, p: Params, keys: list[str], time: str, label: str, source: str) -> Iterator[tuple[tuple, dict]]:
    """(key, segment) of all series of a table; observations with a missing feature don't count. Columns become arrays once, in the
    order of series, time and sensor; a series is a slice of them."""
    part = part[part[list(p.features)].notna().all(axis=1)].sort_values([*keys, time, source], kind="stable")
    days = pd.to_datetime(part[time])
    t, doy = (days - pd.Timestamp("1970-01-01")).dt.days.to_numpy().astype(float), days.dt.dayofyear.to_numpy()
    y, cls, sensor = part[list(p.features)].to_numpy(float), part[label].fillna(-1).to_numpy(int), part[source].astype(str).to_numpy()
    names = [part[k].to_numpy() for k in keys]
    new = np.zeros(len(part), bool)
    for own in names:
        new[1:] |= own[1:] != own[:-1]
    edges = [0, *np.flatnonzero(new).tolist(), len(part)]
    for a, b in zip(edges, edges[1:]):
        at, harmonics = np.arange(a, b), p.harmonics
        if p.season:
            inside = (doy[a:b] >= p.season[0]) & (doy[a:b] <= p.season[1])
            if not inside.all():
                at, harmonics = at[inside], 1
        if len(at) >= p.init_obs:
            key = tuple(own[a] for own in names)
            for found in Detector(p, t[at], y[at], cls[at], sensor[at], doy[at].astype(float), harmonics).segments():
                yield key, found


def segment(obs: DataFrame, s: Series, p: Params | None = None) -> DataFrame:
    """keys and a row for each segment: dates, class, break, and statistics by feature.

    Series are dealt by hash to groups of about GROUP_ROWS observations, so that a task gets many series at once and one
    shuffle serves all; a series is never cut.
    """
    p = p or Params()
    spark = obs.sparkSession
    own = obs.select(*s.keys, s.time, s.source, F.col(s.label).cast("int").alias(s.label), *[F.col(f).cast("double").alias(f) for f in p.features])
    groups = max(1, own.count() // GROUP_ROWS, spark.sparkContext.defaultParallelism)
    keys = ", ".join(f"`{k}` {dict(own.dtypes)[k]}" for k in s.keys)
    names = [c.split(" ")[0] for c in RECORD.split(", ")[:10]] + ["feat"]
    day = lambda d: None if d is None else (pd.Timestamp("1970-01-01") + pd.Timedelta(days=int(d))).date()

    def one(part: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for key, r in detect(part, p, list(s.keys), s.time, s.label, s.source):
            r |= {k: day(r[k]) for k in ("t_start", "t_end", "t_break")}
            rows.append([*key, *[r[n] for n in names]])
        out = pd.DataFrame(rows, columns=[*s.keys, *names])
        return out.astype({"seg_class": "Int64", "break_class": "Int64"}) if len(out) else out

    # The number of partitions is given, or small tables would be coalesced to one task for all series.
    dealt = own.withColumn("_g", F.pmod(F.xxhash64(*s.keys), F.lit(groups))).repartition(groups, "_g")
    return dealt.groupBy("_g").applyInPandas(lambda part: one(part), f"{keys}, {RECORD}")


def breaks_of(segments: DataFrame, s: Series, features: tuple[str, ...] = ("NBR", "NDVI")) -> DataFrame:
    """keys, t_break, drop, rise, break_class: the largest fall and gain of the gated residual over some features."""
    def one(name: str, sign: int):
        own = F.transform(F.filter("feat", lambda f: f["name"] == F.lit(name)), lambda f: sign * f["resid_magnitude"])
        return F.coalesce(F.get(own, F.lit(0)), F.lit(0.0))

    def change(sign: int):
        sides = [one(name, sign) for name in features]
        return F.greatest(*sides) if len(sides) > 1 else sides[0]

    return segments.where(F.col("t_break").isNotNull()).select(*s.keys, "t_break", change(-1).alias("drop"), change(1).alias("rise"), "break_class")


def summary(segments: DataFrame, s: Series) -> DataFrame:
    """keys, n_segments, t_break, break_class: of each series, with its latest break."""
    return segments.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("n_segments"), F.max("t_break").alias("t_break"), F.max_by("break_class", "t_break").alias("break_class"))
