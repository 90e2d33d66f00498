"""Seasonal model fitted per series: iterated seasonal-trend smoothing for several seasons, then an autoregressive model.

Decomposition (Cleveland et al. 1990 for one season, Bandara et al. 2021 for several): each season in turn is smoothed
along its own hours by local regression, cleared of what is slower than itself and taken from the series; all seasons are
gone through again with the others removed. Seasons may change over time, unlike means by hour.

What the seasons leave is forecast by an autoregressive model. Whether it is differenced first is told by its
stationarity statistic (KPSS), its order is the one of smallest corrected information criterion, its coefficients are
those of the Levinson recursion. The last cycle of each season goes on.

One series is one group in ``applyInPandas``: its length is the look-back (8,760 hours a year) and series are independent,
so they spread over the cluster, and nothing is fitted on the driver.

Defined results: the rows of a series are taken in order of time as equally spaced, so fill gaps before; rows whose value is NULL or
NaN are left out; series with fewer than ``least`` values or no error give no forecast; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import shipping

PERIODS = (24, 168)
ROUNDS = 2
INNER = 2
#: Values along one hour of a season that the smoothing of the season sees: so many for the first season, and four more for each next.
SEASON_SPAN = 11
MOST_LAGS = 5
#: Fixed value: the statistic's five-per-cent bound for a level.
UNSTEADY = 0.463


def odd(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def season_span(k: int) -> int:
    return SEASON_SPAN + 4 * k


def trend_span(period: int, span: int) -> int:
    return odd(1.5 * period / (1 - 1.5 / span))


@lru_cache(maxsize=16)
def _weights(n: int, span: int, degree: int, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Local regression as a linear form: for each place from ``-beyond`` to ``n - 1 + beyond`` the indices seen and their weights."""
    seen = min(span, n)
    at = np.arange(-beyond, n + beyond)
    low = np.clip(at - span // 2, 0, n - seen)
    index = low[:, None] + np.arange(seen)
    x = (index - at[:, None]).astype(float)
    reach = np.abs(x).max(axis=1, keepdims=True) + 1 + max(0, (span - n) // 2)
    w = (1 - (np.abs(x) / reach) ** 3) ** 3
    if degree == 0:
        return index, w / w.sum(axis=1, keepdims=True)
    s0, s1, s2 = w.sum(axis=1, keepdims=True), (w * x).sum(axis=1, keepdims=True), (w * x * x).sum(axis=1, keepdims=True)
    spread = s0 * s2 - s1 * s1
    line = np.where(spread > 1e-9, w * (s2 - s1 * x) / np.where(spread > 1e-9, spread, 1), w / s0)
    return index, line


def smooth(y: np.ndarray, span: int, degree: int = 1, beyond: int = 0) -> np.ndarray:
    """Local regression with tricube weights over the ``span`` nearest values, for rows of ``y`` alike."""
    index, w = _weights(y.shape[-1], span, degree, beyond)
    return (y[..., index] * w).sum(axis=-1)


def average(y: np.ndarray, span: int) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(y)])
    return (sums[span:] - sums[:-span]) / span


def one_season(y: np.ndarray, period: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """``season, trend`` of a series of two periods or more."""
    n, trend = len(y), np.zeros(len(y))
    for _ in range(INNER):
        flat, cycle = y - trend, np.empty(n + 2 * period)
        for first, last in ((0, n % period), (n % period, period)):  # hours with one value more, and the others
            if last > first:
                rows = np.stack([flat[k::period] for k in range(first, last)])
                for k, row in zip(range(first, last), smooth(rows, span, degree=0, beyond=1), strict=True):
                    cycle[k::period] = row
        slow = smooth(average(average(average(cycle, period), period), 3), odd(period))
        season = cycle[period : period + n] - slow
        trend = smooth(y - season, trend_span(period, span))
    return season, trend


def decompose(y: np.ndarray, periods: tuple[int, ...] = PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """``seasons`` (a row for each period) and ``trend``."""
    seasons, rest, trend = np.zeros((len(periods), len(y))), y.astype(float), np.zeros(len(y))
    for _ in range(ROUNDS):
        for k, period in enumerate(periods):
            rest = rest + seasons[k]
            seasons[k], trend = one_season(rest, period, season_span(k))
            rest = rest - seasons[k]
    return seasons, trend


def unsteadiness(z: np.ndarray) -> float:
    """The KPSS statistic for a level: large if the sums of what is left of the mean wander off."""
    n, e = len(z), z - z.mean()
    lags = int(3 * np.sqrt(n) / 13)
    spread = e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / (n * spread)) if spread > 0 else 0.0


def autoregression(w: np.ndarray, most: int = MOST_LAGS) -> np.ndarray:
    """Coefficients of the order of smallest corrected information criterion, by the Levinson recursion."""
    n = len(w)
    r = np.array([w[k:] @ w[: n - k] / n for k in range(most + 1)])
    best, found, phi, v = np.inf, np.zeros(0), np.zeros(0), r[0]
    for p in range(most + 1):
        if p:
            k = (r[p] - phi @ r[p - 1 : 0 : -1]) / v if p > 1 else r[1] / v
            phi = np.append(phi - k * phi[::-1], k)
            v = v * (1 - k * k)
        if v <= 0 or n - p - 2 <= 0:
            break
        score = n * np.log(v) + 2 * (p + 1) + 2 * (p + 1) * (p + 2) / (n - p - 2)
        if score < best - 1e-9:
            best, found = score, phi
    return found


@dataclass
class Fit:
    seasons: np.ndarray
    trend: np.ndarray
    differences: int
    phi: np.ndarray
    mean: float
    left: np.ndarray  # what is autoregressed
    sigma: float  # spread of the one-step errors

    def ahead(self, periods: tuple[int, ...], horizon: int) -> tuple[np.ndarray, np.ndarray]:
        """Forecast values, and the standard error of each step by the model."""
        p, w = len(self.phi), list(self.left[len(self.left) - len(self.phi) :])
        reply = [1.0]
        for _ in range(horizon):
            w.append(float(self.phi @ np.array(w[len(w) - p :][::-1])) if p else 0.0)
        for k in range(1, horizon):
            reply.append(sum(self.phi[j] * reply[k - 1 - j] for j in range(min(p, k))))
        values, replies = np.array(w[p:]), np.array(reply)
        if self.differences:
            last = self.trend[-1] + self.remainder[-1]
            values, replies = last + np.cumsum(values), np.cumsum(replies)
        else:
            values = values + self.mean
        for season, period in zip(self.seasons, periods, strict=True):
            values = values + season[len(season) - period :][np.arange(horizon) % period]
        return values, self.sigma * np.sqrt(np.cumsum(replies**2))

    remainder: np.ndarray = None  # type: ignore[assignment]


def fit(y: np.ndarray, periods: tuple[int, ...] = PERIODS, most: int = MOST_LAGS) -> Fit:
    seasons, trend = decompose(y, periods)
    z = y - seasons.sum(axis=0)
    differences = int(unsteadiness(z) > UNSTEADY)
    mean = 0.0 if differences else float(z.mean())
    left = np.diff(z) if differences else z - mean
    phi = autoregression(left, most)
    p = len(phi)
    fitted = sum((phi[j] * left[p - 1 - j : len(left) - 1 - j] for j in range(p)), np.zeros(len(left) - p))
    sigma = float(np.std(left[p:] - fitted, ddof=1))
    return Fit(seasons, trend, differences, phi, mean, left, sigma, z - trend)


def _per_series(series: DataFrame, keys: list[str], value: str, columns: str, make: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame | None]) -> DataFrame:
    """``make`` of each series in order of time; ``columns`` come after the keys."""
    shipping.ship(series.sparkSession)
    kinds = dict(series.dtypes)
    rows = series.select(*keys, F.col("bucket").cast("timestamp").alias("bucket"), F.col(value).cast("double").alias("y"))
    rows = rows.where(F.col("y").isNotNull() & ~F.isnan("y"))
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), columns])
    names = [*keys, *(c.split()[0] for c in columns.split(", "))]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket", ignore_index=True)
        out = make(frame, frame["y"].to_numpy(float))
        if out is None:
            return pd.DataFrame({n: pd.Series(dtype=object) for n in names})
        for name, k in zip(keys, key, strict=True):
            out[name] = k
        return out[names]

    return rows.groupBy(*keys).applyInPandas(run, schema)


def parts(series: DataFrame, keys: list[str], value: str = "y", periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """``keys, bucket, y, trend, season_<period>..., remainder`` of every series of two of its longest periods or more."""
    names = [f"season_{p}" for p in periods]

    def make(frame: pd.DataFrame, y: np.ndarray) -> pd.DataFrame | None:
        if len(y) < 2 * max(periods):
            return None
        seasons, trend = decompose(y, periods)
        out = pd.DataFrame({"bucket": frame["bucket"], "y": y, "trend": trend} | dict(zip(names, seasons, strict=True)))
        out["remainder"] = y - trend - seasons.sum(axis=0)
        return out

    return _per_series(series, keys, value, ", ".join(f"{c} {'timestamp' if c == 'bucket' else 'double'}" for c in ["bucket", "y", "trend", *names, "remainder"]), make)


def forecast(
    series: DataFrame,
    keys: list[str],
    horizon: int = 24,
    width: float = 3.0,
    least: int = 2 * max(PERIODS),
    value: str = "y",
    periods: tuple[int, ...] = PERIODS,
    widening: bool = False,
) -> DataFrame:
    """The next hours of each series: ``forecast_for, forecast_value, forecast_lower, forecast_upper, sigma, step_error`` and the
    model's ``lags, differences``.

    Bounds are ``width`` times the spread of the one-step errors, or with ``widening`` times each step's own error.
    """

    def make(frame: pd.DataFrame, y: np.ndarray) -> pd.DataFrame | None:
        if len(y) < max(least, 2 * max(periods)):
            return None
        model = fit(y, periods)
        if not model.sigma > 1e-9 * max(1.0, float(np.abs(y).max())):
            return None
        values, errors = model.ahead(periods, horizon)
        band = width * (errors if widening else model.sigma)
        times = frame["bucket"].iloc[-1] + pd.to_timedelta(np.arange(1, horizon + 1), unit="h")
        return pd.DataFrame(
            {
                "forecast_for": times, "forecast_value": values, "forecast_lower": values - band, "forecast_upper": values + band,
                "sigma": model.sigma, "step_error": errors, "lags": len(model.phi), "differences": model.differences,
            }
        )

    return _per_series(
        series, keys, value, "forecast_for timestamp, forecast_value double, forecast_lower double, forecast_upper double, sigma double, step_error double, lags int, differences int", make
    )
