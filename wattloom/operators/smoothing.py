"""Additive Holt-Winters per series, many series at a time.

Smoothing is sequential within a series, so a series is first packed into arrays, one per (key,
chunk) and at most ``MIN_CHUNK`` values long; the fit of a key then folds over its few arrays.
With one value per key and hour a century of a series is seven megabytes.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.chunking import CHUNK, MIN_CHUNK
from wattloom.plans.baselines import seasonal_mean

# Smoothing weights of level, trend and season that a fit starts from.
LEVEL, TREND, SEASON = (0.05, 0.2, 0.5, 0.8), (0.0, 0.01, 0.1), (0.05, 0.2, 0.5)
MIN_SEASONS = 3
#: Passes over a series after the start.
SEARCH_ROUNDS = 12


def fold(values: np.ndarray, season: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Summed squared one-step errors, and last level, trend and pattern, of each row of weights; all run side by side."""
    a, b, g = weights.T
    first, second = values[:season], values[season : 2 * season]
    n = len(weights)
    level = np.full(n, first.mean())
    trend = np.full(n, (second.mean() - first.mean()) / season)
    pattern = np.tile(((first - first.mean()) + (second - second.mean())) / 2, (n, 1))
    squared = np.zeros(n)
    for t, y in enumerate(values):
        i = t % season
        ahead = level + trend
        old = pattern[:, i].copy()
        squared += (y - ahead - old) ** 2
        new_level = a * (y - old) + (1 - a) * ahead
        pattern[:, i] = g * (y - ahead) + (1 - g) * old
        trend = b * (new_level - level) + (1 - b) * trend
        level = new_level
    return squared, level, trend, pattern


def fitted_weights(values: np.ndarray, season: int) -> np.ndarray:
    """Weights in [0, 1] with the smallest one-step errors found: the best of the start grid, moved by a narrowing search.

    A round tries every neighbour of the best weights at the present step in one pass over the series;
    without a gain the step is a third. So the error is never above the grid's.
    """
    tried = np.array(list(itertools.product(LEVEL, TREND, SEASON)))
    errors = fold(values, season, tried)[0]
    best, least, step = tried[int(np.argmin(errors))], float(errors.min()), np.array([0.15, 0.05, 0.15])
    moves = np.array([m for m in itertools.product((-1, 0, 1), repeat=3) if any(m)])
    for _ in range(SEARCH_ROUNDS):
        tried = np.clip(best + moves * step, 0, 1)
        errors = fold(values, season, tried)[0]
        if errors.min() < least:
            best, least = tried[int(np.argmin(errors))], float(errors.min())
        else:
            step = step / 3
            if step.max() < 1e-3:
                break
    return best


def smooth(values: np.ndarray, season: int, horizon: int) -> np.ndarray:
    """Forecast with the fitted weights."""
    _, level, trend, pattern = fold(values, season, fitted_weights(values, season)[None, :])
    steps = np.arange(1, horizon + 1)
    return level[0] + steps * trend[0] + pattern[0][(len(values) + steps - 1) % season]


def holt_winters(frame: DataFrame, horizon: int, season: int = 24, target: str = "demand_mwh") -> DataFrame:
    """Forecast every key; one with fewer than three seasons falls back to its seasonal mean."""
    known = frame.where(f"{target} is not null").select("ba_code", "period_utc", target)
    packed = (
        known.groupBy("ba_code", F.expr(f"floor(unix_seconds(period_utc) / {3600 * MIN_CHUNK})").alias(CHUNK))
        .agg(
            F.expr(f"transform(sort_array(collect_list(struct(period_utc as p, {target} as v))), x -> x.v)").alias("part"),
            F.max("period_utc").alias("newest"),
        )
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(CHUNK)
        values = np.concatenate([np.asarray(p, dtype=float) for p in group["part"]])
        if len(values) < season * MIN_SEASONS:
            return pd.DataFrame(columns=["ba_code", "newest", "horizon_step", "forecast_mwh"])
        ahead = smooth(values, season, horizon)
        return pd.DataFrame(
            {
                "ba_code": group["ba_code"].iloc[0],
                "newest": group["newest"].max(),
                "horizon_step": np.arange(1, horizon + 1),
                "forecast_mwh": ahead,
            }
        )

    fitted = packed.groupBy("ba_code").applyInPandas(
        fit, "ba_code string, newest timestamp, horizon_step int, forecast_mwh double"
    ).selectExpr(
        "ba_code", "timestamp_seconds(unix_seconds(newest) + horizon_step * 3600) as period_utc", "horizon_step",
        "forecast_mwh", "'holt_winters' as method",
    )
    short = known.groupBy("ba_code").agg(F.count(F.lit(1)).alias("_n")).where(f"_n < {season * MIN_SEASONS}").select("ba_code")
    fallback = seasonal_mean(known.join(short, "ba_code", "left_semi"), horizon, season, target=target)
    return fitted.unionByName(fallback.selectExpr("*", "'seasonal_mean' as method"))
