"""Forecast accuracy as aggregates over (actual, predicted) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import finite, half_up, ratio


def scored(actual: str, predicted: str) -> str:
    """Rows that count: both figures finite and a positive actual."""
    return f"({finite(actual)} and {finite(predicted)} and {actual} > 0)"


def mape(actual: str, predicted: str) -> str:
    return f"avg(abs(({actual} - {predicted}) / {actual})) * 100"


def bundle(actual: str = "actual", predicted: str = "predicted") -> dict[str, str]:
    """The standard figures, rounded as published; apply to rows that pass ``scored``."""
    error = f"({actual} - {predicted})"
    total_spread = f"(var_pop({actual}) * count(*))"
    return {
        "mape_pct": half_up(mape(actual, predicted), 4),
        "smape_pct": half_up(f"avg(abs({error}) / ((abs({actual}) + abs({predicted})) / 2)) * 100", 4),
        "mae_mwh": half_up(f"avg(abs({error}))", 2),
        "rmse_mwh": half_up(f"sqrt(avg({error} * {error}))", 2),
        "r2": half_up(f"1 - {ratio(f'sum({error} * {error})', total_spread)}", 5),
        "n_obs": "count(*)",
    }


def evaluate(df: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    rows = df.where(scored(actual, predicted))
    return rows.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in bundle(actual, predicted).items()])


def pinball_loss(df: DataFrame, keys: list[str], quantile: float, actual: str = "actual", predicted: str = "predicted", name: str = "pinball_loss") -> DataFrame:
    delta = f"({actual} - {predicted})"
    loss = f"avg(greatest({quantile}D * {delta}, ({quantile}D - 1) * {delta}))"
    return df.where(scored(actual, predicted)).groupBy(*keys).agg(F.expr(loss).alias(name))


def coverage(df: DataFrame, keys: list[str], low: str, high: str, actual: str = "actual", name: str = "coverage_pct") -> DataFrame:
    """Share of actuals inside the interval, both ends included; no positivity rule."""
    rows = df.where(f"{finite(actual)} and {finite(low)} and {finite(high)}")
    inside = f"avg(case when {actual} between {low} and {high} then 1D else 0D end) * 100"
    return rows.groupBy(*keys).agg(F.expr(inside).alias(name))


def peak_rows(df: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "predicted", per_key: bool = False) -> DataFrame:
    """The busiest row of each UTC date over all series (the first of equals), or per series."""
    days = df.selectExpr("*", "to_date(period_utc) as _day")
    group = [*keys, "_day", *(["ba_code"] if per_key else [])]
    first = f"min_by(struct({actual} as a, {predicted} as p), struct(-{actual} as o1, ba_code as o2, period_utc as o3))"
    return days.groupBy(*group).agg(F.expr(first).alias("_row")).selectExpr(*keys, f"_row.a as {actual}", f"_row.p as {predicted}")


def peak_hour_mape(df: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "predicted", per_key: bool = False) -> DataFrame:
    peaks = peak_rows(df.where(f"{actual} is not null and {predicted} is not null"), keys, actual, predicted, per_key)
    figure = half_up(mape(actual, predicted), 4)
    return peaks.where(scored(actual, predicted)).groupBy(*keys).agg(F.expr(figure).alias("peak_hour_mape_pct"))


def skill(model: str, benchmark: str) -> str:
    """Percentage improvement over a benchmark; NULL when either is not finite or it is zero."""
    value = f"({benchmark} - {model}) / {benchmark} * 100"
    return f"case when {finite(model)} and {finite(benchmark)} and {benchmark} <> 0 then {half_up(value, 2)} end"


def leaderboard(
    predictions: DataFrame,
    actual: str = "demand_mwh",
    prefix: str = "pred_",
    benchmark: str = "eia_official",
    min_rows: int = 100,
    common_rows: bool = False,
) -> DataFrame:
    """Score every ``pred_*`` column on its own rows and compare with the benchmark; the best model first.

    With ``common_rows`` all models are scored on the hours every one of them predicts.
    """
    models = [c for c in predictions.columns if c.startswith(prefix)]
    rows = predictions
    if common_rows:
        rows = rows.where(" and ".join(f"{c} is not null" for c in models))
    long = (
        rows.unpivot(["period_utc", "ba_code", actual], models, "model", "predicted")
        .where(f"{actual} is not null and predicted is not null")
        .selectExpr("period_utc", "ba_code", f"{actual} as actual", "predicted", f"substring(model, {len(prefix) + 1}) as model")
    )
    enough = long.groupBy("model").agg(F.count(F.lit(1)).alias("_rows")).where(f"_rows >= {min_rows}").select("model")
    board = enough.join(evaluate(long, ["model"]), "model", "left").join(peak_hour_mape(long, ["model"]), "model", "left")
    reference = f"max(case when model = '{benchmark}' then mape_pct end) over (partition by 1)"
    return (
        board.selectExpr("*", f"{reference} as benchmark_mape_pct")
        .selectExpr("*", f"{skill('mape_pct', 'benchmark_mape_pct')} as skill_vs_eia_pct")
        .orderBy(F.asc_nulls_last("mape_pct"), "model")
    )


def headline(board: DataFrame, test_start: str = "cast(null as timestamp)", generated_at: str = "current_timestamp()") -> DataFrame:
    """The best model of a leaderboard, with the start of the test window and the time of the report (SQL texts)."""
    return board.orderBy("mape_pct", "model").limit(1).selectExpr(
        "model as best_model", "mape_pct as best_mape_pct", "benchmark_mape_pct as eia_benchmark_mape_pct",
        "skill_vs_eia_pct", "n_obs as test_observations", f"{test_start} as test_window_start", f"{generated_at} as generated_at_utc",
    )


def reconcile(windows: DataFrame) -> DataFrame:
    """One forecast per hour from overlapping windows: their mean, and how many there were."""
    return windows.groupBy("ba_code", "period_utc").agg(
        F.avg("prediction").alias("prediction"), F.count(F.lit(1)).alias("n_windows")
    )
