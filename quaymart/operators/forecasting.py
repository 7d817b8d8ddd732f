"""One-step forecasts of short monthly series held as arrays, in JVM expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = [step / 10 for step in range(1, 10)]
HOLT_MIN_POINTS = 4


def average_forecast(qtys: Column) -> Column:
    """Mean of the last three points, or of all if there are fewer."""
    last = F.slice(qtys, F.greatest(F.size(qtys) - 2, F.lit(1)), 3)
    return F.aggregate(last, F.lit(0.0), lambda total, qty: total + qty) / F.size(last)


def holt_forecast(qtys: Column) -> Column:
    """Additive-trend smoothing, the level and trend factors taken from a 9 × 9 grid.

    Level starts at the first point and trend at the first step. The pair with the least
    squared one-step error wins, the smaller pair on ties. NULL below four points.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a in GRID for b in GRID])
    # Errors are compared as shares of the largest quantity, so the unit of measure does not matter.
    scale = F.array_max(F.transform(qtys, lambda qty: F.abs(qty)))
    fits = F.transform(pairs, lambda pair: _fit(qtys, pair["alpha"], pair["beta"], scale))
    return F.when(F.size(qtys) >= HOLT_MIN_POINTS, F.array_min(fits)["forecast"])


def fitted_trend_forecast(qtys: Column) -> Column:
    """Additive-trend smoothing with factors and start state fitted to the least squared one-step error.

    For given factors the errors are linear in the first level and trend, so these follow from
    two normal equations. The factors are sought on the 9 × 9 grid and then around its best
    pair, in steps halved down to 1/160. NULL below four points.
    """
    return F.when(F.size(qtys) >= HOLT_MIN_POINTS, fitted_trend(qtys)["forecast"])


def fitted_trend(qtys: Column) -> Column:
    """(sse, alpha, beta, forecast) of the fit: the error as a share of the largest quantity, the factors in 1/160.

    Fits whose errors agree to nine decimals tie, the smaller pair of factors wins.
    """
    def scaled(top: Column) -> Column:
        return F.transform(qtys, lambda qty: F.coalesce(F.try_divide(qty, top), F.lit(0.0)))

    def search(points: Column) -> Column:
        grid = F.array(*[_pair(a, b) for a in range(16, 160, 16) for b in range(16, 160, 16)])
        around = F.array(*[_pair(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)])
        start = F.array_min(F.transform(grid, lambda p: _least_squares(points, p["alpha"], p["beta"])))
        return F.aggregate(F.array(*[F.lit(step) for step in (8, 4, 2, 1)]), start, lambda best, step: F.array_min(
            F.transform(around, lambda p: _least_squares(
                points, best["alpha"] + step * p["alpha"], best["beta"] + step * p["beta"]))))

    top = F.array_max(F.transform(qtys, lambda qty: F.abs(qty)))
    return _bound(top, lambda top: _bound(_bound(scaled(top), search), lambda fit: fit.withField(
        "forecast", fit["forecast"] * top)))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often lambdas inside name it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pair(alpha: int, beta: int) -> Column:
    return F.struct(F.lit(alpha).alias("alpha"), F.lit(beta).alias("beta"))


def _least_squares(points: Column, alpha: Column, beta: Column) -> Column:
    """The fit of two factors, from three runs: the points from a zero state (y), zeros from level 1 (u) and trend 1 (v)."""
    a, b = alpha / 160, beta / 160
    names = [f"{run}{part}" for run in "yuv" for part in ("level", "trend")]
    products = ["yy", "yu", "yv", "uu", "uv", "vv"]
    start = F.struct(
        *[F.lit(float(name in ("ulevel", "vtrend"))).alias(name) for name in names],
        *[F.lit(0.0).alias(name) for name in products])

    def step(state: Column, qty: Column) -> Column:
        expected = {run: state[f"{run}level"] + state[f"{run}trend"] for run in "yuv"}
        error = {"y": qty - expected["y"], "u": -expected["u"], "v": -expected["v"]}
        moved = [column for run in "yuv" for column in (
            (expected[run] + a * error[run]).alias(f"{run}level"),
            (state[f"{run}trend"] + a * b * error[run]).alias(f"{run}trend"))]
        return F.struct(*moved, *[(state[p] + error[p[0]] * error[p[1]]).alias(p) for p in products])

    def finish(state: Column) -> Column:
        determinant = state["uu"] * state["vv"] - state["uv"] * state["uv"]  # at least 1: u and v part at the second point
        level = (state["uv"] * state["yv"] - state["vv"] * state["yu"]) / determinant
        trend = (state["uv"] * state["yu"] - state["uu"] * state["yv"]) / determinant
        sse = state["yy"] + level * state["yu"] + trend * state["yv"]
        forecast = (state["ylevel"] + state["ytrend"] + level * (state["ulevel"] + state["utrend"])
                    + trend * (state["vlevel"] + state["vtrend"]))
        return F.struct(F.round(F.greatest(sse, F.lit(0.0)), 9).alias("sse"), alpha.alias("alpha"), beta.alias("beta"),
                        forecast.alias("forecast"))

    return F.aggregate(points, start, step, finish)


def _fit(qtys: Column, alpha: Column, beta: Column, scale: Column) -> Column:
    first, second = F.element_at(qtys, 1), F.element_at(qtys, 2)
    start = F.struct(first.alias("level"), (second - first).alias("trend"), F.lit(0.0).alias("sse"))

    def step(state: Column, qty: Column) -> Column:
        expected = state["level"] + state["trend"]
        level = alpha * qty + (1 - alpha) * expected
        trend = beta * (level - state["level"]) + (1 - beta) * state["trend"]
        error = qty - expected
        return F.struct(level.alias("level"), trend.alias("trend"), (state["sse"] + error * error).alias("sse"))

    def finish(state: Column) -> Column:
        # Rounded, so that equal fits tie although their sums were added differently.
        share = F.coalesce(F.try_divide(state["sse"], scale * scale), F.lit(0.0))
        return F.struct(F.round(share, 9).alias("sse"), alpha.alias("alpha"), beta.alias("beta"),
                        (state["level"] + state["trend"]).alias("forecast"))

    return F.aggregate(F.slice(qtys, 2, F.size(qtys)), start, step, finish)
