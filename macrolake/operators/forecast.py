"""Seasonal forecasts: additive Holt-Winters, fitted for many series in one plan.

A monthly series has one row per calendar month, so its array of values is
bounded by the calendar; series are spread over the cluster by their key, and
fitting needs no shuffle beyond the one that assembles the arrays. The
smoothing recursion is sequential in time and runs for every point of a fixed
parameter grid. A fold with built-in array functions computes the same numbers
but is interpreted element by element (measured: about 10 microseconds a step),
so the recursion is a vectorised pandas UDF that advances all series of an
Arrow batch and all grid points together.

:func:`hw_fit` takes the best grid point; :func:`hw_fit_optimised` goes on from
there and fits weights and starting states together, as the jobs do.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASON = 12
PERIODS = 6
MODEL = "holt-winters"
#: Candidate smoothing weights of level, trend and season. The ends matter: a price that
#: moves like a random walk wants a level weight of one and a steady trend and season.
GRID = (0.0, 0.1, 0.3, 0.6, 0.9, 1.0)
#: Steps of the descent from a grid point at most.
STEPS = 60
#: Series of a batch that are fitted together, and rows that a step of the grid or of the derivatives takes at once.
SERIES_AT_ONCE, GRID_ROWS, SLOPE_ROWS = 512, 32, 256
#: Half-width of the band in residual standard deviations.
BAND_WIDTH = 1.96


def actuals_series(mart: DataFrame, column: str, indicator: str | Column) -> DataFrame:
    """The non-null months of a mart column as (indicator, obs_month, value)."""
    code = indicator if isinstance(indicator, Column) else F.lit(indicator)
    return mart.filter(F.col(column).isNotNull()).select(
        code.alias("indicator"), "obs_month", F.col(column).cast("double").alias("value")
    )


def _series_arrays(actuals: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per series. The partition count is given, by default the session's
    number of shuffle partitions, because the rows are few and small but
    expensive: adaptive coalescing would put them in one task."""
    points = F.array_sort(F.collect_list(F.struct("obs_month", "value")))
    partitions = partitions or int(actuals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return actuals.repartition(partitions, "indicator").groupBy("indicator").agg(points.alias("points"))


def short_series(actuals: DataFrame, season: int = SEASON) -> DataFrame:
    """Series with fewer than two seasons of points, which cannot be fitted."""
    counts = actuals.groupBy("indicator").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") < 2 * season)


def require_two_seasons(actuals: DataFrame, season: int = SEASON, expected: list[str] | None = None) -> None:
    """Raise if any series is too short to fit, or one of the ``expected`` has no rows at all."""
    short = short_series(actuals, season)
    if expected:
        absent = actuals.sparkSession.createDataFrame([(i,) for i in expected], "indicator string")
        absent = absent.join(actuals.select("indicator").distinct(), "indicator", "left_anti")
        short = short.select("indicator", "n").union(absent.select("indicator", F.lit(0).cast("long")))
    total = short.count()
    if total:
        listed = ", ".join(f"{r['indicator']} ({r['n']})" for r in short.orderBy("indicator").limit(5).collect())
        raise ValueError(f"fewer than {2 * season} months in {total} series, such as: {listed}")


def hw_fit(actuals: DataFrame, season: int = SEASON, grid: tuple[float, ...] = GRID) -> DataFrame:
    """Fit every series; one row per series with its weights, final state and residual spread.

    Points are taken in month order as consecutive, gaps are not filled. The
    starting states come from the centred moving average of all full seasons:
    the season from the mean distance to it, level and trend from a
    straight line through its first season. A series that is exactly a line
    plus a season is therefore continued exactly. The weights (alpha, beta,
    gamma) are the grid point with the least sum of squared one-step errors,
    ties going to the smaller weights. ``season`` is even. Series shorter than
    two seasons are left out; see :func:`short_series` and
    :func:`require_two_seasons`.
    """
    return _fitted(actuals, season, _grid_search(season, grid))


def hw_fit_optimised(actuals: DataFrame, season: int = SEASON, grid: tuple[float, ...] = GRID, steps: int = STEPS) -> DataFrame:
    """As :func:`hw_fit`, with weights between 0 and 1 and starting states that minimise the squared errors together.

    A projected Gauss-Newton descent with damped steps starts at the best grid
    point and at the best one for each inner weight of the season and of the
    level, since the errors have several minima; derivatives come from the
    recursion itself. The seasonal values sum to zero, since a level and
    a season that differ by a constant give the same series. Every series has
    its own damping and stops by itself, so a fit depends on no other series of
    the batch and a rerun gives the same bits. The sum of squared errors is
    never above the grid's.
    """
    return _fitted(actuals, season, _grid_search(season, grid, steps))


def _fitted(actuals: DataFrame, season: int, search) -> DataFrame:
    fit = F.pandas_udf(search, _FIT_TYPE)
    n = F.col("n").cast("double")
    variance = (F.col("fit.sse") - F.col("fit.sum_error") * F.col("fit.sum_error") / n) / (n - 1)
    return (
        _series_arrays(actuals)
        .filter(F.size("points") >= 2 * season)
        .select(
            "indicator",
            F.size("points").alias("n"),
            F.element_at("points", -1)["obs_month"].alias("last_month"),
            fit(F.col("points.value")).alias("fit"),
        )
        .select(
            "indicator",
            "n",
            "last_month",
            *[F.col(f"fit.{c}").alias(c) for c in ("alpha", "beta", "gamma", "sse", "level", "trend", "seasonals")],
            F.sqrt(F.greatest(variance, F.lit(0.0))).alias("sigma"),
        )
    )


_FIT_TYPE = (
    "alpha double, beta double, gamma double, sse double, sum_error double, "
    "level double, trend double, seasonals array<double>"
)


def _grid_search(season: int, grid: tuple[float, ...], steps: int = 0):
    """A function from arrays of values to the best fit of each, for a pandas UDF; ``steps`` bounds the descent from there.

    All helpers are nested, so that executors need not have this package.
    """
    at_once, grid_rows, slope_rows = SERIES_AT_ONCE, GRID_ROWS, SLOPE_ROWS
    alpha, beta, gamma = np.array(list(itertools.product(sorted(grid), repeat=3))).T

    def starting_states(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Level and trend just before the first point, and one seasonal value per position; rows are series."""
        half = season // 2
        cycles = y.shape[1] // season
        centred = {}
        for t in range(half, cycles * season - half):
            total = 0.5 * y[:, t - half]
            for i in range(t - half + 1, t + half):
                total = total + y[:, i]
            centred[t] = (total + 0.5 * y[:, t + half]) / season
        raw = []
        for p in range(season):
            first = p + season if p < half else p
            raw.append(sum(y[:, t] - centred[t] for t in range(first, first + season * (cycles - 1), season)) / (cycles - 1))
        seasonals = [s - sum(raw) / season for s in raw]

        middle = (season - 1) / 2
        line = [centred[half + i] for i in range(season)]
        slope = sum((i - middle) * c for i, c in enumerate(line)) / sum((i - middle) ** 2 for i in range(season))
        return sum(line) / season - (half + middle + 1) * slope, slope, seasonals

    def search(y: np.ndarray, level0: np.ndarray, trend0: np.ndarray, season0: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        """The best grid point of each series, and the squared errors at all; state arrays are series x grid."""
        shape = (len(y), len(alpha))
        level = np.broadcast_to(level0[:, None], shape)
        trend = np.broadcast_to(trend0[:, None], shape)
        seasonals = [np.broadcast_to(s[:, None], shape) for s in season0]
        sum_error = np.zeros(shape)
        sse = np.zeros(shape)
        for t in range(y.shape[1]):
            value, oldest = y[:, t, None], seasonals[t % season]
            base = level + trend
            error = value - (base + oldest)
            before, level = level, alpha * (value - oldest) + (1 - alpha) * base
            trend = beta * (level - before) + (1 - beta) * trend
            seasonals[t % season] = gamma * (value - base) + (1 - gamma) * oldest
            sum_error = sum_error + error
            sse = sse + error * error
        best = np.argmin(sse, axis=1)
        row = np.arange(len(y))
        upcoming = [seasonals[(y.shape[1] + h) % season][row, best] for h in range(season)]
        found = pd.DataFrame(
            {
                "alpha": alpha[best],
                "beta": beta[best],
                "gamma": gamma[best],
                "sse": sse[row, best],
                "sum_error": sum_error[row, best],
                "level": level[row, best],
                "trend": trend[row, best],
                "seasonals": list(np.stack(upcoming, axis=1)),
            }
        )
        return found, sse

    def smooth(y: np.ndarray) -> pd.DataFrame:
        """Fit series of equal length, one per row of ``y``."""
        level0, trend0, season0 = starting_states(y)
        season0 = np.stack(season0)
        parts = [slice(i, i + grid_rows) for i in range(0, max(len(y), 1), grid_rows)]  # state arrays stay in the cache
        parts = [search(y[p], level0[p], trend0[p], season0[:, p]) for p in parts]
        found = pd.concat([part for part, _ in parts], ignore_index=True)
        if not steps or not len(y):
            return found
        sse = np.concatenate([errors for _, errors in parts])
        starts = np.stack([np.argmin(sse, axis=1)] + [some[np.argmin(sse[:, some], axis=1)] for some in groups])
        # A start that several groups share is followed once.
        new = np.stack([(starts[:i] != start).all(axis=0) for i, start in enumerate(starts)])
        which, of = np.nonzero(new)
        states = np.concatenate([level0[None], trend0[None], season0]).T
        x = np.concatenate([weights_of[starts[which, of]], states[of]], axis=1)
        tries = follow(y[of], descend(y[of], x))
        reached, place = np.full(new.shape, np.inf), np.zeros(new.shape, int)
        reached[which, of], place[which, of] = tries["sse"].fillna(np.inf), np.arange(len(of))
        first, row = np.argmin(reached, axis=0), np.arange(len(y))
        better = reached[first, row] < found["sse"].to_numpy()
        chosen = tries.iloc[place[first, row][better]].set_axis(np.flatnonzero(better))
        return pd.concat([found[~better], chosen]).sort_index()

    weights_of = np.stack([alpha, beta, gamma], axis=1)
    # The squared errors have several minima, mostly apart in the weight of the season and that of the level.
    within = (weights_of > 0) & (weights_of < 1)
    groups = [np.flatnonzero(within[:, :2].all(axis=1) & (gamma == g)) for g in sorted(set(gamma)) if 0 < g < 1]
    groups += [np.flatnonzero(within[:, 1:].all(axis=1) & (alpha == g)) for g in sorted(set(alpha)) if 0 < g < 1]
    groups = [g for g in groups if len(g)]

    def follow(y: np.ndarray, x: np.ndarray) -> pd.DataFrame:
        """The fit with given weights and starting states (alpha, beta, gamma, level, trend, one value per season position)."""
        a, b, c, level, trend = x[:, :5].T
        seasonals = list(x[:, 5:].T)
        sum_error, sse = np.zeros(len(y)), np.zeros(len(y))
        for t in range(y.shape[1]):
            value, oldest = y[:, t], seasonals[t % season]
            base = level + trend
            error = value - (base + oldest)
            before, level = level, a * (value - oldest) + (1 - a) * base
            trend = b * (level - before) + (1 - b) * trend
            seasonals[t % season] = c * (value - base) + (1 - c) * oldest
            sum_error, sse = sum_error + error, sse + error * error
        upcoming = np.stack([seasonals[(y.shape[1] + h) % season] for h in range(season)], axis=1)
        return pd.DataFrame(
            {"alpha": a, "beta": b, "gamma": c, "sse": sse, "sum_error": sum_error, "level": level, "trend": trend, "seasonals": list(upcoming)}
        )

    def squares(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Sum of squared errors of each series, rounded as in :func:`slopes`."""
        (a, b, c, level, trend), seasonals = x[:, :5].T.copy(), x[:, 5:].T.copy()
        sse = np.zeros(len(y))
        for t, value in enumerate(y.T.copy()):
            i = t % season
            base = level + trend
            error = value - base - seasonals[i]
            new = base + a * error
            trend = b * (new - level) + (1 - b) * trend
            seasonals[i] += c * error
            level = new
            sse += error * error
        return sse

    def slopes(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(half the gradient of the sum of squares, Gauss-Newton matrix) over the unknowns: all of ``x`` but the last season value."""
        unknowns = x.shape[1] - 1
        gradient, matrix = np.empty((len(y), unknowns)), np.empty((len(y), unknowns, unknowns))
        for start in range(0, len(y), slope_rows):
            rows = slice(start, start + slope_rows)
            gradient[rows], matrix[rows] = slopes_of_some(y[rows], x[rows])
        return gradient, matrix

    def slopes_of_some(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:func:`slopes` of rows whose arrays, unknowns x rows, stay in the cache. Months are added one after the other."""
        n, unknowns = len(y), x.shape[1] - 1
        if n == 1:  # a lone row's last sum has no axis but the months, and would be taken in another order
            gradient, matrix = slopes_of_some(np.repeat(y, 2, axis=0), np.repeat(x, 2, axis=0))
            return gradient[:1], matrix[:1]
        (a, b, c, level, trend), seasonals = x[:, :5].T.copy(), x[:, 5:].T.copy()
        wide_a, wide_b, wide_c, wide_rest = (np.tile(w, (unknowns, 1)) for w in (a, b, c, 1 - b))
        unit = np.eye(unknowns)
        d_level, d_trend = (np.repeat(unit[i][:, None], n, axis=1) for i in (3, 4))
        d_seasonals = np.repeat(np.concatenate([unit[5:], -unit[5:].sum(axis=0, keepdims=True)])[:, :, None], n, axis=2)
        d_new, product = np.empty((unknowns, n)), np.empty((unknowns, n))
        # Of each month the errors, and their derivatives with the sign turned.
        errors, falls = np.empty((y.shape[1], n)), np.empty((y.shape[1], unknowns, n))
        for t, value in enumerate(y.T.copy()):
            i = t % season
            base = level + trend
            error = errors[t] = value - base - seasonals[i]
            new = base + a * error
            d_season, fall = d_seasonals[i], falls[t]
            np.add(d_level, d_trend, out=d_new)
            np.add(d_new, d_season, out=fall)
            d_new -= np.multiply(fall, wide_a, out=product)
            d_new[0] += error
            np.subtract(d_new, d_level, out=product)
            product *= wide_b
            d_trend *= wide_rest
            d_trend += product
            d_trend[1] += new - level - trend
            trend = b * (new - level) + (1 - b) * trend
            d_season -= np.multiply(fall, wide_c, out=product)
            d_season[2] += error
            seasonals[i] += c * error
            level, d_level, d_new = new, d_new, d_level
        matrix = np.empty((n, unknowns, unknowns))
        for j in range(unknowns):
            column = np.einsum("tn,tkn->nk", falls[:, j], falls[:, j:])
            matrix[:, j, j:], matrix[:, j:, j] = column, column
        return -np.einsum("tkn,tn->nk", falls, errors), matrix

    def descend(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Better unknowns for each series, by damped steps that stay within the bounds of the weights."""
        damping, open_ = np.full(len(y), 1e-3), np.arange(len(y))
        x = x.copy()
        x[:, 5:] -= x[:, 5:].mean(axis=1, keepdims=True)
        sse, (gradients, matrices) = squares(y, x), slopes(y, x)
        for _ in range(steps):
            if not len(open_):
                break
            before, gradient, matrix = sse[open_], gradients[open_], matrices[open_]
            # A weight at its bound that wants to go beyond stays there.
            held = np.zeros(gradient.shape, bool)
            held[:, :3] = ((x[open_, :3] <= 0) & (gradient[:, :3] > 0)) | ((x[open_, :3] >= 1) & (gradient[:, :3] < 0))
            scale = np.einsum("nii->ni", matrix).copy()
            scale[held | (scale <= 0)] = 1.0
            matrix[held], gradient[held] = 0.0, 0.0
            matrix.transpose(0, 2, 1)[held] = 0.0
            k = scale.shape[1]
            matrix[:, range(k), range(k)] += np.where(held, 1.0, 0.0) + scale * damping[open_, None] + 1e-12
            move = np.linalg.solve(matrix, -gradient[:, :, None])[:, :, 0]
            trial = x[open_].copy()
            trial[:, :-1] += move
            trial[:, :3] = np.clip(trial[:, :3], 0.0, 1.0)
            trial[:, -1] = -trial[:, 5:-1].sum(axis=1)
            reached = squares(y[open_], trial)
            better = reached < before
            x[open_[better]], sse[open_[better]] = trial[better], reached[better]
            damping[open_] *= np.where(better, 0.2, 5.0)
            gained = better & (before - reached > 1e-10 * before)
            # Derivatives are taken where the descent goes on from, not at steps that are given up.
            moved = open_[gained]
            gradients[moved], matrices[moved] = slopes(y[moved], x[moved])
            open_ = open_[gained | (~better & (damping[open_] < 1e8))]
        return x

    def fit(series: pd.Series) -> pd.DataFrame:
        lengths = series.map(len)
        parts = []
        for _, same in series.groupby(lengths):
            for i in range(0, len(same), at_once):  # bounds the state arrays
                chunk = same.iloc[i : i + at_once]
                parts.append(smooth(np.stack(chunk.to_list())).set_index(chunk.index))
        if not parts:
            return smooth(np.zeros((0, 2 * season)))
        return pd.concat(parts).loc[series.index]

    fit.__annotations__ = {"series": pd.Series, "return": pd.DataFrame}
    return fit


def hw_forecast(fits: DataFrame, periods: int = PERIODS) -> DataFrame:
    """The next ``periods`` months of each fitted series, rounded to cents (ties to even)."""
    return _project(fits, periods).select("indicator", "obs_month", F.bround("raw", 2).alias("yhat"))


def hw_band(fits: DataFrame, periods: int = PERIODS) -> DataFrame:
    """Forecast with a band of 1.96 residual standard deviations, the same for every month."""
    band = F.lit(BAND_WIDTH) * F.col("sigma")
    return _project(fits, periods).select(
        "indicator",
        "obs_month",
        F.bround("raw", 2).alias("yhat"),
        F.bround(F.col("raw") - band, 2).alias("yhat_lower"),
        F.bround(F.col("raw") + band, 2).alias("yhat_upper"),
    )


def _project(fits: DataFrame, periods: int) -> DataFrame:
    ahead = fits.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    seasonal = F.get("seasonals", (F.col("h") - 1) % F.size("seasonals"))
    return ahead.select(
        "indicator",
        "sigma",
        F.add_months(F.trunc("last_month", "month"), F.col("h")).alias("obs_month"),
        (F.col("level") + F.col("h") * F.col("trend") + seasonal).alias("raw"),
    )


def forecast_monthly(actuals: DataFrame, forecasts: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """Actual and forecast rows in one table, told apart by ``is_forecast``."""
    known = actuals.select("indicator", "obs_month", F.col("value").alias("yhat"), F.lit(False).alias("is_forecast"))
    ahead = forecasts.withColumns({"is_forecast": F.lit(True), "model": F.lit(MODEL)})
    return ahead.unionByName(known, allowMissingColumns=True).select(
        "obs_month",
        "indicator",
        "yhat",
        "yhat_lower",
        "yhat_upper",
        "is_forecast",
        "model",
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
    )
