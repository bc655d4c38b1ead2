"""Time-series operators.

A series is a table (time, value), or (series key, time, value) for many series. Rows are first
folded to one per period, so a series is as long as its calendar, not as its data; ordered windows
over one series are therefore short. Many series run in parallel by their key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.operators.quantiles import quantile_values


def ordered(time: str, keys: Sequence[str] = ()) -> Window:
    return (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(time)


STATISTICS = {"mean": F.avg, "sum": F.sum, "variance": F.var_samp, "min": F.min, "max": F.max}


def resample(df: DataFrame, time: str, value: str, period: str, statistics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Statistics per calendar period ("week", "month", "quarter", "year")."""
    bucket = F.date_trunc(period, time).cast("timestamp_ntz").alias("period")
    return df.groupBy(*keys, bucket).agg(*[STATISTICS[s](value).alias(s) for s in statistics])


def fill_calendar(df: DataFrame, time: str, step: str = "1 day", keys: Sequence[str] = ()) -> DataFrame:
    """Every period between the first and the last of each key; missing ones have null values."""
    ends = df.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    spine = ends.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {step}"))).alias(time))
    return spine.join(df, [*keys, time], "left")


def with_index(series: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``t``, the period number from 0."""
    return series.withColumn("t", (F.row_number().over(ordered(time, keys)) - 1).cast("long"))


def autocorrelation(series: DataFrame, time: str, value: str, lags: int) -> DataFrame:
    """(lag, acf) for 0..lags: one ordered window for all lags, one aggregate."""
    w = Window.partitionBy(F.lit(0))
    centred = series.select(time, (F.col(value) - F.avg(value).over(w)).alias("x"))
    o = ordered(time)
    wide = centred.select("x", *[F.lag("x", k).over(o).alias(f"l{k}") for k in range(1, lags + 1)])
    sums = [F.sum(F.col("x") * F.col("x")).alias("s0")]
    sums += [F.coalesce(F.sum(F.col("x") * F.col(f"l{k}")), F.lit(0.0)).alias(f"s{k}") for k in range(1, lags + 1)]
    cells = [F.struct(F.lit(k).alias("lag"), (F.col(f"s{k}") / F.col("s0")).alias("acf")) for k in range(lags + 1)]
    return wide.agg(*sums).select(F.inline(F.array(*cells)))


def partial_autocorrelation(series: DataFrame, time: str, value: str, lags: int) -> DataFrame:
    """(lag, pacf) by the Durbin-Levinson recursion on the autocorrelations (lags + 1 numbers)."""
    r = [row["acf"] for row in autocorrelation(series, time, value, lags).orderBy("lag").collect()]
    out, phi = [(0, 1.0)], np.zeros(0)
    for k in range(1, lags + 1):
        top = r[k] - float(np.dot(phi, [r[k - j - 1] for j in range(len(phi))]))
        bottom = 1 - float(np.dot(phi, [r[j + 1] for j in range(len(phi))]))
        last = top / bottom
        phi = np.append(phi - last * phi[::-1], last)
        out.append((k, last))
    return series.sparkSession.createDataFrame(out, "lag int, pacf double")


def cross_correlation(series: DataFrame, time: str, x: str, y: str, lags: int, z: float = 1.959963984540054) -> DataFrame:
    """(lag, ccf, band) for -lags..lags; the band is the one of white noise."""
    w = Window.partitionBy(F.lit(0))
    unit = series.select(
        time, (F.col(x) - F.avg(x).over(w)).alias("x"), (F.col(y) - F.avg(y).over(w)).alias("y")
    )
    o = ordered(time)
    shifts = range(-lags, lags + 1)
    wide = unit.select("x", "y", *[F.lag("y", k).over(o).alias(f"y{k + lags}") for k in shifts])
    row = wide.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        *[F.coalesce(F.sum(F.col("x") * F.col(f"y{k + lags}")), F.lit(0.0)).alias(f"s{k + lags}") for k in shifts],
    )
    cells = [F.struct(F.lit(k).alias("lag"), (F.col(f"s{k + lags}") / F.sqrt(F.col("xx") * F.col("yy"))).alias("ccf")) for k in shifts]
    return row.select((z / F.sqrt("n")).alias("band"), F.inline(F.array(*cells)))


def ljung_box(series: DataFrame, time: str, value: str, lags: int) -> DataFrame:
    """(lag, q, p_value): portmanteau statistic up to each lag."""
    from lodestat.operators.hypothesis_tests import chi2_tail

    n = series.agg(F.count(value)).scalar()
    terms = autocorrelation(series, time, value, lags).filter("lag > 0").withColumn("_n", n)
    term = F.col("acf") * F.col("acf") / (F.col("_n") - F.col("lag"))
    q = F.col("_n") * (F.col("_n") + 2) * F.sum(term).over(ordered("lag"))
    return terms.select("lag", q.alias("q")).withColumn("p_value", chi2_tail("q", F.col("lag").cast("double")))


def least_squares_sums(df: DataFrame, y: Column, xs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Cross products of [xs, y] per key: all a linear fit needs, k (k + 1) / 2 numbers."""
    cols = [*xs, y]
    k = len(cols)
    return df.groupBy(*keys).agg(
        F.array(*[F.sum(cols[i] * cols[j]) for i in range(k) for j in range(k)]).alias("gram"), F.count(y).alias("rows")
    )


def solve_gram(gram: Sequence[float]) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares from the cross products."""
    k = int(round(len(gram) ** 0.5))
    g = np.asarray(gram, dtype=float).reshape(k, k)
    beta = np.linalg.lstsq(g[:-1, :-1], g[:-1, -1], rcond=None)[0]
    return beta, float(g[-1, -1] - beta @ g[:-1, -1])


def granger(series: DataFrame, time: str, x: str, y: str, max_lag: int) -> DataFrame:
    """Per lag order the F test that past x improves the autoregression of y."""
    from lodestat.functions.special import f_tail

    o = ordered(time)
    out = []
    for p in range(1, max_lag + 1):
        lagged = series.select(
            F.col(y).alias("y"), *[F.lag(y, k).over(o).alias(f"y{k}") for k in range(1, p + 1)],
            *[F.lag(x, k).over(o).alias(f"x{k}") for k in range(1, p + 1)],
        ).na.drop()
        own = [F.lit(1.0), *[F.col(f"y{k}") for k in range(1, p + 1)]]
        both = [*own, *[F.col(f"x{k}") for k in range(1, p + 1)]]
        short = least_squares_sums(lagged, F.col("y"), own).first()
        full = least_squares_sums(lagged, F.col("y"), both).first()
        rss0, rss1 = solve_gram(short["gram"])[1], solve_gram(full["gram"])[1]
        rest = full["rows"] - 2 * p - 1
        f = (rss0 - rss1) / p / (rss1 / rest)
        out.append((p, f, f_tail(f, p, rest)))
    return series.sparkSession.createDataFrame(out, "lag int, f double, p_value double")


def decompose(series: DataFrame, time: str, value: str, period: float, keys: Sequence[str] = ()) -> DataFrame:
    """Additive decomposition: centred moving average, seasonal means per phase, residual.

    An even period takes period + 1 rows with half weight on both ends. A period that isn't whole is cut down.
    """
    t = with_index(series, time, keys)
    period = int(period)
    half = period // 2
    w = ordered(time, keys).rowsBetween(-half, half)
    ends = (F.lag(value, half).over(ordered(time, keys)) + F.lead(value, half).over(ordered(time, keys))) / 2 if period % 2 == 0 else F.lit(0.0)
    trend = F.when(F.count(F.lit(1)).over(w) == 2 * half + 1, (F.sum(value).over(w) - ends) / period)
    t = t.withColumn("trend", trend).withColumn("_phase", F.col("t") % period)
    t = t.withColumn("_off", F.col(value) - F.col("trend"))
    phases = t.groupBy(*keys, "_phase").agg(F.avg("_off").alias("_mean"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    phases = phases.withColumn("seasonal", F.col("_mean") - F.avg("_mean").over(whole)).drop("_mean")
    joined = t.join(phases, [*keys, "_phase"])
    return joined.select(*series.columns, "trend", "seasonal", (F.col("_off") - F.col("seasonal")).alias("residual"))


def residual_outliers(decomposed: DataFrame, residual: str = "residual", factor: float = 3.0) -> DataFrame:
    """Rows whose residual lies more than factor x IQR beyond the quartiles."""
    q = quantile_values(decomposed, [residual], {"q1": 0.25, "q3": 0.75})
    low, high = q[f"{residual}_q1"], q[f"{residual}_q3"]
    spread = factor * (high - low)
    return decomposed.filter((F.col(residual) > high + spread) | (F.col(residual) < low - spread))


def fourier_terms(index: Column, period: float, order: int) -> dict[str, Column]:
    out = {}
    for k in range(1, order + 1):
        angle = index * (2 * np.pi * k / period)
        out[f"sin_{k}"], out[f"cos_{k}"] = F.sin(angle), F.cos(angle)
    return out


def horizon_rows(series: DataFrame, time: str, horizon: int, step: str = "1 day", keys: Sequence[str] = ()) -> DataFrame:
    """The next ``horizon`` periods (keys, time, h, n): n is the length of the series."""
    last = series.groupBy(*keys).agg(F.max(time).alias("_last"), F.count(F.lit(1)).alias("n"))
    ahead = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return ahead.select(*keys, (F.col("_last") + F.col("h") * F.expr(f"interval {step}")).alias(time), "h", "n")


def naive_forecast(
    series: DataFrame, time: str, value: str, season: int, horizon: int, strategy: str, step: str = "1 day", keys: Sequence[str] = ()
) -> DataFrame:
    """Seasonal naive forecasts (keys, time, h, forecast): last season, mean per phase, or drift."""
    t = with_index(series, time, keys)
    ahead = horizon_rows(series, time, horizon, step, keys)
    if strategy == "drift":
        ends = t.groupBy(*keys).agg(
            F.max_by(value, "t").alias("_last"), F.min_by(value, "t").alias("_first"), F.max("t").alias("_span")
        )
        joined = ahead.join(ends, list(keys)) if keys else ahead.withColumn("_e", ends.select(F.struct("*")).scalar()).select("*", "_e.*")
        forecast = F.col("_last") + F.col("h") * (F.col("_last") - F.col("_first")) / F.col("_span")
        return joined.select(*keys, time, "h", forecast.alias("forecast"))
    if strategy not in ("last", "mean"):
        raise ValueError(f"unknown strategy: {strategy}")
    phase = F.col("t") % season
    best = F.max_by(value, "t") if strategy == "last" else F.avg(value)
    levels = t.groupBy(*keys, phase.alias("_phase")).agg(best.alias("forecast"))
    ahead = ahead.withColumn("_phase", (F.col("n") + F.col("h") - 1) % season)
    return ahead.join(levels, [*keys, "_phase"]).select(*keys, time, "h", "forecast")


def detrend_deseason(series: DataFrame, time: str, value: str, period: int) -> DataFrame:
    """Remove a least-squares line, then phase means; add trend, seasonal and the rest."""
    t = with_index(series, time)
    line = t.agg(F.struct(F.regr_slope(value, "t").alias("b"), F.regr_intercept(value, "t").alias("a")).alias("l")).scalar()
    t = t.withColumn("_l", line).withColumn("trend", F.col("_l.a") + F.col("_l.b") * F.col("t")).drop("_l")
    t = t.withColumn("_flat", F.col(value) - F.col("trend")).withColumn("_phase", F.col("t") % period)
    phases = t.groupBy("_phase").agg(F.avg("_flat").alias("seasonal"))
    joined = t.join(phases, "_phase")
    return joined.select(*series.columns, "trend", "seasonal", (F.col("_flat") - F.col("seasonal")).alias("rest"))


def exponential_smoothing(series: DataFrame, time: str, value: str, alpha: float, keys: Sequence[str]) -> DataFrame:
    """Last level of simple exponential smoothing per series.

    The level is a weighted sum with weights known from the distance to the end, so it is an
    aggregate: no recursion and no ordered list.
    """
    w = Window.partitionBy(*keys)
    back = F.row_number().over(w.orderBy(F.desc(time))) - 1
    rows = series.withColumn("_back", back).withColumn("_n", F.count(F.lit(1)).over(w))
    first = F.col("_back") == F.col("_n") - 1
    decay = F.pow(F.lit(1 - alpha), F.col("_back"))
    weight = F.when(first, decay).otherwise(alpha * decay)
    return rows.groupBy(*keys).agg(F.sum(weight * F.col(value)).alias("forecast"), F.count(F.lit(1)).alias("n"))


def autoregression_forecast(
    series: DataFrame, time: str, value: str, key: str, lags: int, horizon: int, season: int | None = None
) -> DataFrame:
    """AR(lags) per series by least squares, with optional phase dummies, forecast by recursion.

    One grouped aggregate gives every series its cross products; the small solves and recursions
    run on one row per series, spread by series.
    """
    o = ordered(time, [key])
    t = with_index(series, time, [key])
    rows = t.select(key, "t", F.col(value).alias("y"), *[F.lag(value, k).over(o).alias(f"y{k}") for k in range(1, lags + 1)])
    xs = [F.lit(1.0), *[F.col(f"y{k}") for k in range(1, lags + 1)]]
    if season:
        xs += [(F.col("t") % season == p).cast("double") for p in range(1, season)]
    sums = least_squares_sums(rows.filter(F.col(f"y{lags}").isNotNull()), F.col("y"), xs, [key])
    counted = t.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    recent = counted.groupBy(key).agg(
        F.array(*[F.max(F.when(F.col("t") == F.col("_n") - k, F.col(value))) for k in range(1, lags + 1)]).alias("tail"),
        F.max("_n").alias("n"),
    )
    joined = sums.join(recent, key).select(key, "gram", "tail", "n")

    def solve(batches):
        for pdf in batches:
            out = []
            for name, gram, tail, n in pdf.itertuples(index=False, name=None):
                beta, _ = solve_gram(gram)
                past = list(tail)
                for h in range(1, horizon + 1):
                    x = [1.0, *past[:lags]]
                    if season:
                        x += [float((n + h - 1) % season == p) for p in range(1, season)]
                    past.insert(0, float(np.dot(beta, x)))
                    out.append((name, h, past[0]))
            yield pd.DataFrame(out, columns=[key, "h", "forecast"])

    kind = dict(series.dtypes)[key]
    return joined.mapInPandas(solve, f"{key} {kind}, h int, forecast double")


def _fit_orders(gram: np.ndarray, rows: int, fixed: int, lags: int, m: int, order: int | None) -> tuple[int, np.ndarray] | None:
    """(lags used, coefficients) of the order with the least BIC, or of the given one, from one matrix of cross products.

    The matrix holds ``fixed`` regressors, then ``m`` columns per lag, then the ``m`` variables. Every order uses a leading part of it.
    """
    best = None
    ys = slice(fixed + lags * m, fixed + lags * m + m)
    for p in range(1, lags + 1) if order is None else [order]:
        k = fixed + p * m
        if rows <= k:
            continue
        scale = np.sqrt(np.diag(gram)[:k])
        scale[scale == 0] = 1.0
        beta = np.linalg.lstsq(gram[:k, :k] / np.outer(scale, scale), gram[:k, ys] / scale[:, None], rcond=1e-13)[0] / scale[:, None]
        cross = gram[:k, ys]
        noise = (gram[ys, ys] - cross.T @ beta - beta.T @ cross + beta.T @ gram[:k, :k] @ beta) / rows
        sign, size = np.linalg.slogdet(noise)
        score = (size if sign > 0 else -np.inf) + np.log(rows) / rows * k * m
        if best is None or score < best[0]:
            best = score, p, beta
    return None if best is None else best[1:]


def vector_autoregression(
    series: DataFrame,
    time: str,
    values: Sequence[str],
    lags: int,
    horizon: int,
    keys: Sequence[str] = (),
    exogenous: dict[str, Callable[[Column], Column]] | None = None,
    trend: str = "c",
    order: int | None = None,
    step: str = "1 day",
) -> DataFrame:
    """VAR per key with columns known from the time as exogenous variables: (keys, time, h, variable, forecast, lags).

    Every variable is regressed on a constant ("c"), a line as well ("ct") or neither ("n"), the exogenous columns and the lags of all variables.
    The number of lags up to ``lags`` is that with the least BIC, or ``order``; all are judged on the same rows, those with all
    lags and values known, so one grouped aggregate of cross products serves every order. The recursion runs on one row per
    key, all variables together. A key with too few rows, or with a null among its last values, has null forecasts.
    """
    keys, exogenous = list(keys), exogenous or {}
    given = [f(F.col(time)).cast("double") for f in exogenous.values()]
    o, m = ordered(time, keys), len(values)
    t = with_index(series, time, keys)
    past = {f"_l{k}_{i}": F.lag(v, k).over(o).cast("double") for k in range(1, lags + 1) for i, v in enumerate(values)}
    rows = t.withColumns(past).dropna(subset=[*values, *past])
    line = {"n": [], "c": [F.lit(1.0)], "ct": [F.lit(1.0), F.col("t").cast("double")]}[trend]
    now = [F.col(v).cast("double") for v in values]
    sums = least_squares_sums(rows, now[-1], [*line, *given, *map(F.col, past), *now[:-1]], keys)
    counted = t.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))))
    tail = F.array(*(F.max(F.when(F.col("t") == F.col("_n") - k, F.col(v).cast("double"))) for k in range(1, lags + 1) for v in values))
    recent = counted.groupBy(*keys).agg(tail.alias("tail"), F.max("_n").alias("n"))
    ahead = horizon_rows(series, time, horizon, step, keys).select(*keys, F.struct("h", F.col(time).alias("time"), F.array(*given).cast("array<double>").alias("x")).alias("a"))
    ahead = ahead.groupBy(*keys).agg(F.sort_array(F.collect_list("a")).alias("ahead"))  # as many as the horizon
    joined = recent
    for other in (ahead, sums):
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        joined = joined.alias("l").join(other.alias("r"), same, "left").select("l.*", *(f"r.{c}" for c in other.columns if c not in keys))
    fixed, n_lags = len(line) + len(given), lags
    names = list(values)

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                fitted = None
                if row.gram is not None:
                    size = int(round(len(row.gram) ** 0.5))
                    fitted = _fit_orders(np.asarray(row.gram, float).reshape(size, size), int(row.rows), fixed, n_lags, m, order)
                known = [float("nan") if v is None else v for v in row.tail]
                for step_ahead in row.ahead:
                    forecast = np.full(m, np.nan)
                    if fitted:
                        p, beta = fitted
                        start = {"n": [], "c": [1.0], "ct": [1.0, float(row.n + step_ahead["h"] - 1)]}[trend]
                        forecast = np.concatenate([start, step_ahead["x"], known[: p * m]]) @ beta
                    known = [*forecast, *known][: n_lags * m]
                    for name, v in zip(names, forecast):
                        out.append((*(getattr(row, k) for k in keys), step_ahead["time"], step_ahead["h"], name, None if np.isnan(v) else float(v), fitted[0] if fitted else None))
            yield pd.DataFrame(out, columns=[*keys, time, "h", "variable", "forecast", "lags"]).astype({"lags": "Int32", "h": "int32"})

    kinds = dict(series.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, time]) + ", h int, variable string, forecast double, lags int"
    return joined.mapInPandas(solve, schema)


def residual_band(errors: DataFrame, horizon: str, error: str, z: float = 1.959963984540054) -> DataFrame:
    """Half-width of a normal prediction band per horizon from past forecast errors."""
    return errors.groupBy(horizon).agg((z * F.stddev_samp(error)).alias("half_width"), F.count(F.lit(1)).alias("n"))


def cheapest_fleet(
    days: DataFrame, day: str, bus_demand: str, rail_demand: str, *, cost_40: float, cost_60: float, cost_rail: float,
    capacity_40: int, capacity_60: int, capacity_rail: int, trips_bus: int, trips_rail: int, share_40: float,
) -> DataFrame:
    """Per day the cheapest whole numbers of two bus sizes and of railcars that meet the demand.

    For each number of small buses the fewest large ones follow, so one row per candidate and a
    minimum per day find the optimum; railcars are independent.
    """
    room_40, room_60 = capacity_40 * trips_bus, capacity_60 * trips_bus
    need = F.col(bus_demand)
    most = F.ceil(need / room_40).cast("int")
    c = days.withColumn("buses_40", F.explode(F.sequence(F.lit(0), most)))
    c = c.withColumn("buses_60", F.greatest(F.lit(0), F.ceil((need - F.col("buses_40") * room_40) / room_60)).cast("int"))
    c = c.filter(F.col("buses_40") >= share_40 * (F.col("buses_40") + F.col("buses_60")))
    cost = F.col("buses_40") * cost_40 + F.col("buses_60") * cost_60
    best = c.groupBy(day).agg(
        F.min_by(F.struct("buses_40", "buses_60"), F.struct(cost, "buses_40")).alias("b"), F.max(rail_demand).alias("_rail")
    )
    rails = F.ceil(F.col("_rail") / (capacity_rail * trips_rail)).cast("int")
    out = best.select(day, "b.buses_40", "b.buses_60", rails.alias("railcars"))
    return out.withColumn("cost", F.col("buses_40") * cost_40 + F.col("buses_60") * cost_60 + F.col("railcars") * cost_rail)
