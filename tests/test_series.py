"""Indicators against plain loops and pandas, and cut series against whole ones."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.indicators import Windows, warmup, window_indicators
from tidepanel.operators.recurrence import (
    column_names,
    memory_rows,
    recurrence_indicators,
    series_values,
)
from tidepanel.operators.series_functions import transform_series
from tidepanel.plans.panel import indicators


def loop_ema(x, n):
    y = [np.nan] * len(x)
    if len(x) >= n:
        y[n - 1] = sum(x[:n]) / n
        for t in range(n, len(x)):
            y[t] = y[t - 1] + 2 / (n + 1) * (x[t] - y[t - 1])
    return np.array(y)


def loop_rsi(x, n):
    y = [np.nan] * len(x)
    up = [max(b - a, 0) for a, b in zip(x, x[1:])]
    down = [max(a - b, 0) for a, b in zip(x, x[1:])]
    for t in range(n, len(x)):
        if t == n:
            g, h = sum(up[:n]) / n, sum(down[:n]) / n
        else:
            g = (g * (n - 1) + up[t - 1]) / n
            h = (h * (n - 1) + down[t - 1]) / n
        y[t] = 0 if g + h == 0 else 100 * g / (g + h)
    return np.array(y)


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 5, 7, 8, 64, 65, 200])
def test_recurrences_against_loops(rows):
    x = np.random.default_rng(rows).uniform(1, 9, rows)
    made = series_values(x, (3,), ((3, 5),), ("RSI", "EMA", "DEMA", "TEMA"))
    e1 = loop_ema(x, 3)
    e2 = np.concatenate([e1[:2], loop_ema(e1[2:], 3)]) if rows > 2 else e1
    e3 = np.concatenate([e2[:4], loop_ema(e2[4:], 3)]) if rows > 4 else np.full(rows, np.nan)
    np.testing.assert_allclose(made["EMA_3"], e1, rtol=1e-12)
    np.testing.assert_allclose(made["RSI_3"], loop_rsi(x, 3), rtol=1e-12)
    np.testing.assert_allclose(made["DEMA_3"], 2 * e1 - e2, rtol=1e-11)
    np.testing.assert_allclose(made["TEMA_3"], 3 * e1 - 3 * e2 + e3, rtol=1e-11)
    np.testing.assert_allclose(made["MACD_3_5"], e1 - loop_ema(x, 5), atol=1e-12)
    for name in ("EMA", "RSI", "DEMA", "TEMA"):
        first = warmup(name, 3)
        values = made[f"{name}_3"]
        assert np.isnan(values[:first]).all() and not np.isnan(values[first:]).any()


def test_constant_price_gives_zero_rsi():
    assert series_values(np.ones(10), (3,), (), ("RSI",))["RSI_3"][5] == 0


def panel(spark, rows, tickers=("a",)):
    frames = []
    for i, t in enumerate(tickers):
        rng = np.random.default_rng(i)
        days = pd.date_range("2000-01-01", periods=rows, freq="D").date
        close = np.exp(rng.normal(0, 0.02, rows).cumsum()) * 100
        frames.append(pd.DataFrame({"ticker": t, "date": days, "close": close}))
    return spark.createDataFrame(pd.concat(frames)).repartition(4)


def test_long_series_are_cut_without_a_trace(spark, hot):
    periods, pairs = (3, 5), ((3, 5),)
    assert memory_rows(periods, pairs) < 400
    df = panel(spark, 2000, ("a", "b")).unionByName(panel(spark, 40, ("c",)))
    order = ["ticker", "date"]

    def run():
        made = recurrence_indicators(df, periods=periods, pairs=pairs)
        return window_indicators(made, periods=periods, pairs=pairs).toPandas().sort_values(order)

    whole = run().reset_index(drop=True)
    hot(300)
    cut = run().reset_index(drop=True)
    assert len(whole) == 4040
    pd.testing.assert_frame_equal(whole, cut, check_exact=False, rtol=1e-11, atol=1e-12)
    names = column_names(periods, pairs, ("RSI", "EMA", "DEMA", "TEMA"))
    assert set(names) < set(cut.columns)


def test_windows_against_pandas(spark):
    df = panel(spark, 60, ("a", "b", "c"))
    made = window_indicators(df, periods=(4, 5), pairs=((4, 7),)).toPandas()
    for _, one in made.groupby("ticker"):
        one = one.sort_values("date").reset_index(drop=True)
        x = one["close"]
        ret = x.pct_change()
        for n in (4, 5):
            roll = x.rolling(n)
            np.testing.assert_allclose(one[f"SMA_{n}"], roll.mean(), rtol=1e-10)
            np.testing.assert_allclose(one[f"VOLATILITY_{n}"], ret.rolling(n).std(), rtol=1e-9)
            np.testing.assert_allclose(
                one[f"SR_{n}"], ret.rolling(n).mean() / ret.rolling(n).std(), rtol=1e-8
            )
            np.testing.assert_allclose(one[f"MOM_{n}"], x - x.shift(n), rtol=1e-10)
            weights = np.arange(1, n + 1)
            wma = roll.apply(lambda v: (v * weights).sum() / weights.sum(), raw=True)
            np.testing.assert_allclose(one[f"WMA_{n}"], wma, rtol=1e-10)
        np.testing.assert_allclose(
            one["TRIMA_4"], x.rolling(2).mean().rolling(3).mean(), rtol=1e-10
        )
        np.testing.assert_allclose(
            one["TRIMA_5"], x.rolling(3).mean().rolling(3).mean(), rtol=1e-10
        )
        np.testing.assert_allclose(
            one["APO_4_7"], x.rolling(4).mean() - x.rolling(7).mean(), atol=1e-9
        )


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 60, 200])
@pytest.mark.parametrize("rows", [0, 1, 5, 59, 60, 61, 400])
def test_windows_of_every_length(rows, n):
    """Against windows that are added up afresh, far from zero and around sudden values."""
    rng = np.random.default_rng(rows * 1000 + n)
    near = rng.normal(0, 1, rows)
    spike = near.copy()
    spike[rows // 3 : rows // 3 + 1] = 1e9
    gap = near.copy()
    gap[rows // 2 : rows // 2 + 1] = np.nan
    for x in (near, near + 1e8, spike, gap, np.full(rows, 0.1)):
        made = Windows(x, n)
        means, weighted, deviations = made.mean(), made.weighted_mean(), made.deviation()
        assert len(means) == len(weighted) == len(deviations) == rows
        assert np.isnan(means[: n - 1]).all() and np.isnan(weighted[: n - 1]).all()
        weights = np.arange(1, n + 1) / (n * (n + 1) / 2)
        for t in range(n - 1, rows):
            part = x[t - n + 1 : t + 1]
            np.testing.assert_allclose(means[t], math.fsum(part) / n if np.isfinite(part).all() else np.nan, rtol=1e-13, atol=1e-13 * np.abs(part).max())
            np.testing.assert_allclose(weighted[t], (part * weights).sum(), rtol=1e-13, atol=1e-13 * np.abs(part).max())
            if n > 1:
                np.testing.assert_allclose(deviations[t], part.std(ddof=1), rtol=1e-10 if abs(part[0]) < 1e7 else 1e-7, atol=1e-15 * abs(part[0]))
    # A spike leaves nothing behind, and a constant series has no spread at all.
    if rows == 400 and 1 < n <= 60:
        assert (Windows(np.full(rows, 0.1), n).deviation()[n - 1 :] == 0).all()
        after = Windows(spike, n).deviation()[rows // 3 + n :]
        np.testing.assert_allclose(after, Windows(near, n).deviation()[rows // 3 + n :], rtol=1e-12)


def test_indicators_with_returns_in_blocks(spark, hot):
    """Returns follow the rows that are left, whether a series is cut or not."""
    df = panel(spark, 2000, ("a", "b")).withColumn("close", F.when(F.dayofyear("date").between(100, 107), 5.0).otherwise(F.col("close")))

    def run():
        made = indicators(df, "ticker", (3, 5), ((3, 5),), ("EMA",), ("SR", "SMA"), ((3, 5),), ((3, 5),), returns="ret")
        return made.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)

    whole = run()
    # Constant prices have no Sharpe ratio, so rows inside are left out and the next return spans them.
    assert 0 < len(whole) < 4000 - 2 * 5 and whole["ret"].isna().sum() == 2
    for _, one in whole.groupby("ticker"):
        np.testing.assert_allclose(one["ret"], one["close"].pct_change(), rtol=1e-12)
    hot(300)
    pd.testing.assert_frame_equal(whole, run()[whole.columns], check_exact=False, rtol=1e-11, atol=1e-12)


def test_zero_and_null_prices(spark):
    rows = [("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 3.0), ("a", 4, None), ("a", 5, 3.0), ("a", 6, 3.0)]
    df = spark.createDataFrame(rows, "ticker string, date int, close double")
    made = window_indicators(df, periods=(2,), pairs=(), kinds=("VOLATILITY", "SR")).orderBy("date")
    found = [tuple(r) for r in made.select("date", "VOLATILITY_2", "SR_2").collect()]
    # After the zero there is no return for one row; at the end both returns are 0.
    assert [f[0] for f in found] == [1, 2, 3, 5, 6]
    assert [f[1] for f in found] == [None, None, None, None, 0.0]
    assert [f[2] for f in found] == [None] * 5


def test_transform_series_in_blocks(spark, hot):
    df = panel(spark, 300, ("a", "b"))

    def run():
        made = transform_series(
            df, "ticker", "date", "close", lambda x: x.rolling(7).sum(), "s", halo=6
        )
        return made.orderBy("ticker", "date").select(F.round("s", 6)).toPandas()

    whole = run()
    hot(50)
    pd.testing.assert_frame_equal(whole, run())


def test_transform_series_that_is_never_cut(spark, hot):
    df = panel(spark, 300, ("a", "b"))
    made = transform_series(df, "ticker", "date", "close", lambda x: x.cumsum(), "s", halo=None)
    found = made.orderBy("ticker", "date").toPandas()
    wanted = found.groupby("ticker")["close"].cumsum()
    np.testing.assert_allclose(found["s"], wanted)
    hot(50)
    with pytest.raises(ValueError, match="hotRows"):
        transform_series(df, "ticker", "date", "close", lambda x: x.cumsum(), "s", halo=None)


def test_bare_indicators_are_the_same_rows(spark):
    """Rows that miss an indicator are left out by the task, with the indicators or without them."""
    from tidepanel.plans.panel import indicators

    rows = [(k, i, float(10 + (i * (k + 3)) % 7)) for k in range(3) for i in range(12)]
    df = spark.createDataFrame(rows, "ticker int, date int, close double")
    how = ((3,), ((2, 3),), ("EMA",), ("SMA", "SR"), ((2, 3),), ())
    full = indicators(df, "ticker", *how, returns="ret")
    bare = indicators(df, "ticker", *how, returns="ret", bare=True)
    assert bare.columns == ["ticker", "date", "close", "ret"]
    assert sorted(bare.collect(), key=str) == sorted(full.select(bare.columns).collect(), key=str)
    assert full.count() == full.dropna("any", subset=["EMA_3", "SMA_3", "SR_3", "APO_2_3"]).count() > 0
