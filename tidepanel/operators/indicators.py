"""Price indicators with a bounded look-back, in constant work per row and window length.

A series is cut into runs of the window's length. A window is the end of one run and the beginning of
the next, so running sums inside the runs, forwards and backwards, give every window from two of them.
Nothing is ever subtracted from a long total: a price far away, or a sudden one, leaves no trace in
windows that do not contain it. Spreads are merged from the running means and squares of both parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.skew import HotKeys, over_series

PERIODS = (20, 40, 60)
PAIRS = ((20, 40), (40, 60), (60, 80))

WINDOW_KINDS = ("SMA", "VOLATILITY", "SR", "MOM", "TRIMA", "WMA")


def warmup(kind: str, n: int, slow: int | None = None) -> int:
    """Rows of an entity before the first value of an indicator."""
    if kind in ("SMA", "WMA", "TRIMA", "EMA"):
        return n - 1
    if kind in ("MOM", "VOLATILITY", "SR", "RSI"):
        return n
    if kind == "DEMA":
        return 2 * (n - 1)
    if kind == "TEMA":
        return 3 * (n - 1)
    if kind in ("APO", "MACD"):
        return slow - 1
    raise ValueError(kind)


def percent_change(value: str, w: WindowSpec) -> Column:
    return F.try_divide(F.col(value), F.lag(value).over(w)) - 1


def changes(x: np.ndarray) -> np.ndarray:
    """Percent change from the value before; NaN at the start and after a zero."""
    made = np.full(len(x), np.nan)
    np.divide(x[1:], x[:-1], out=made[1:], where=x[:-1] != 0)
    return made - 1


def trima_lengths(n: int) -> tuple[int, int]:
    """The two stacked averages of a triangular mean."""
    return ((n + 1) // 2, (n + 1) // 2) if n % 2 else (n // 2, n // 2 + 1)


class Windows:
    """All windows of ``n`` consecutive values of a series; NaN for those that begin before it.

    A NaN makes the windows that contain it NaN, and no others.
    """

    def __init__(self, x: np.ndarray, n: int) -> None:
        self.size, self.n = len(x), n
        runs = -(-len(x) // n)
        self.runs = np.zeros((runs, n))
        self.runs.ravel()[: len(x)] = x
        # Values of a window in its later run, and in the one before.
        self.late = np.arange(max(len(x) - n + 1, 0)) % n
        self.late[self.late == 0] = n
        self.early = n - self.late

    def _backwards(self, values: np.ndarray) -> np.ndarray:
        return np.cumsum(values[:, ::-1], axis=1)[:, ::-1]

    def _window(self, forwards: np.ndarray) -> np.ndarray:
        """Of running values, those at the last value of every window."""
        return forwards.ravel()[self.n - 1 : self.size]

    def _start(self, backwards: np.ndarray) -> np.ndarray:
        """Of values that run backwards, those at the first value of every window; 0 where that begins a run."""
        made = backwards.ravel()[: len(self.late)].copy()
        made[:: self.n] = 0
        return made

    def _whole(self, made: np.ndarray) -> np.ndarray:
        return np.concatenate([np.full(self.size - len(made), np.nan), made])

    def mean(self) -> np.ndarray:
        total = self._window(np.cumsum(self.runs, axis=1)) + self._start(self._backwards(self.runs))
        return self._whole(total / self.n)

    def weighted_mean(self) -> np.ndarray:
        """Weights 1 for the first value to n for the last."""
        place = np.arange(1, self.n + 1)
        early = self._start(self._backwards(self._backwards(self.runs)))
        late = self._window(np.cumsum(self.runs * place, axis=1))
        late = late + self.early * self._window(np.cumsum(self.runs, axis=1))
        return self._whole((early + late) / (self.n * (self.n + 1) / 2))

    @staticmethod
    def _running_spread(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running means, and sums of squares around them, which only ever grow."""
        count = np.arange(1, values.shape[1] + 1)
        apart = values - values[:, :1]
        mean = np.cumsum(apart, axis=1) / count
        grown = np.zeros_like(apart)
        grown[:, 1:] = (apart[:, 1:] - mean[:, :-1]) ** 2 * (count[:-1] / count[1:])
        return mean + values[:, :1], np.cumsum(grown, axis=1)

    def deviation(self) -> np.ndarray:
        """Sample standard deviation."""
        if self.n < 2 or not len(self.late):
            return np.full(self.size, np.nan)
        mean, squares = (self._window(v) for v in self._running_spread(self.runs))
        before, more = (self._start(v[:, ::-1]) for v in self._running_spread(self.runs[:, ::-1]))
        apart = np.where(self.early > 0, mean - before, 0.0)
        squares = squares + more + apart**2 * self.early * self.late / self.n
        return self._whole(np.sqrt(squares / (self.n - 1)))


def window_values(
    x: np.ndarray, periods: Sequence[int], pairs: Sequence[tuple[int, int]], kinds: Sequence[str]
) -> dict[str, np.ndarray]:
    """All window indicators of one series; NaN where there is none."""
    out, means = {}, {}

    def mean(n: int) -> np.ndarray:
        if n not in means:
            means[n] = Windows(x, n).mean()
        return means[n]

    returns = changes(x) if {"VOLATILITY", "SR"} & set(kinds) else None
    for n in periods:
        if "SMA" in kinds:
            out[f"SMA_{n}"] = mean(n)
        if returns is not None:
            steps = Windows(returns, n)
            spread = steps.deviation()
            if "VOLATILITY" in kinds:
                out[f"VOLATILITY_{n}"] = spread
            if "SR" in kinds:
                made = np.full(len(x), np.nan)
                out[f"SR_{n}"] = np.divide(steps.mean(), spread, out=made, where=spread != 0)
        if "TRIMA" in kinds:
            short, rest = trima_lengths(n)
            out[f"TRIMA_{n}"] = np.concatenate([mean(short)[: short - 1], Windows(mean(short)[short - 1 :], rest).mean()])
        if "WMA" in kinds:
            out[f"WMA_{n}"] = Windows(x, n).weighted_mean()
        if "MOM" in kinds:
            out[f"MOM_{n}"] = np.concatenate([np.full(min(n, len(x)), np.nan), x[n:] - x[:-n]])
    for fast, slow in pairs:
        out[f"APO_{fast}_{slow}"] = np.where(np.isnan(mean(slow)), np.nan, mean(fast) - mean(slow))
    return out


def window_names(
    periods: Sequence[int], pairs: Sequence[tuple[int, int]], kinds: Sequence[str]
) -> list[str]:
    kept = ("SMA", "VOLATILITY", "SR", "TRIMA", "WMA", "MOM")
    names = [f"{k}_{n}" for n in periods for k in kept if k in kinds]
    return names + [f"APO_{f}_{s}" for f, s in pairs]


def window_rows(periods: Sequence[int], pairs: Sequence[tuple[int, int]]) -> int:
    """Earlier rows that a row may need."""
    return max([n + 1 for n in periods] + [s for _, s in pairs] + [1])


def per_series(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    halo: int,
    names: Sequence[str],
    compute: Callable[[np.ndarray, bool], dict[str, np.ndarray]],
    hot: HotKeys | None = None,
    complete: Sequence[str] = (),
) -> DataFrame:
    """Add the columns ``names`` that ``compute(values, from_start)`` makes of every entity's series in order.

    One grouped Arrow pass, so a single exchange by entity. Rows with a null value take no part and are
    left out, as are those that miss something made of ``complete``; NaN results are null. Entities too long for one task are computed in blocks that start
    ``halo`` rows early.
    """
    names, complete = list(names), list(complete)

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        x = table.column(value).cast(pa.float64()).to_numpy()
        from_start = "_block" not in table.column_names or table.column("_block")[0].as_py() == 0
        with np.errstate(all="ignore"):
            made = compute(x, from_start)
        if complete:
            kept = ~np.any([np.isnan(made[n]) for n in complete], axis=0)
            table, made = table.filter(pa.array(kept)), {n: made[n][kept] for n in names}
        columns = [pa.array(made[name], from_pandas=True) for name in names]
        return pa.Table.from_arrays([*table.columns, *columns], names=[*table.column_names, *names])

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        fields = [*frame.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)]
        return frame.groupBy(*part).applyInArrow(add, T.StructType(fields))

    return over_series(df.filter(F.col(value).isNotNull()), key, order, halo, build, hot)


def window_indicators(
    df: DataFrame,
    key: str = "ticker",
    order: str = "date",
    value: str = "close",
    periods: Sequence[int] = PERIODS,
    pairs: Sequence[tuple[int, int]] = PAIRS,
    kinds: Sequence[str] = WINDOW_KINDS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the window indicators; rows with a null value are left out."""
    names = window_names(periods, pairs, kinds)
    periods, pairs, kinds = tuple(periods), tuple(pairs), tuple(kinds)
    halo = window_rows(periods, pairs)
    return per_series(df, key, order, value, halo, names, lambda x, _: window_values(x, periods, pairs, kinds), hot)
