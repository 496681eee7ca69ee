"""Time series per entity: windows, recurrences, function surface."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.sql import NUMBERED, chained, ema, over, trailing
from tidepanel.operators.indicators import (
    PAIRS,
    PERIODS,
    percent_change,
    trima_lengths,
    window_indicators,
)
from tidepanel.operators.recurrence import recurrence_indicators
from tidepanel.operators.series_functions import broadcast_aggregate, merged_aggregate, transform_series
from tidepanel.operators.skew import over_series
from tidepanel.plans.panel import long_histories
from tidepanel.sources import fixtures as X

RET = """@r as (select *, close / nullif(lag(close) over
                 (partition by ticker order by date), 0) - 1 as ret from panel)"""


def windows(spark, sf_dir, kind, digits=6):
    names = [f"{kind}_{n}" for n in PERIODS]
    made = window_indicators(X.landed_closes(spark, sf_dir), pairs=(), kinds=(kind,))
    return rounded(made.select("ticker", "date", *names), digits, *names)


def per_period(template: str) -> str:
    """One SQL column per period; {n} and {w} stand for the period and its frame."""
    return ", ".join(template.format(n=n, w=trailing(n)) for n in PERIODS)


@query(
    "w1_percent_change",
    over("panel", body=RET + " select ticker, date, round(ret, 9) as ret from r"),
)
def change(spark, sf_dir):
    def build(frame, part):
        w = Window.partitionBy(*part).orderBy("date")
        return frame.withColumn("ret", percent_change("close", w))

    made = over_series(X.landed_closes(spark, sf_dir), "ticker", "date", 1, build)
    return rounded(made.select("ticker", "date", "ret"), 9, "ret")


@query(
    "w2_volatility",
    over(
        "panel",
        body=RET
        + " select ticker, date, "
        + per_period(
            "case when count(ret) over {w} = {n} then round(stddev_samp(ret) over {w}, 6) end "
            'as "VOLATILITY_{n}"'
        )
        + " from r",
    ),
)
def volatility(spark, sf_dir):
    return windows(spark, sf_dir, "VOLATILITY")


@query(
    "w3_sharpe",
    over(
        "panel",
        body=RET
        + " select ticker, date, "
        + per_period(
            "case when count(ret) over {w} = {n} then round(avg(ret) over {w} / "
            'nullif(stddev_samp(ret) over {w}, 0), 6) end as "SR_{n}"'
        )
        + " from r",
    ),
)
def sharpe(spark, sf_dir):
    return windows(spark, sf_dir, "SR")


@query(
    "w4_sma",
    over(
        "panel",
        body="select ticker, date, "
        + per_period(
            'case when count(close) over {w} = {n} then round(avg(close) over {w}, 6) end as "SMA_{n}"'
        )
        + " from panel",
    ),
)
def simple_mean(spark, sf_dir):
    return windows(spark, sf_dir, "SMA")


@query(
    "w5_wma",
    over(
        "panel",
        body="@l as (select ticker, date, "
        + per_period("list(close) over {w} as l{n}")
        + " from panel) select ticker, date, "
        + ", ".join(
            f"case when len(l{n}) = {n} then round(list_sum(list_transform(l{n}, "
            f"lambda x, i: x * i)) / {n * (n + 1) // 2}.0::double, 6) end as \"WMA_{n}\""
            for n in PERIODS
        )
        + " from l",
    ),
)
def weighted_mean(spark, sf_dir):
    return windows(spark, sf_dir, "WMA")


def _trima_sql() -> str:
    inner = ", ".join(
        f"case when count(close) over {trailing(trima_lengths(n)[0])} = {trima_lengths(n)[0]} "
        f"then avg(close) over {trailing(trima_lengths(n)[0])} end as t{n}"
        for n in PERIODS
    )
    outer = ", ".join(
        f"case when count(t{n}) over {trailing(trima_lengths(n)[1])} = {trima_lengths(n)[1]} "
        f'then round(avg(t{n}) over {trailing(trima_lengths(n)[1])}, 6) end as "TRIMA_{n}"'
        for n in PERIODS
    )
    return over(
        "panel",
        body=f"@t as (select *, {inner} from panel) select ticker, date, {outer} from t",
    )


@query("w6_trima", _trima_sql())
def triangular_mean(spark, sf_dir):
    return windows(spark, sf_dir, "TRIMA")


@query(
    "w7_momentum",
    over(
        "panel",
        body="select ticker, date, "
        + ", ".join(
            f"round(close - lag(close, {n}) over (partition by ticker order by date), 6) "
            f'as "MOM_{n}"'
            for n in PERIODS
        )
        + " from panel",
    ),
)
def momentum(spark, sf_dir):
    return windows(spark, sf_dir, "MOM")


def _join_sql(columns: dict[str, str], tables: list[str], digits: int) -> str:
    """Left-join recurrence results to all rows of the panel."""
    made = ", ".join(f'round({expr}, {digits}) as "{name}"' for name, expr in columns.items())
    joins = " ".join(
        f"left join {t} on {t}.ticker = p.ticker and {t}.date = p.date" for t in tables
    )
    return f" select p.ticker, p.date, {made} from numbered p {joins}"


def _ema_sql() -> str:
    ctes = ",".join(ema(f"e{n}", "numbered", n) for n in PERIODS)
    columns = {f"EMA_{n}": f"e{n}.y" for n in PERIODS}
    body = "@" + NUMBERED + "," + ctes + _join_sql(columns, [f"e{n}" for n in PERIODS], 5)
    return over("panel", body=body, recursive=True)


def recurrences(spark, sf_dir, kind, digits):
    names = [f"{kind}_{n}" for n in PERIODS]
    made = recurrence_indicators(X.landed_closes(spark, sf_dir), pairs=(), kinds=(kind,))
    return rounded(made.select("ticker", "date", *names), digits, *names)


@query("w8_ema", _ema_sql())
def exponential_mean(spark, sf_dir):
    return recurrences(spark, sf_dir, "EMA", 5)


def _dema_sql() -> str:
    ctes, columns, tables = [], {}, []
    for n in PERIODS:
        ctes += [
            ema(f"e{n}", "numbered", n),
            chained(f"x{n}", f"e{n}", n),
            ema(f"d{n}", f"x{n}", n),
        ]
        columns[f"DEMA_{n}"] = f"2 * e{n}.y - d{n}.y"
        tables += [f"e{n}", f"d{n}"]
    body = "@" + NUMBERED + "," + ",".join(ctes) + _join_sql(columns, tables, 3)
    return over("panel", body=body, recursive=True)


@query("w9_dema", _dema_sql())
def double_exponential(spark, sf_dir):
    return recurrences(spark, sf_dir, "DEMA", 3)


def _tema_sql() -> str:
    ctes, columns, tables = [], {}, []
    for n in PERIODS:
        ctes += [
            ema(f"e{n}", "numbered", n),
            chained(f"x{n}", f"e{n}", n),
            ema(f"d{n}", f"x{n}", n),
            chained(f"z{n}", f"d{n}", n),
            ema(f"t{n}", f"z{n}", n),
        ]
        columns[f"TEMA_{n}"] = f"3 * e{n}.y - 3 * d{n}.y + t{n}.y"
        tables += [f"e{n}", f"d{n}", f"t{n}"]
    body = "@" + NUMBERED + "," + ",".join(ctes) + _join_sql(columns, tables, 3)
    return over("panel", body=body, recursive=True)


@query("w10_tema", _tema_sql())
def triple_exponential(spark, sf_dir):
    return recurrences(spark, sf_dir, "TEMA", 3)


def rsi_ctes(n: int) -> str:
    """CTEs p{n}, r{n} with the smoothed gains and losses of q (ticker, date, rn, ch)."""
    return f"""p{n} as (select *, avg(greatest(ch, 0)) over {trailing(n)} as g0,
                          avg(greatest(-ch, 0)) over {trailing(n)} as l0 from q),
            r{n} as (
              select ticker, date, rn, g0 as g, l0 as l from p{n} where rn = {n + 1}
              union all
              select s.ticker, s.date, s.rn, (e.g * {n - 1} + greatest(s.ch, 0)) / {n},
                     (e.l * {n - 1} + greatest(-s.ch, 0)) / {n}
              from r{n} e join p{n} s on s.ticker = e.ticker and s.rn = e.rn + 1)"""


def rsi_value(n: int) -> str:
    return f"case when r{n}.g + r{n}.l = 0 then 0 else 100 * r{n}.g / (r{n}.g + r{n}.l) end"


def _rsi_sql() -> str:
    columns = {f"RSI_{n}": rsi_value(n) for n in PERIODS}
    change = """q as (select ticker, date, rn,
                     x - lag(x) over (partition by ticker order by date) as ch from numbered)"""
    body = "@" + NUMBERED + "," + change + "," + ",".join(rsi_ctes(n) for n in PERIODS)
    return over(
        "panel",
        body=body + _join_sql(columns, [f"r{n}" for n in PERIODS], 6),
        recursive=True,
    )


@query("w11_rsi", _rsi_sql())
def relative_strength(spark, sf_dir):
    return recurrences(spark, sf_dir, "RSI", 6)


@query(
    "w12_apo",
    over(
        "panel",
        body="select ticker, date, "
        + ", ".join(
            f"case when count(close) over {trailing(s)} = {s} then round(avg(close) over "
            f'{trailing(f)} - avg(close) over {trailing(s)}, 6) end as "APO_{f}_{s}"'
            for f, s in PAIRS
        )
        + " from panel",
    ),
)
def price_oscillator(spark, sf_dir):
    names = [f"APO_{f}_{s}" for f, s in PAIRS]
    made = window_indicators(X.landed_closes(spark, sf_dir), periods=(), pairs=PAIRS, kinds=())
    return rounded(made.select("ticker", "date", *names), 6, *names)


def _macd_sql() -> str:
    lengths = sorted({n for pair in PAIRS for n in pair})
    ctes = ",".join(ema(f"e{n}", "numbered", n) for n in lengths)
    columns = {f"MACD_{f}_{s}": f"e{f}.y - e{s}.y" for f, s in PAIRS}
    body = "@" + NUMBERED + "," + ctes + _join_sql(columns, [f"e{n}" for n in lengths], 3)
    return over("panel", body=body, recursive=True)


@query("w13_macd", _macd_sql())
def convergence_line(spark, sf_dir):
    names = [f"MACD_{f}_{s}" for f, s in PAIRS]
    made = recurrence_indicators(X.landed_closes(spark, sf_dir), periods=(), pairs=PAIRS, kinds=())
    return rounded(made.select("ticker", "date", *names), 3, *names)


@query(
    "g1_long_histories",
    """select user_id as ticker, ts as date, value as close from events
       where user_id in (select user_id from events group by 1 having count(*) >= 70)""",
)
def history_filter(spark, sf_dir):
    return long_histories(X.event_series(spark, sf_dir), "ticker", 70)


@query(
    "p2_series_transform",
    over(
        "panel",
        body="""select ticker, date, round(close - max(close) over (partition by ticker
                order by date rows between 9 preceding and current row), 6) as drop_10
                from panel""",
    ),
)
def series_transform(spark, sf_dir):
    made = transform_series(
        X.landed_closes(spark, sf_dir),
        "ticker",
        "date",
        "close",
        lambda x: x - x.rolling(10, min_periods=1).max(),
        "drop_10",
        halo=9,
    )
    return rounded(made.select("ticker", "date", "drop_10"), 6, "drop_10")


@query(
    "p3_series_aggregate",
    over(
        "panel",
        body="""select ticker, date, max(close) over (partition by ticker) as peak,
                min(close) over (partition by ticker) as floor from panel""",
    ),
)
def series_aggregate(spark, sf_dir):
    made = broadcast_aggregate(
        X.landed_closes(spark, sf_dir), ["ticker"], {"peak": F.max("close"), "floor": F.min("close")}
    )
    return made.select("ticker", "date", "peak", "floor")


@query(
    "p3_merged_aggregate",
    over(
        "panel",
        body="""select ticker, count(*) as days, round(exp(avg(ln(close))), 6) as typical, max(close) as peak
                from panel group by ticker""",
    ),
)
def merged_series_aggregate(spark, sf_dir):
    """A user's aggregate with a state that merges: count, geometric mean and peak of every series."""
    made = merged_aggregate(
        X.landed_closes(spark, sf_dir),
        ["ticker"],
        ["close"],
        "days long, typical double, peak double",
        start=lambda: (0, 0.0, -np.inf),
        update=lambda s, x: (s[0] + len(x["close"]), s[1] + np.log(x["close"]).sum(), max(s[2], x["close"].max())),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1], max(a[2], b[2])),
        finish=lambda s: (s[0], float(np.exp(s[1] / s[0])), float(s[2])),
    )
    return rounded(made, 6, "typical")
