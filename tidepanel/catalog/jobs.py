"""The composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.cross import rank_corr_sql
from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.series import rsi_ctes, rsi_value
from tidepanel.catalog.sql import CANONICAL, average_rank, chained, edges, ema, over, trailing
from tidepanel.catalog.fits import STOPPED, parts, residual_sql
from tidepanel.functions.scalar import canonical_ticker
from tidepanel.operators.cross_section import percent_rank, quintiles
from tidepanel.operators.indicators import PAIRS, PERIODS, trima_lengths, window_indicators
from tidepanel.operators.neutralize import neutralize_full, neutralize_partial
from tidepanel.operators.recurrence import RECURRENCE_KINDS
from tidepanel.operators.score import era_scores, ranked_range
from tidepanel.plans import panel as P
from tidepanel.plans import tournament as T
from tidepanel.sources import fixtures as X
from tidepanel.sources.frames import read_importance
from tidepanel.sources.staging import stage, staging_path

FEATURES = list(X.MATRIX_FEATURES)

def quintile_of(column: str, edges: str) -> str:
    return (
        f"case when len({edges}) > 1 then cast(greatest(len(list_filter({edges}, "
        f'lambda v: v < "{column}")), 1) - 1 as float) end as "{column}_quintile"'
    )


def edges_of(column: str) -> str:
    return edges(f'"{column}"') + f' as "e_{column}"'


def windows_sql(kinds: list[str]) -> str:
    n, w, s = 20, trailing(20), trailing(40)
    made = {
        "SMA_20": f"case when count(close) over {w} = {n} then avg(close) over {w} end",
        "VOLATILITY_20": f"case when count(ret) over {w} = {n} then stddev_samp(ret) over {w} end",
        "SR_20": f"case when count(ret) over {w} = {n} then avg(ret) over {w} / "
        f"nullif(stddev_samp(ret) over {w}, 0) end",
        "MOM_20": "close - lag(close, 20) over (partition by ticker order by date)",
        "APO_20_40": f"case when count(close) over {s} = 40 then avg(close) over {w} "
        f"- avg(close) over {s} end",
    }
    return ", ".join(f'{made[k]} as "{k}"' for k in kinds)


@query(
    "momentum_by_week",
    over(
        "panel",
        body=f"""@r as (select ticker, date, close, close / nullif(lag(close) over
                   (partition by ticker order by date), 0) - 1 as ret from panel),
        i as (select ticker, date, {windows_sql(["SMA_20", "VOLATILITY_20", "MOM_20"])} from r),
        k as (select *, cast(date_trunc('week', date) as date) as week from i
              where "SMA_20" is not null and "VOLATILITY_20" is not null and "MOM_20" is not null),
        e as (select week, {edges_of("MOM_20")}, {edges_of("VOLATILITY_20")} from k group by week)
        select ticker, date, week, {quintile_of("MOM_20", 'e."e_MOM_20"')},
               {quintile_of("VOLATILITY_20", 'e."e_VOLATILITY_20"')}
        from k join e using (week)""",
    ),
)
def momentum_by_week(spark, sf_dir):
    """Which quintile each ticker's 20-bar momentum and volatility were in, each week."""
    made = window_indicators(
        X.landed_closes(spark, sf_dir), periods=(20,), pairs=(), kinds=("SMA", "VOLATILITY", "MOM")
    )
    kept = made.dropna("any", subset=["SMA_20", "VOLATILITY_20", "MOM_20"])
    weekly = stage(kept.withColumn("week", F.date_trunc("week", "date").cast("date")), "weekly")
    return quintiles(weekly, ["week"], ["MOM_20", "VOLATILITY_20"]).select(
        "ticker", "date", "week", "MOM_20_quintile", "VOLATILITY_20_quintile"
    )


def indicator_ctes(kinds: tuple[str, ...], apo: bool) -> tuple[str, list[str]]:
    """CTEs from numbered (ticker, date, rn, x) to made (ticker, date, x and every indicator); the names.

    ``kinds`` are the recurrences. Warm-ups follow from the joins and from the counts of the frames.
    """
    lengths = sorted({*PERIODS, *[n for pair in PAIRS for n in pair]})
    ctes = [ema(f"e{n}", "numbered", n) for n in lengths]
    columns, tables = {}, [f"e{n}" for n in lengths]
    for n in PERIODS:
        if "EMA" in kinds:
            columns[f"EMA_{n}"] = f"e{n}.y"
        if "DEMA" in kinds:
            ctes += [chained(f"x{n}", f"e{n}", n), ema(f"d{n}", f"x{n}", n)]
            columns[f"DEMA_{n}"] = f"2 * e{n}.y - d{n}.y"
            tables.append(f"d{n}")
        if "TEMA" in kinds:
            ctes += [chained(f"z{n}", f"d{n}", n), ema(f"t{n}", f"z{n}", n)]
            columns[f"TEMA_{n}"] = f"3 * e{n}.y - 3 * d{n}.y + t{n}.y"
            tables.append(f"t{n}")
        if "RSI" in kinds:
            ctes += [rsi_ctes(n)]
            columns[f"RSI_{n}"] = rsi_value(n)
            tables.append(f"r{n}")
        short, rest = trima_lengths(n)
        w = trailing(n)
        columns |= {
            f"SMA_{n}": f"case when count(p.x) over {w} = {n} then avg(p.x) over {w} end",
            f"VOLATILITY_{n}": f"case when count(p.ret) over {w} = {n} then stddev_samp(p.ret) over {w} end",
            f"SR_{n}": f"case when count(p.ret) over {w} = {n} then avg(p.ret) over {w} / nullif(stddev_samp(p.ret) over {w}, 0) end",
            f"MOM_{n}": f"p.x - lag(p.x, {n}) over (partition by p.ticker order by p.date)",
            f"TRIMA_{n}": f"case when count(p.inner_{n}) over {trailing(rest)} = {rest} then avg(p.inner_{n}) over {trailing(rest)} end",
            f"WMA_{n}": f"case when count(p.x) over {w} = {n} then (sum(p.rn * p.x) over {w} - (p.rn - {n}) * sum(p.x) over {w})"
            f" / {n * (n + 1) // 2}.0::double end",
        }
    for f, s in PAIRS:
        columns[f"MACD_{f}_{s}"] = f"e{f}.y - e{s}.y"
        if apo:
            columns[f"APO_{f}_{s}"] = (
                f"case when count(p.x) over {trailing(s)} = {s} then avg(p.x) over {trailing(f)} - avg(p.x) over {trailing(s)} end"
            )
    inner = ", ".join(
        f"case when count(x) over {trailing(trima_lengths(n)[0])} = {trima_lengths(n)[0]} "
        f"then avg(x) over {trailing(trima_lengths(n)[0])} end as inner_{n}"
        for n in PERIODS
    )
    joins = " ".join(f"left join {t} on {t}.ticker = p.ticker and {t}.date = p.date" for t in tables)
    made = ", ".join(f'{expr.replace("partition by ticker order by date", "partition by p.ticker order by p.date")} as "{name}"' for name, expr in columns.items())
    ctes += [
        f"p as (select *, x / nullif(lag(x) over (partition by ticker order by date), 0) - 1 as ret, {inner} from numbered)",
        f"made as (select p.ticker, p.date, p.x, {made} from p {joins})",
    ]
    return ", ".join(["q as (select ticker, date, rn, x - lag(x) over (partition by ticker order by date) as ch from numbered)", *ctes]), list(columns)


EQUITY_CTES, EQUITY_INDICATORS = indicator_ctes(RECURRENCE_KINDS, apo=True)
EQUITY_NUMBERS = [*EQUITY_INDICATORS, "industry_ret", "country_ret", "sector_ret"]


def equity_ctes() -> str:
    complete = " and ".join(f'"{c}" is not null' for c in EQUITY_NUMBERS)
    warm = " and ".join(f'"{c}" is not null' for c in EQUITY_INDICATORS)
    return f"""@names as (select ticker, bloomberg_ticker, yahoo, {CANONICAL} as canonical_ticker
      from ticker_map),
    numbered as (select p.ticker, p.date, close as x,
                 row_number() over (partition by p.ticker order by p.date) as rn
                 from panel p join names n on n.ticker = p.ticker
                 where close > 0 and canonical_ticker is not null and bloomberg_ticker is not null),
    {EQUITY_CTES},
    i as (select made.*, x as close, bloomberg_ticker, canonical_ticker from made join names using (ticker)),
    kept as (select *, string_split(bloomberg_ticker, ' ')[2] as country_name,
             close / nullif(lag(close) over (partition by ticker order by date), 0) - 1 as ret
             from i where {warm}),
    places as (select n.bloomberg_ticker, sector as sector_name, industry as industry_name
               from sectors s join names n on n.yahoo = s.ticker
               where n.bloomberg_ticker is not null),
    coded as (select bloomberg_ticker, dense_rank() over (order by sector_name) - 1 as s0,
                     dense_rank() over (order by industry_name) - 1 as i0 from places),
    j as (select kept.* exclude (country_name), s0, i0,
                 cast(dense_rank() over (order by country_name) - 1 as int) as country
          from kept left join coded using (bloomberg_ticker)),
    filled as (select * exclude (s0, i0),
                      cast(coalesce(s0, max(s0) over () + 1) as int) as sector,
                      cast(coalesce(i0, max(i0) over () + 1) as int) as industry from j),
    peers as (select *, avg(ret) over (partition by date, industry) as industry_ret,
                     avg(ret) over (partition by date, country) as country_ret,
                     avg(ret) over (partition by date, sector) as sector_ret from filled),
    ready as (select * from peers where {complete}),
    edges as (select date, {", ".join(edges_of(c) for c in EQUITY_NUMBERS)} from ready group by date),
    features as (select date, ticker, canonical_ticker, country, sector, industry,
                 {", ".join(quintile_of(c, f'edges."e_{c}"') for c in EQUITY_NUMBERS)}
                 from ready join edges using (date) where ret is not null),
    final as (select * from features where
              {" and ".join(f'"{c}_quintile" is not null' for c in EQUITY_NUMBERS)})"""


EQUITY_VIEWS = ("panel", "ticker_map", "sectors")


def equity_table(spark, sf_dir, closes=None):
    """All 36 indicators and 39 quintiles."""
    closes = X.landed_closes(spark, sf_dir) if closes is None else closes
    return P.equity_features(closes, X.ticker_map(spark, sf_dir), X.sectors(spark, sf_dir))


@query(
    "q1_equity_features",
    over(*EQUITY_VIEWS, body=equity_ctes() + " select * from final", recursive=True),
)
def equity_features(spark, sf_dir):
    """The codes and all 39 quintiles of every ticker and date."""
    made = [f"{c}_quintile" for c in EQUITY_NUMBERS]
    codes = ["date", "ticker", "canonical_ticker", "country", "sector", "industry"]
    return equity_table(spark, sf_dir).select(*codes, *made)


def _set_sql() -> str:
    names = ", ".join(f'"{c}_quintile"' for c in EQUITY_NUMBERS)
    return f"""{equity_ctes()},
    named as (select date, canonical_ticker, target from targets join names using (ticker)
              where canonical_ticker is not null),
    nearest as (select canonical_ticker, max(f.date) as found from final f
                where f.date between date '2001-11-04' - 9 and date '2001-11-04' group by 1)
    select case when f.date < date '2000-01-01' then 'train' else 'validation' end as part,
           f.date, f.canonical_ticker, cast(null as int) as days_back, target, {names}
    from final f join named n on n.date = f.date and n.canonical_ticker = f.canonical_ticker
    where target is not null
    union all
    select 'live', date '2001-11-04', f.canonical_ticker,
           cast(date '2001-11-04' - f.date as int), cast(null as double), {names}
    from final f join nearest n on n.canonical_ticker = f.canonical_ticker and n.found = f.date"""


def _equity_sets(spark, sf_dir):
    """Train, validation and live rows of the feature table, with all its quintiles."""
    closes = X.landed_closes(spark, sf_dir)
    features = equity_table(spark, sf_dir, closes)
    ticker = canonical_ticker(F.col("bloomberg_ticker"))
    names = X.ticker_map(spark, sf_dir).select("ticker", ticker.alias("canonical_ticker")).dropna()
    table = stage(X.targets(spark, sf_dir, closes).join(names, "ticker").drop("ticker"), "targets")
    cut = F.lit(X.VALIDATION_FROM).cast("date")
    live = X.live_universe(spark, sf_dir).join(names, "ticker").drop("ticker")
    made = [c for c in features.columns if c.endswith("_quintile")]
    # The indicators themselves are not part of the sets, so they are not written with them.
    features = features.select("date", "canonical_ticker", *P.CATEGORIES, *made)
    train, validation, today = P.equity_sets(
        features,
        table.filter(F.col("date") < cut),
        table.filter(F.col("date") >= cut),
        live,
    )

    def marked(df, part, *more):
        return df.select(F.lit(part).alias("part"), "date", "canonical_ticker", *more, *made)

    none = F.lit(None).cast("int").alias("days_back")
    return (
        marked(train, "train", none, "target")
        .unionByName(marked(validation, "validation", none, "target"))
        .unionByName(
            marked(today, "live", "days_back", F.lit(None).cast("double").alias("target"))
        )
    )


@query("q2_equity_sets", over(*EQUITY_VIEWS, "targets", body=_set_sql(), recursive=True))
def equity_sets(spark, sf_dir):
    """The sets of all 39 quintiles."""
    return _equity_sets(spark, sf_dir)


# The names under which the whole jobs were registered while the ones above did part of them.
query("q1_equity_features_full")(equity_table)
query("q2_equity_sets_full")(equity_sets)


CRYPTO_CTES, CRYPTO_NUMBERS = indicator_ctes(P.CRYPTO_KINDS, apo=False)


def _crypto_sql() -> str:
    warm = " and ".join(f'"{c}" is not null' for c in CRYPTO_NUMBERS)
    names = ", ".join(f'"{c}_quintile"' for c in CRYPTO_NUMBERS)
    complete = " and ".join(f'"{c}_quintile" is not null' for c in CRYPTO_NUMBERS)
    return f"""@numbered as (select ticker, date, close as x,
                 row_number() over (partition by ticker order by date) as rn from panel
                 where ticker in (select ticker from panel group by 1 having count(*) >= 160)),
    {CRYPTO_CTES},
    i as (select * from made),
    kept as (select * from i where {warm}),
    edges as (select date, {", ".join(edges_of(c) for c in CRYPTO_NUMBERS)} from kept group by 1),
    features as (select date, ticker,
                 {", ".join(quintile_of(c, f'edges."e_{c}"') for c in CRYPTO_NUMBERS)}
                 from kept join edges using (date)),
    placed as (select f.*, target, row_number() over (order by f.date, f.ticker) as rn,
                      count(*) over () as n from features f
               left join targets t on t.ticker = f.ticker and t.date = f.date)
    select case when rn <= n - ceil(0.3 * n) then 'train' else 'validation' end as part,
           date, ticker as symbol, target, {names} from placed
    where target is not null and {complete}
    union all
    select 'live', date, ticker, target, {names} from placed
    where date = (select max(date) from placed)"""


def _crypto_sets(features):
    """Train, validation and live rows of a feature table, with all its quintiles."""
    made = [c for c in features.columns if c.endswith("_quintile")]
    columns = ["date", "symbol", "target", *made]
    # The indicators themselves are not part of the sets, so they are not written with them.
    train, validation, live = P.crypto_sets(features.select(*columns))

    def marked(df, part):
        return df.select(F.lit(part).alias("part"), *columns)

    return (
        marked(train, "train")
        .unionByName(marked(validation, "validation"))
        .unionByName(marked(live, "live"))
    )


def crypto_table(spark, sf_dir):
    """All 30 indicators and quintiles of every symbol with the default length of history."""
    closes = X.landed_closes(spark, sf_dir)
    table = X.targets(spark, sf_dir, closes).withColumnRenamed("ticker", "symbol")
    return P.crypto_features(closes.withColumnRenamed("ticker", "symbol"), table)


@query("q3_crypto_sets", over("panel", "targets", body=_crypto_sql(), recursive=True))
def crypto_sets(spark, sf_dir):
    """The sets of all 30 quintiles."""
    return _crypto_sets(crypto_table(spark, sf_dir))


query("q3_crypto_features_full")(crypto_table)
query("q3_crypto_sets_full")(crypto_sets)


@query(
    "q4_neutral_rank",
    residual_sql("", 1.0, True, True)
    .replace("select id, round(r / stddev_samp(r) over (), 6) as prediction from r",
             ", v as (select id, round(r / stddev_samp(r) over (), 6) as v from r) "
             f"select id, round({average_rank('v')} / count(*) over (), 9) as prediction from v"),
)
def neutral_rank(spark, sf_dir):
    """Neutralize fully, then rank; scores are rounded first so that ties agree."""
    rows = X.matrix(spark, sf_dir).select("id", "prediction", *FEATURES)
    neutral = stage(rounded(neutralize_full(rows).select("id", "prediction"), 6, "prediction"), "n")
    ranked = percent_rank(neutral, [], "prediction", "pct")
    return ranked.select("id", F.round("pct", 9).alias("prediction"))


query("q4_neutral_rank_all")(neutral_rank)


def _reference_sql(final: str) -> str:
    """Partial neutralization at 0.5 matched to order prices, then ``final`` over column m."""
    tail = "select id, round(r, 6) as prediction from r"
    return residual_sql("", 0.5, False, False).replace(
        tail,
        """, m as (select id, (r - avg(r) over ()) / stddev_samp(r) over () * s + a as m
             from r, (select
             avg(o_totalprice / 1000) as a, stddev_samp(o_totalprice / 1000) as s from orders)) """
        + final,
    )


@query(
    "q6_sigmoid_range",
    _reference_sql(
        """select id, round(least(greatest(1 / (1 + exp(-(m - avg(m) over ()) /
           stddev_pop(m) over ())), 0.001), 0.999), 6) as prediction from m"""
    ),
)
def sigmoid_range(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "prediction", *FEATURES)
    reference = X.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") / 1000).alias("prediction")
    )
    return rounded(T.sigmoid_scores(rows, FEATURES, reference), 6, "prediction").select(
        "id", "prediction"
    )


query("q6_sigmoid_range_all")(sigmoid_range)


@query(
    "q5_robust_range",
    residual_sql("", 0.6, False, False).replace(
        "select id, round(r, 6) as prediction from r",
        ", v as (select id, round(r, 6) as v from r) "
        f"select id, round({average_rank('v')} / count(*) over () * 0.998 + 0.001, 9) "
        "as prediction from v",
    ),
)
def robust_range(spark, sf_dir):
    """Post-processing of the robust score; the match to a reference keeps the ranks."""
    rows = X.matrix(spark, sf_dir).select("id", "prediction", *FEATURES)
    neutral = neutralize_partial(rows, ["prediction"], FEATURES, 0.6).select("id", "prediction")
    steady = stage(rounded(neutral, 6, "prediction"), "neutral")
    return rounded(ranked_range(steady, "prediction"), 9, "prediction")


query("q5_robust_range_all")(robust_range)


def reference(spark, sf_dir):
    """Reference predictions: order prices scaled into (0, 1)."""
    return X.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") / 500000).alias("prediction")
    )


@query("q4_tournament_score")
def tournament_score(spark, sf_dir):
    train, validation, test = parts(spark, sf_dir)
    return T.tournament_score(train, test, FEATURES, validation=validation)


def importance_file(spark, sf_dir):
    """Weights of the features as a file and read back: their correlation with the late target."""
    weights = X.matrix(spark, sf_dir).agg(*[F.abs(F.corr(c, "target_late")).alias(c) for c in FEATURES])
    path = staging_path(spark, "importance")
    weights.select(F.to_json(F.struct(*FEATURES)).alias("value")).coalesce(1).write.text(path)
    return read_importance(spark, path)


@query("q5_robust_score")
def robust_score(spark, sf_dir):
    """With the importance file, and the twenty most important of the engineered features."""
    train, _, test = parts(spark, sf_dir)
    weights = importance_file(spark, sf_dir)
    return T.robust_score(train, test, FEATURES, reference(spark, sf_dir), importance=weights, most=20)


@query("q6_sigmoid_score")
def sigmoid_score(spark, sf_dir):
    train, validation, test = parts(spark, sf_dir)
    weights = importance_file(spark, sf_dir)
    return T.sigmoid_score(
        train, test, FEATURES, reference(spark, sf_dir), validation=validation, importance=weights, **STOPPED
    )


def _scored_parts(live, validation, key):
    none = F.lit(None).cast("date").alias("date")
    live = live.select(F.lit("live").alias("part"), key, none, "signal")
    return live.unionByName(validation.select(F.lit("validation").alias("part"), key, "date", "signal"))


def _panel_parts(sets):
    return (sets.filter(F.col("part") == p).drop("part") for p in ("train", "validation", "live"))


def _equity_scores(spark, sf_dir, **how):
    sets = stage(_equity_sets(spark, sf_dir), "sets")
    names = [c for c in sets.columns if c.endswith("_quintile")]
    train, validation, live = _panel_parts(sets)
    return _scored_parts(*P.panel_scores(train, validation, live, names, "canonical_ticker", **how), "canonical_ticker")


def _crypto_scores(spark, sf_dir, **how):
    sets = stage(_crypto_sets(crypto_table(spark, sf_dir)), "sets")
    names = [c for c in sets.columns if c.endswith("_quintile")]
    train, validation, live = _panel_parts(sets)
    return _scored_parts(*P.panel_scores(train, validation, live, names, "symbol", **how), "symbol")


@query("q2_equity_submission")
def equity_submission(spark, sf_dir):
    """The equity job to its end: signals of the live rows and of the validation set."""
    return _equity_scores(spark, sf_dir)


@query("q3_crypto_submission")
def crypto_submission(spark, sf_dir):
    """The crypto job to its end."""
    return _crypto_scores(spark, sf_dir)


def _signals(scored, key):
    """Rows, keys and whether every signal is a rank, by part."""
    inside = F.coalesce(F.col("signal").between(0, 1) & (F.col("signal") > 0), F.lit(False))
    made = scored.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"), F.bool_and(inside).alias("ranks"))
    return made.select("part", "rows", "keys", "ranks")


def _signals_sql(sql: str, key: str) -> str:
    """Of the SQL of the sets: rows and keys of what is scored."""
    head, tail = sql.rsplit("select case when", 1)
    return f"""{head.rstrip()}, sets as (select case when{tail})
    select part, count(*) as rows, count(distinct {key}) as keys, true as ranks from sets where part <> 'train' group by part"""


@query("q2_equity_ranks", over(*EQUITY_VIEWS, "targets", body=_signals_sql(_set_sql(), "canonical_ticker"), recursive=True))
def equity_ranks(spark, sf_dir):
    """The second equity job's end: ranks of the predictions; few rounds, checked by counts."""
    return _signals(_equity_scores(spark, sf_dir, ranks=True, maxIter=5), "canonical_ticker")


@query("q3_crypto_ranks", over("panel", "targets", body=_signals_sql(_crypto_sql(), "symbol"), recursive=True))
def crypto_ranks(spark, sf_dir):
    return _signals(_crypto_scores(spark, sf_dir, ranks=True, maxIter=5), "symbol")


@query(
    "q7_era_scores",
    over(
        "matrix",
        body=rank_corr_sql("era").replace("select era,", ", s as (select era,", 1)
        + ") select round(avg(corr), 6) as mean_corr, round(stddev_samp(corr), 6) as std_corr, "
        "count(corr) as eras from s",
    ),
)
def eras(spark, sf_dir):
    _, summary = era_scores(X.matrix(spark, sf_dir), "price", "target")
    return rounded(summary, 6, "mean_corr", "std_corr")
