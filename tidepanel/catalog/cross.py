"""Cross-sections per date and era, ranks, quantiles, aggregates, splits, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.sql import average_rank, edges, inverse_normal, over
from tidepanel.functions.columns import null_counts
from tidepanel.functions.scalar import rescale
from tidepanel.operators import cross_section as CS
from tidepanel.operators import features as FE
from tidepanel.operators import score as SC
from tidepanel.operators import splits as SP
from tidepanel.operators.neutralize import gram
from tidepanel.plans.panel import series_return
from tidepanel.sources import fixtures as X
from tidepanel.sources.staging import stage

FEATURES = list(X.MATRIX_FEATURES)

PEERS = """@r as (select p.ticker, p.date, close / nullif(lag(close) over
                   (partition by p.ticker order by p.date), 0) - 1 as ret, sector, industry,
                   string_split(bloomberg_ticker, ' ')[2] as country
            from panel p left join ticker_map m on m.ticker = p.ticker
            left join sectors s on s.ticker = m.yahoo)"""


def peers(spark, sf_dir, group):
    mapped = X.ticker_map(spark, sf_dir)
    places = X.sectors(spark, sf_dir).withColumnRenamed("ticker", "yahoo")
    country = F.get(F.split("bloomberg_ticker", " "), F.lit(1)).alias("country")
    table = mapped.join(places, "yahoo", "left").select("ticker", "sector", "industry", country)
    returns = series_return(X.landed_closes(spark, sf_dir), "ticker")
    rows = returns.join(table, "ticker", "left").filter(F.col(group).isNotNull())
    made = CS.peer_means(stage(rows, "returns"), {f"{group}_ret": ["date", group]}, "ret")
    return rounded(made.select("ticker", "date", group, f"{group}_ret"), 9, f"{group}_ret")


def peers_sql(group: str) -> str:
    return over(
        "panel",
        "ticker_map",
        "sectors",
        body=PEERS
        + f""" select ticker, date, {group}, round(avg(ret) over (partition by date, {group}), 9)
               as {group}_ret from r where {group} is not null""",
    )


@query("w14_industry_return", peers_sql("industry"))
def industry_return(spark, sf_dir):
    return peers(spark, sf_dir, "industry")


@query("w15_country_return", peers_sql("country"))
def country_return(spark, sf_dir):
    return peers(spark, sf_dir, "country")


@query("w16_sector_return", peers_sql("sector"))
def sector_return(spark, sf_dir):
    return peers(spark, sf_dir, "sector")


def _weekly(spark, sf_dir):
    week = F.date_trunc("week", "date").cast("date")
    return stage(X.prices(spark, sf_dir).withColumn("week", week), "weekly")


def _quintile_sql(value: str) -> str:
    return (
        f"case when len(e_{value}) > 1 then cast(greatest(len(list_filter(e_{value}, "
        f"lambda v: v < {value})), 1) - 1 as float) end as {value}_quintile"
    )


@query(
    "w17_quintile",
    over(
        "panel",
        body=f"""@w as (select *, cast(date_trunc('week', date) as date) as week from panel),
        e as (select week,
              {edges("close")} as e_close,
              {edges("volume")} as e_volume
              from w group by week)
        select ticker, date, {_quintile_sql("close")}, {_quintile_sql("volume")}
        from w join e using (week)""",
    ),
)
def quintile(spark, sf_dir):
    made = CS.quintiles(_weekly(spark, sf_dir), ["week"], ["close", "volume"])
    return made.select("ticker", "date", "close_quintile", "volume_quintile")


@query(
    "w18_percent_rank",
    over(
        "matrix",
        body=f"""select id, round({average_rank('prediction', 'era')} /
                 count(prediction) over (partition by era), 9) as pct from matrix""",
    ),
)
def percent_rank(spark, sf_dir):
    made = CS.percent_rank(X.matrix(spark, sf_dir), ["era"], "prediction", "pct")
    return rounded(made.select("id", "pct"), 9, "pct")


@query(
    "w18_percent_rank_whole",
    over(
        "matrix",
        body=f"""select id, round({average_rank('prediction')} /
                 count(prediction) over (), 9) as pct from matrix""",
    ),
)
def percent_rank_whole(spark, sf_dir):
    made = CS.percent_rank(X.matrix(spark, sf_dir), [], "prediction", "pct")
    return rounded(made.select("id", "pct"), 9, "pct")


@query(
    "w19_centered_rank",
    over(
        "matrix",
        body=f"""select id, round(({average_rank('price', 'era')} - 0.5) /
                 count(price) over (partition by era), 9) as centered from matrix""",
    ),
)
def centered_rank(spark, sf_dir):
    made = CS.centered_rank(X.matrix(spark, sf_dir), ["era"], "price", "centered")
    return rounded(made.select("id", "centered"), 9, "centered")


@query(
    "w20_era_means",
    over(
        "matrix",
        body="select id, "
        + ", ".join(
            f"round(avg({f}) over (partition by era), 9) as era_mean_{f}" for f in FEATURES
        )
        + " from matrix",
    ),
)
def era_means(spark, sf_dir):
    made = CS.with_group_means(X.matrix(spark, sf_dir), ["era"], FEATURES, "era_mean_")
    names = [f"era_mean_{f}" for f in FEATURES]
    return rounded(made.select("id", *names), 9, *names)


@query(
    "g2_group_means",
    over(
        "matrix",
        body="select era, "
        + ", ".join(f"round(avg({f}), 9) as {f}" for f in FEATURES)
        + " from matrix group by era",
    ),
)
def group_means(spark, sf_dir):
    return rounded(CS.group_means(X.matrix(spark, sf_dir), ["era"], FEATURES), 9, *FEATURES)


@query(
    "g3_mean_std",
    over(
        "matrix",
        body="""select round(avg(prediction), 9) as mean, round(stddev_samp(prediction), 9) as std,
                round(stddev_pop(prediction), 9) as std_pop from matrix""",
    ),
)
def mean_std(spark, sf_dir):
    made = X.matrix(spark, sf_dir).agg(
        F.avg("prediction").alias("mean"),
        F.stddev_samp("prediction").alias("std"),
        F.stddev_pop("prediction").alias("std_pop"),
    )
    return rounded(made, 9, "mean", "std", "std_pop")


@query("g4_distinct_sorted", over("matrix", body="select distinct era from matrix order by era"))
def distinct_sorted(spark, sf_dir):
    return X.matrix(spark, sf_dir).select("era").distinct().orderBy("era")


@query("g5_global_max", over("panel", body="select max(date) as latest, max(close) as top from panel"))
def global_max(spark, sf_dir):
    return X.prices(spark, sf_dir).agg(F.max("date").alias("latest"), F.max("close").alias("top"))


@query(
    "g6_group_quantiles",
    over(
        "panel",
        body="""@w as (select *, cast(date_trunc('week', date) as date) as week from panel),
        e as (select week, quantile_cont(close, [0, 0.2, 0.4, 0.6, 0.8, 1]) as q from w group by 1)
        select week, """
        + ", ".join(f"round(q[{i + 1}], 4) as q{i}" for i in range(6))
        + " from e",
    ),
)
def group_quantiles(spark, sf_dir):
    edges = CS.quantile_edges(_weekly(spark, sf_dir), ["week"], ["close"])
    return edges.select("week", *[F.round(F.col("close")[i], 4).alias(f"q{i}") for i in range(6)])


@query(
    "g7_row_counts",
    over("matrix", body="select data_type, count(*) as n from matrix group by 1"),
)
def row_counts(spark, sf_dir):
    return X.matrix(spark, sf_dir).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g8_null_counts",
    over(
        "matrix",
        body="""select count(*) - count(target) as target,
                count(*) - count(target_late) as target_late,
                count(*) - count(feature_line) as feature_line from matrix""",
    ),
)
def missing_counts(spark, sf_dir):
    return null_counts(X.matrix(spark, sf_dir), ["target", "target_late", "feature_line"])


@query(
    "g9_pearson",
    over(
        "matrix",
        body="select era, round(corr(prediction, price), 9) as corr from matrix group by era",
    ),
)
def pearson(spark, sf_dir):
    made = X.matrix(spark, sf_dir).groupBy("era").agg(F.corr("prediction", "price").alias("corr"))
    return rounded(made, 9, "corr")


def rank_corr_sql(part: str) -> str:
    by = f"partition by {part}" if part else ""
    keys = f"{part}, " if part else ""
    return f"""@c as (
      select *, ({average_rank('price', part)} - 0.5) / count(*) over ({by}) as p,
             target - avg(target) over ({by}) as ct
      from matrix where price is not null and target is not null),
    g as (select *, {inverse_normal('p')} as z from c)
    select {keys} round(corr(sign(z) * pow(abs(z), 1.5), sign(ct) * pow(abs(ct), 1.5)), 9) as corr
    from g {f'group by {part}' if part else ''}"""


@query("g10_rank_correlation", over("matrix", body=rank_corr_sql("era")))
def rank_correlation(spark, sf_dir):
    return rounded(SC.rank_correlation(X.matrix(spark, sf_dir), "price", "target", ["era"]), 9, "corr")


@query("g10_rank_correlation_whole", over("matrix", body=rank_corr_sql("")))
def rank_correlation_whole(spark, sf_dir):
    return rounded(SC.rank_correlation(X.matrix(spark, sf_dir), "price", "target"), 9, "corr")


@query(
    "g11_error_metrics",
    over(
        "matrix",
        body="""select era, round(sqrt(avg(pow(prediction - target, 2))), 9) as rmse,
                round(avg(pow(prediction - target, 2)), 9) as mse,
                round(avg(abs(prediction - target)), 9) as mae from matrix group by era""",
    ),
)
def error_metrics(spark, sf_dir):
    made = SC.error_metrics(X.matrix(spark, sf_dir), "prediction", "target", ["era"])
    return rounded(made, 9, "rmse", "mse", "mae")


def gram_sql(columns: list[str], source: str = "matrix") -> str:
    cells = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    made = ", ".join(f"round(covar_pop({columns[i]}, {columns[j]}) * count(*), 6) as c{i}_{j}" for i, j in cells)
    return f"select era, count(*) as n, {made} from {source} group by era"


def gram_cells(df, columns):
    k = len(columns)
    made = [F.round(F.col("_gram")[i * k + j], 6).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    return gram(df, columns, ["era"]).select("era", F.col("_n").alias("n"), *made)


GRAM_COLUMNS = [*X.MATRIX_FEATURES, "prediction"]


@query("g12_gram", over("matrix", body=gram_sql(GRAM_COLUMNS)))
def gram_matrix(spark, sf_dir):
    """All products of the features and the score, per era."""
    return gram_cells(X.matrix(spark, sf_dir), GRAM_COLUMNS)


#: Columns of a wide matrix, whose products take the path of many columns.
WIDE_COLUMNS = 20


@query(
    "g12_wide_gram",
    over(
        "matrix",
        body="@s as (select era, "
        + ", ".join(f"sin(price * {i + 1}) + {i} * feature_line as v{i}" for i in range(WIDE_COLUMNS))
        + " from matrix) "
        + gram_sql([f"v{i}" for i in range(WIDE_COLUMNS)], "s"),
    ),
)
def wide_gram_matrix(spark, sf_dir):
    """All products of twenty columns, per era."""
    rows = X.matrix(spark, sf_dir)
    made = [(F.sin(F.col("price") * (i + 1)) + i * F.col("feature_line")).alias(f"v{i}") for i in range(WIDE_COLUMNS)]
    return gram_cells(rows.select("era", *made), [f"v{i}" for i in range(WIDE_COLUMNS)])


@query(
    "m8_ranked_range",
    over(
        "matrix",
        body=f"""select id, round({average_rank('prediction', 'era')} /
                 count(prediction) over (partition by era) * 0.998 + 0.001, 9) as scaled
                 from matrix""",
    ),
)
def ranked_range(spark, sf_dir):
    made = CS.percent_rank(X.matrix(spark, sf_dir), ["era"], "prediction", "pct")
    return made.select("id", F.round(rescale(F.col("pct")), 9).alias("scaled"))


@query(
    "m15_center",
    over("matrix", body="select id, round(prediction - avg(prediction) over (partition by era), 9) as centered from matrix"),
)
def center(spark, sf_dir):
    made = SC.center(X.matrix(spark, sf_dir), "prediction", ["era"])
    return made.select("id", F.round("prediction", 9).alias("centered"))


@query(
    "t1_top_k",
    """select o_orderkey, o_totalprice from orders
       order by o_totalprice desc, o_orderkey limit 50""",
)
def top_k(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return FE.top_by(orders, "o_totalprice", "o_orderkey", 50)


CANDIDATES = [*FEATURES, "price", "prediction"]


def importances(spark, sf_dir):
    """Absolute correlation of each column with the target, one aggregate."""
    matrix = X.matrix(spark, sf_dir)
    return matrix.agg(*[F.abs(F.corr(c, "target_late")).alias(c) for c in CANDIDATES]).first()


@query(
    "t2_restricted_top_k",
    over(
        "matrix",
        body="@i as ("
        + " union all ".join(
            f"select '{c}' as name, round(abs(corr({c}, target_late)), 9) as weight from matrix"
            for c in CANDIDATES
        )
        + ") select name, weight from (select * from i order by weight desc, name limit 50) "
        "where name like 'feature%' order by weight desc, name limit 3",
    ),
)
def restricted_top_k(spark, sf_dir):
    found = importances(spark, sf_dir).asDict()
    weights = {c: round(found[c], 9) for c in CANDIDATES}
    chosen = FE.choose_factors(FEATURES, weights, k=3)
    return spark.createDataFrame([(c, weights[c]) for c in chosen], "name string, weight double")


@query(
    "t3_last_eras",
    over("matrix", body="select distinct era from matrix order by era desc limit 3"),
)
def last_eras(spark, sf_dir):
    return SP.last_eras(X.matrix(spark, sf_dir), "era", 3)


@query(
    "t4_uniform_sample",
    over("matrix", body="select id, era, target from matrix order by md5('42' || chr(31) || id), id limit 5000"),
)
def uniform_sample(spark, sf_dir):
    return FE.hashed_sample(X.matrix(spark, sf_dir).select("id", "era", "target"), ["id"], 5000)


@query(
    "d1_chronological_split",
    over(
        "panel",
        body="""select ticker, date, case when row_number() over (order by date, ticker) <=
                count(*) over () - ceil(0.3 * count(*) over ()) then 'train' else 'test' end as part
                from panel""",
    ),
)
def chronological_split(spark, sf_dir):
    rows = stage(X.closes(spark, sf_dir).select("ticker", "date"), "rows")
    return SP.chronological_split(rows, "date", "ticker")


FOLDS = """@e as (select distinct era from matrix),
  n as (select era, row_number() over (order by era desc) as back from e),
  f as (select era, cast(fold as int) as fold,
               case when back <= case when fold = 4 then 3 else 3 * (fold + 1) end
                    then 'validation' else 'train' end as role
        from n, range(5) r(fold))"""


@query("d2_era_folds", over("matrix", body=FOLDS + " select era, fold, role from f"))
def era_folds(spark, sf_dir):
    return SP.era_folds(X.matrix(spark, sf_dir))


@query(
    "d2_fold_roles",
    over(
        "matrix",
        body=FOLDS
        + """ select id, r.roles from matrix join (select era, string_agg(role, ',' order by fold)
              as roles from f group by era) r using (era)""",
    ),
)
def fold_roles(spark, sf_dir):
    made = SP.with_fold_roles(X.matrix(spark, sf_dir).select("id", "era"))
    return made.select("id", F.concat_ws(",", "roles").alias("roles"))


@query(
    "d3_label_split",
    over("matrix", body="select id, data_type from matrix where data_type in ('train', 'validation')"),
)
def label_split(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "data_type")
    return SP.by_label(rows, "data_type", "train").unionByName(
        SP.by_label(rows, "data_type", "validation")
    )


@query("u3_distinct_keys", "select distinct o_custkey from orders")
def distinct_keys(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select("o_custkey").distinct()
