"""Joins, lookups, set operations, category codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.sql import over
from tidepanel.operators import lookup as LK
from tidepanel.operators.asof import latest_within
from tidepanel.operators.cross_section import with_group_means
from tidepanel.operators.score import match_distribution
from tidepanel.sources import fixtures as X
from tidepanel.sources.staging import stage

SPLIT_DATE = "2000-01-01"


@query(
    "j1_left_join",
    over(
        "panel",
        "targets",
        body="""select p.ticker, p.date, close, target from panel p
                left join (select * from targets where date >= date '2000-01-01') t
                on t.date = p.date and t.ticker = p.ticker""",
    ),
)
def left_join(spark, sf_dir):
    late = X.targets(spark, sf_dir).filter(F.col("date") >= F.lit(SPLIT_DATE).cast("date"))
    return X.closes(spark, sf_dir).join(late, ["date", "ticker"], "left").select(
        "ticker", "date", "close", "target"
    )


@query(
    "j2_inner_join",
    over(
        "panel",
        "targets",
        body="""select ticker, date, close, target from panel join targets using (ticker, date)
                where date < date '2000-01-01' and target is not null""",
    ),
)
def inner_join(spark, sf_dir):
    early = X.targets(spark, sf_dir).filter(F.col("date") < F.lit(SPLIT_DATE).cast("date"))
    known = early.filter(F.col("target").isNotNull())
    return X.closes(spark, sf_dir).join(known, ["date", "ticker"]).select(
        "ticker", "date", "close", "target"
    )


@query(
    "j3_dictionary_join",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, m.o_totalprice as last_price
       from lineitem left join (
         select o_custkey, arg_max(o_totalprice, o_orderkey) as o_totalprice from orders group by 1
       ) m on m.o_custkey = l_partkey""",
)
def dictionary_join(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    orders = X.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("l_partkey"), F.col("o_totalprice").alias("last_price"), "o_orderkey"
    )
    return LK.map_values(rows, orders, "l_partkey", ["last_price"], "o_orderkey")


@query(
    "j4_fan_out_join",
    """with places as (
         select n_nationkey as c_nationkey, n_name as place from nation where n_nationkey % 7 <> 3
         union all
         select n_nationkey, upper(n_name) || ' 2' from nation where n_nationkey % 5 = 0)
       select c_custkey, c_nationkey, place from customer left join places using (c_nationkey)""",
)
def fan_out_join(spark, sf_dir):
    """A lookup in which some keys have two rows and some none."""
    nation = X.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    once = nation.filter("c_nationkey % 7 <> 3").select("c_nationkey", F.col("n_name").alias("place"))
    twice = nation.filter("c_nationkey % 5 = 0")
    twice = twice.select("c_nationkey", F.concat(F.upper("n_name"), F.lit(" 2")).alias("place"))
    places = once.unionByName(twice)
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return LK.dimension_join(rows, places, "c_nationkey")


@query(
    "j5_group_statistic",
    over(
        "matrix",
        body="""select id, round(avg(feature_line) over (partition by era), 9) as era_line,
                round(avg(prediction) over (partition by era), 9) as era_prediction from matrix""",
    ),
)
def group_statistic(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "era", "feature_line", "prediction")
    made = with_group_means(rows, ["era"], ["feature_line", "prediction"], "era_")
    return made.select(
        "id",
        F.round("era_feature_line", 9).alias("era_line"),
        F.round("era_prediction", 9).alias("era_prediction"),
    )


def asof_sql(live_date: str) -> str:
    return over(
        "panel",
        body=f"""select s_suppkey as ticker, date '{live_date}' as date,
                 cast(date '{live_date}' - max(p.date) as int) as days_back,
                 max(p.date) as found_date, arg_max(close, p.date) as close
                 from supplier join panel p on p.ticker = s_suppkey
                  and p.date between date '{live_date}' - 9 and date '{live_date}'
                 group by s_suppkey""",
    )


@query("j6_asof_fill", asof_sql("2001-11-04"))
def asof_fill(spark, sf_dir):
    return latest_within(X.live_universe(spark, sf_dir), X.closes(spark, sf_dir), "ticker")


@query("j6_asof_fill_midway", asof_sql("1998-05-26"))
def asof_fill_midway(spark, sf_dir):
    live = X.live_universe(spark, sf_dir, "1998-05-26")
    return latest_within(live, X.closes(spark, sf_dir), "ticker")


@query(
    "j6_asof_every_order",
    over(
        "panel",
        body="""@o as (select o_custkey % (select count(*) from supplier) as ticker,
                       cast(o_orderdate as date) as date, count(*) as n
                       from orders group by 1, 2)
                select o.ticker, o.date, o.n, cast(o.date - max(p.date) as int) as days_back,
                       max(p.date) as found_date, arg_max(p.close, p.date) as close
                from o join panel p on p.ticker = o.ticker and p.date between o.date - 9 and o.date
                group by 1, 2, 3""",
    ),
)
def asof_every_order(spark, sf_dir):
    suppliers = X.table(spark, sf_dir, "supplier").count()
    live = (
        X.table(spark, sf_dir, "orders")
        .groupBy(
            (F.col("o_custkey") % suppliers).alias("ticker"),
            F.col("o_orderdate").cast("date").alias("date"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return latest_within(live, X.closes(spark, sf_dir), "ticker")


@query(
    "j7_semi_join",
    """select c_custkey, c_mktsegment from customer
       where c_custkey in (select o_custkey from orders where o_totalprice > 300000)""",
)
def semi_join(spark, sf_dir):
    big = X.table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000)
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return rows.join(big.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


def missing_keys(spark, sf_dir):
    """Live tickers with no row on the live date."""
    live = X.live_universe(spark, sf_dir)
    return live.join(X.closes(spark, sf_dir), ["ticker", "date"], "left_anti").select("ticker")


MISSING = over(
    "panel",
    body="""select s_suppkey as ticker from supplier where s_suppkey not in
            (select ticker from panel where date = date '2001-11-04')""",
)


@query("j8_anti_join", MISSING)
def anti_join(spark, sf_dir):
    return missing_keys(spark, sf_dir)


@query("u2_key_difference", MISSING)
def key_difference(spark, sf_dir):
    day = X.closes(spark, sf_dir).filter(F.col("date") == F.lit(X.LIVE_DATE).cast("date"))
    return X.live_universe(spark, sf_dir).select("ticker").subtract(day.select("ticker"))


@query(
    "j9_scalar_cross_join",
    over(
        "matrix",
        body="""select id, round((price - m) / s, 9) as unit from matrix,
                (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders)""",
    ),
)
def scalar_cross_join(spark, sf_dir):
    scalar = X.table(spark, sf_dir, "orders").agg(
        F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s")
    )
    rows = X.matrix(spark, sf_dir).select("id", "price").crossJoin(F.broadcast(scalar))  # one row
    return rows.select("id", F.round((F.col("price") - F.col("m")) / F.col("s"), 9).alias("unit"))


@query(
    "j10_concat_on_id",
    over("matrix", body="select id, feature_line, round(prediction, 6) as prediction from matrix"),
)
def concat_on_id(spark, sf_dir):
    matrix = X.matrix(spark, sf_dir)
    scores = stage(rounded(matrix.select("id", "prediction"), 6, "prediction"), "scores")
    return matrix.select("id", "feature_line").join(scores, "id")


@query(
    "u1_union_by_name",
    over(
        "panel",
        body="""select ticker, date, close from panel where date = date '2001-11-04'
                union all
                select ticker, date, close from panel where date = date '2001-11-03'""",
    ),
)
def union_by_name(spark, sf_dir):
    closes = X.closes(spark, sf_dir)

    def on(day):
        return closes.filter(F.col("date") == F.lit(day).cast("date"))

    return on("2001-11-04").unionByName(on("2001-11-03").select("close", "date", "ticker"))


@query(
    "e1_label_codes",
    """select c_custkey, cast(code as int) as code from customer join (
         select c_mktsegment, dense_rank() over (order by c_mktsegment) - 1 as code
         from (select distinct c_mktsegment from customer)) using (c_mktsegment)""",
)
def label_codes(spark, sf_dir):
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return LK.encode(rows, {"c_mktsegment": "code"}).drop("c_mktsegment")


@query(
    "e1_label_codes_from_lookup",
    over(
        "sectors",
        body="""select s_suppkey, cast(code as int) as code from supplier
                join nation on n_nationkey = s_nationkey
                left join (select industry, dense_rank() over (order by industry) - 1 as code
                           from (select distinct industry from sectors)) on industry = n_name""",
    ),
)
def label_codes_from_lookup(spark, sf_dir):
    rows = (
        X.table(spark, sf_dir, "supplier")
        .join(X.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("industry"))
    )
    return LK.encode(rows, {"industry": "code"}, X.sectors(spark, sf_dir)).drop("industry")


@query(
    "e3_match_distribution",
    over(
        "matrix",
        body="""select id, round((prediction - avg(prediction) over ()) /
                stddev_samp(prediction) over () * s + m, 4) as matched from matrix,
                (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders)""",
    ),
)
def matched(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "prediction")
    made = match_distribution(
        rows, "prediction", X.table(spark, sf_dir, "orders"), "o_totalprice"
    )
    return made.select("id", F.round("prediction", 4).alias("matched"))
