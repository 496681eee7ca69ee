"""Scalar functions, scalers and the user-function surface."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from tidepanel.catalog.registry import query
from tidepanel.catalog.sql import CANONICAL, average_rank, inverse_normal, over
from tidepanel.functions import scalar as S
from tidepanel.operators.cross_section import centered_rank
from tidepanel.operators.models import score_in_batches
from tidepanel.operators.neutralize import standardize
from tidepanel.operators.score import self_standardize, sigmoid_range
from tidepanel.operators.series_functions import map_rows
from tidepanel.sources import fixtures as X


@query(
    "m1_canonical_ticker",
    over("ticker_map", body=f"select ticker, {CANONICAL} as canonical_ticker from ticker_map"),
)
def canonical_ticker(spark, sf_dir):
    return X.ticker_map(spark, sf_dir).select(
        "ticker", S.canonical_ticker(F.col("bloomberg_ticker")).alias("canonical_ticker")
    )


@query(
    "m2_country_token",
    over(
        "ticker_map",
        body="""select ticker, string_split(bloomberg_ticker, ' ')[2] as country from ticker_map""",
    ),
)
def country_token(spark, sf_dir):
    return X.ticker_map(spark, sf_dir).select(
        "ticker", S.country_token(F.col("bloomberg_ticker")).alias("country")
    )


@query(
    "m3_quote_symbol",
    """select p_partkey, upper(p_name) || '-USD' as symbol, upper(p_brand) || '-USD' as brand
       from part""",
)
def quote_symbol(spark, sf_dir):
    return X.table(spark, sf_dir, "part").select(
        "p_partkey",
        S.quote_symbol(F.col("p_name")).alias("symbol"),
        S.quote_symbol(F.col("p_brand")).alias("brand"),
    )


@query(
    "m4_signed_power",
    """select c_custkey, round(sign(c_acctbal / 1000) * pow(abs(c_acctbal / 1000), 1.5), 9) as powered
       from customer""",
)
def signed_power(spark, sf_dir):
    return X.table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(S.signed_power(F.col("c_acctbal") / 1000), 9).alias("powered")
    )


@query(
    "m5_inverse_normal",
    over(
        "matrix",
        body=f"""@r as (select id, ({average_rank('price')} - 0.5) / count(*) over () as p
                 from matrix)
                 select id, round({inverse_normal('p')}, 9) as z from r""",
    ),
)
def inverse(spark, sf_dir):
    ranked = centered_rank(X.matrix(spark, sf_dir).select("id", "price"), [], "price", "p")
    return ranked.select("id", F.round(S.inverse_normal(F.col("p")), 9).alias("z"))


@query(
    "m6_sigmoid",
    "select c_custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 9) as squashed from customer",
)
def sigmoid(spark, sf_dir):
    return X.table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(S.sigmoid(F.col("c_acctbal") / 1000), 9).alias("squashed")
    )


@query(
    "m7_clip",
    """select c_custkey, case when c_acctbal is not null
       then least(greatest(c_acctbal, 0.001::double), 5000.0::double) end as clipped from customer""",
)
def clip(spark, sf_dir):
    return X.table(spark, sf_dir, "customer").select(
        "c_custkey", S.clip(F.col("c_acctbal"), 0.001, 5000.0).alias("clipped")
    )


@query(
    "m12_dates",
    """select o_orderkey, cast(o_orderdate as date) as from_number, cast(o_orderdate as date) as
       from_text, cast(strftime(o_orderdate, '%Y%m%d') as int) as as_number from orders""",
)
def dates(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    number = S.date_number(F.col("o_orderdate"))
    return orders.select(
        "o_orderkey",
        S.compact_date(number).alias("from_number"),
        S.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("from_text"),
        number.alias("as_number"),
    )


@query(
    "m13_shift_date",
    """select o_orderkey, cast(cast(o_orderdate as date) - 80 as date) as start_date,
              cast(cast(o_orderdate as date) + 9 as date) as end_date from orders""",
)
def shift_date(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_sub(day, 80).alias("start_date"),
        F.date_add(day, 9).alias("end_date"),
    )


@query(
    "m14_mean_of_predictions",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round((l_discount + l_tax + l_quantity) / 3, 9) as mean from lineitem""",
)
def mean_of_predictions(spark, sf_dir):
    members = [F.col(c) for c in ("l_discount", "l_tax", "l_quantity")]
    return X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(S.mean_of(members), 9).alias("mean"),
    )


@query(
    "e2_standardize",
    over(
        "matrix",
        body="""select id, round((price - avg(price) over (partition by era)) /
                stddev_pop(price) over (partition by era), 9) as price,
                round((feature_line - avg(feature_line) over (partition by era)) /
                stddev_pop(feature_line) over (partition by era), 9) as feature_line
                from matrix""",
    ),
)
def standardized(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "era", "price", "feature_line")
    made = standardize(rows, ["price", "feature_line"], ["era"])
    return made.select(
        "id", F.round("price", 9).alias("price"), F.round("feature_line", 9).alias("feature_line")
    )


ENTRIES = range(64)


@query(
    "e2_standardize_whole",
    "with v as (select vec_id, "
    + ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in ENTRIES)
    + " from embeddings) select vec_id, "
    + ", ".join(f"round((e{i} - avg(e{i}) over ()) / stddev_pop(e{i}) over (), 9) as feature_{i}" for i in ENTRIES)
    + " from v",
)
def standardized_whole(spark, sf_dir):
    names = [f"feature_{i}" for i in ENTRIES]
    made = standardize(X.vectors(spark, sf_dir).select("vec_id", *names), names)
    return made.select("vec_id", *[F.round(c, 9).alias(c) for c in names])


@query(
    "e4_population_standardize",
    over(
        "matrix",
        body="""select id, round((price - avg(price) over ()) / stddev_pop(price) over (), 6) as unit
                from matrix""",
    ),
)
def population_standardize(spark, sf_dir):
    made = self_standardize(X.matrix(spark, sf_dir).select("id", "price"), "price")
    return made.select("id", F.round("price", 6).alias("unit"))


@query(
    "m6_sigmoid_range",
    over(
        "matrix",
        body="""select id, round(least(greatest(1 / (1 + exp(-(price - avg(price) over ()) /
                stddev_pop(price) over ())), 0.001), 0.999), 9) as squashed from matrix""",
    ),
)
def squashed_range(spark, sf_dir):
    made = sigmoid_range(X.matrix(spark, sf_dir).select("id", "price"), "price")
    return made.select("id", F.round("price", 9).alias("squashed"))


@query(
    "p1_row_function",
    """select p_partkey, upper(string_split(p_name, ' ')[1]) || '/' || p_size as label from part""",
)
def row_function(spark, sf_dir):
    """A row function that built-in expressions can say stays one."""
    word = F.upper(F.split("p_name", " ")[0])
    return X.table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(word, F.lit("/"), F.col("p_size")).alias("label")
    )


@query(
    "p1_user_row_function",
    """select p_partkey, strip_accents(p_name) as plain, length(p_name) as n from part""",
)
def user_row_function(spark, sf_dir):
    """A row function of the user's own, in Python over batches: names without accents, by code point tables."""

    def plain(frame: pd.DataFrame) -> dict[str, pd.Series]:
        parts = frame["p_name"].map(lambda name: unicodedata.normalize("NFD", name))
        kept = parts.map(lambda name: "".join(c for c in name if not unicodedata.combining(c)))
        return {"plain": kept, "n": frame["p_name"].str.len()}

    rows = X.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return map_rows(rows, "plain string, n long", plain, ["p_name"]).drop("p_name")


@query(
    "p4_user_scorer",
    over(
        "matrix",
        body="""select id, 0.5 * feature_quantity - 0.25 * feature_line + 1 as prediction
                from matrix""",
    ).replace("0.5 *", "0.5::double *").replace("0.25 *", "0.25::double *"),
)
def user_scorer(spark, sf_dir):
    features = ["feature_quantity", "feature_line"]

    def predict(frame: pd.DataFrame) -> pd.Series:
        return 0.5 * frame["feature_quantity"] - 0.25 * frame["feature_line"] + 1

    return score_in_batches(X.matrix(spark, sf_dir), predict, features, ["id"])
