"""Scans, sinks, column selection, filters."""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.sql import over
from tidepanel.functions import columns as C
from tidepanel.functions.scalar import guarded_ratio
from tidepanel.operators.features import interactions
from tidepanel.operators.lookup import fill_next_code
from tidepanel.operators.splits import by_label
from tidepanel.sources import fixtures as X
from tidepanel.sources import frames, sinks
from tidepanel.sources.staging import stage, staging_path


@query(
    "a1_pruned_scan",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem",
)
def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return frames.scan(spark, f"{sf_dir}/lineitem.parquet", keep)


@query("a2_full_scan", "select * from customer")
def full_scan(spark, sf_dir):
    return frames.scan(spark, f"{sf_dir}/customer.parquet")


@query(
    "a3_scan_select_filter",
    """select l_orderkey, l_partkey, l_quantity, l_extendedprice from lineitem
       where l_returnflag = 'R' and l_quantity is not null""",
)
def scan_select_filter(spark, sf_dir):
    return frames.scan(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"],
        (F.col("l_returnflag") == "R") & F.col("l_quantity").isNotNull(),
    )


@query("a4_csv_lookup", over("sectors", body="select ticker, sector, industry from sectors"))
def csv_lookup(spark, sf_dir):
    path = staging_path(spark, "sectors")
    sinks.write_csv(X.sectors(spark, sf_dir), path)
    return frames.scan_csv(spark, path, "ticker string, sector string, industry string")


@query(
    "a5_feature_set",
    over("matrix", body="select id, feature_quantity, feature_discount, feature_line from matrix"),
)
def feature_set(spark, sf_dir):
    matrix = X.matrix(spark, sf_dir)
    names = C.by_prefix(matrix.columns, "feature_")
    sets = {"medium": names, "small": [n for n in names if "group" not in n]}
    path = staging_path(spark, "features")
    text = json.dumps({"feature_sets": sets})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return matrix.select("id", *frames.feature_set(spark, path, "small"))


@query(
    "a6_wide_to_long",
    """select cast(o_orderdate as date) as date, o_orderpriority as symbol,
              max(o_totalprice) as close, cast(count(*) as double) as volume
       from orders group by 1, 2""",
)
def wide_to_long(spark, sf_dir):
    symbols = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = (
        X.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            *[
                F.max(F.when(F.col("o_orderpriority") == s, F.col("o_totalprice"))).alias(
                    f"close|{s}"
                )
                for s in symbols
            ],
            *[
                F.nullif(F.count_if(F.col("o_orderpriority") == s), F.lit(0)).alias(f"volume|{s}")
                for s in symbols
            ],
        )
    )
    return frames.quotes_to_panel(wide, "date", ["close", "volume"])


@query("a7_submission", over("matrix", body="select id, round(prediction, 6) as signal from matrix"))
def submission(spark, sf_dir):
    path = staging_path(spark, "submission")
    scored = rounded(X.matrix(spark, sf_dir), 6, "prediction")
    sinks.write_csv(sinks.submission(scored, "id", "prediction", "signal"), path)
    return frames.scan_csv(spark, path, "id string, signal double")


@query(
    "a8_diagnostics",
    over(
        "panel",
        body="""select ticker, date, round(close / high, 6) as signal from panel
                where date >= date '2000-01-01'""",
    ),
)
def diagnostics(spark, sf_dir):
    path = staging_path(spark, "diagnostics")
    panel = X.prices(spark, sf_dir).filter(F.col("date") >= F.lit(X.VALIDATION_FROM).cast("date"))
    signal = panel.withColumn("signal", F.round(F.col("close") / F.col("high"), 6))
    sinks.write_diagnostics(signal, path, "ticker", "date", "signal")
    return frames.scan_csv(spark, path, "ticker long, date date, signal double")


@query("a9_staged_table", over("panel", body="select * from panel"))
def staged_table(spark, sf_dir):
    return stage(X.prices(spark, sf_dir), "panel")


@query(
    "b1_explicit_columns",
    over("matrix", body="select feature_line, id, feature_discount from matrix"),
)
def explicit_columns(spark, sf_dir):
    return X.matrix(spark, sf_dir).select("feature_line", "id", "feature_discount")


@query(
    "b2_prefix_columns",
    over(
        "matrix",
        body="""select id, feature_quantity, feature_tax_group, feature_price_group from matrix""",
    ),
)
def prefix_columns(spark, sf_dir):
    matrix = X.matrix(spark, sf_dir)
    names = C.by_prefix(matrix.columns, "feature_", ("feature_discount", "feature_line"))
    return matrix.select("id", *names)


@query(
    "b3_substring_columns",
    over("matrix", body="select id, feature_tax_group, feature_price_group from matrix"),
)
def substring_columns(spark, sf_dir):
    matrix = X.matrix(spark, sf_dir)
    return matrix.select("id", *C.by_substring(matrix.columns, "group"))


@query(
    "b4_all_but",
    over("panel", body="select ticker, date, high, low from panel"),
)
def all_but(spark, sf_dir):
    panel = X.prices(spark, sf_dir)
    return panel.select(*C.all_but(panel.columns, {"close", "open", "volume"}))


@query(
    "b5_complete_columns",
    over(
        "matrix",
        body="""select id, feature_quantity, feature_discount, feature_tax_group,
                feature_price_group, feature_line, target from matrix""",
    ),
)
def complete_columns(spark, sf_dir):
    matrix = X.matrix(spark, sf_dir)
    candidates = C.by_prefix(matrix.columns, "feature_") + ["target", "target_late"]
    return matrix.select("id", *C.complete_columns(matrix, candidates))


@query("b6_drop_columns", over("panel", body="select ticker, date, close from panel"))
def drop_columns(spark, sf_dir):
    return X.prices(spark, sf_dir).drop("high", "low", "open", "volume")


@query(
    "b7_rename",
    over(
        "panel",
        body="""select ticker, date, close as day_close, high as day_high, low as day_low
                from panel""",
    ),
)
def rename(spark, sf_dir):
    panel = X.prices(spark, sf_dir).drop("open", "volume")
    return C.prefix_columns(panel, ["close", "high", "low"], "day_")


@query(
    "b8_derived_columns",
    over(
        "panel",
        body="""select ticker, date, round(high - low, 4) as spread, round(close / low, 9) as lift
                from panel""",
    ),
)
def derived_columns(spark, sf_dir):
    panel = X.prices(spark, sf_dir).withColumns(
        {
            "spread": F.round(F.col("high") - F.col("low"), 4),
            "lift": F.round(F.try_divide("close", "low"), 9),
        }
    )
    return panel.select("ticker", "date", "spread", "lift")


@query(
    "b9_required_columns",
    over(
        "matrix",
        body="""select id, feature_line, 0.0::double as feature_absent, feature_discount
                from matrix""",
    ),
)
def required_columns(spark, sf_dir):
    order = ["id", "feature_line", "feature_absent", "feature_discount"]
    return C.ensure_columns(X.matrix(spark, sf_dir), order)


@query(
    "b10_narrow_numeric",
    """select cast(l_orderkey as int) as l_orderkey, cast(l_partkey as int) as l_partkey,
              l_linenumber, cast(cast(l_extendedprice as float) as double) as l_extendedprice,
              cast(cast(l_discount as float) as double) as l_discount from lineitem""",
)
def narrow_numeric(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount"
    )
    narrow = C.narrow_numeric(rows)
    # Widened again only so that both engines print the single-precision value alike.
    wide = {c: F.col(c).cast("double") for c in ("l_extendedprice", "l_discount")}
    return narrow.withColumns(wide)


@query(
    "b11_integer_codes",
    """select l_orderkey, l_partkey, l_linenumber, l_suppkey, cast(l_quantity as int) as code
       from lineitem""",
)
def integer_codes(spark, sf_dir):
    return X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("code"),
    )


@query(
    "f1_label_filter",
    over("matrix", body="select id, era, target from matrix where data_type = 'validation'"),
)
def label_filter(spark, sf_dir):
    return by_label(X.matrix(spark, sf_dir), "data_type", "validation").select(
        "id", "era", "target"
    )


@query(
    "f2_positive_price",
    """select c_custkey, c_acctbal from customer where c_acctbal > 0""",
)
def positive_price(spark, sf_dir):
    return (
        X.table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select("c_custkey", "c_acctbal")
    )


@query(
    "f3_target_present",
    over("matrix", body="select id, target, round(target_late, 6) as target_late from matrix "
         "where target is not null and target_late is not null"),
)
def target_present(spark, sf_dir):
    kept = X.matrix(spark, sf_dir).dropna("any", subset=["target", "target_late"])
    return rounded(kept.select("id", "target", "target_late"), 6, "target_late")


@query(
    "f4_complete_in_columns",
    over("ticker_map", body="select ticker, bloomberg_ticker, yahoo from ticker_map "
         "where bloomberg_ticker is not null and yahoo is not null"),
)
def complete_in_columns(spark, sf_dir):
    rows = X.ticker_map(spark, sf_dir).select("ticker", "bloomberg_ticker", "yahoo")
    return rows.dropna("any", subset=["bloomberg_ticker", "yahoo"])


@query(
    "f5_complete_rows",
    over(
        "matrix",
        body="""select id, feature_line, round(target_late, 6) as target_late from matrix
                where id is not null and feature_line is not null and target_late is not null""",
    ),
)
def complete_rows(spark, sf_dir):
    rows = X.matrix(spark, sf_dir).select("id", "feature_line", "target_late").dropna("any")
    return rounded(rows, 6, "target_late")


@query(
    "f6_latest_date",
    over("panel", body="select * from panel where date = (select max(date) from panel)"),
)
def latest_date(spark, sf_dir):
    panel = X.prices(spark, sf_dir)
    latest = panel.agg(F.max("date")).first()[0]
    return panel.filter(F.col("date") == F.lit(latest))


@query(
    "f7_live_date",
    """select min(cast(l_shipdate as date)) as live_date from lineitem
       where l_shipdate >= (select max(l_shipdate) from lineitem)""",
)
def live_date(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    latest = rows.agg(F.max("d")).first()[0]
    return rows.filter(F.col("d") >= F.lit(latest)).agg(F.min("d").alias("live_date"))


@query(
    "f8_next_code",
    """select o_orderkey, coalesce(code, max(code) over () + 1) as code
       from (select o_orderkey, case when o_custkey % 5 < 4 then cast(o_custkey % 5 as int) end
             as code from orders)""",
)
def next_code(spark, sf_dir):
    part = (F.col("o_custkey") % 5).cast("int")
    rows = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(part < 4, part).alias("code")
    )
    return fill_next_code(rows, ["code"])


PRODUCTS = [f"{a}_mul_{b}" for a, b in combinations(X.MATRIX_FEATURES, 2)]


@query(
    "m9_pairwise_products",
    over(
        "matrix",
        body="select id, "
        + ", ".join(f"{a} * {b} as {a}_mul_{b}" for a, b in combinations(X.MATRIX_FEATURES, 2))
        + " from matrix",
    ),
)
def pairwise_products(spark, sf_dir):
    return interactions(X.matrix(spark, sf_dir), X.MATRIX_FEATURES).select("id", *PRODUCTS)


@query(
    "m10_guarded_ratio",
    over(
        "matrix",
        body="""select id,
          round(feature_quantity / case when feature_discount = 0 then 1e-8::double
                                        else feature_discount end, 4) as plain,
          round(feature_line / case when target_late = 0 or target_late is null
                                    then 1e-8::double else target_late end, 4) as null_guard
          from matrix""",
    ),
)
def guarded(spark, sf_dir):
    return X.matrix(spark, sf_dir).select(
        "id",
        F.round(guarded_ratio(F.col("feature_quantity"), F.col("feature_discount")), 4).alias(
            "plain"
        ),
        F.round(
            guarded_ratio(
                F.col("feature_line"), F.col("target_late"), missing=True, infinite=True
            ),
            4,
        ).alias("null_guard"),
    )


@query(
    "m11_square",
    over(
        "matrix",
        body="select id, " + ", ".join(f"{c} * {c} as {c}_squared" for c in X.MATRIX_FEATURES) + " from matrix",
    ),
)
def square(spark, sf_dir):
    wide = interactions(X.matrix(spark, sf_dir), X.MATRIX_FEATURES)
    return wide.select("id", *[f"{c}_squared" for c in X.MATRIX_FEATURES])
