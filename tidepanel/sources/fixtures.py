"""Input tables of the library, derived from the test tables. See FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.operators.skew import over_series
from tidepanel.sources.staging import stage

LIVE_DATE = "2001-11-04"
VALIDATION_FROM = "2000-01-01"
MATRIX_FEATURES = (
    "feature_quantity",
    "feature_discount",
    "feature_tax_group",
    "feature_price_group",
    "feature_line",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price panel: one row per supplier and ship date."""
    turn = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return (
        line_items(spark, sf_dir)
        .groupBy(
            F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("date")
        )
        .agg(
            F.max_by("l_extendedprice", turn).alias("close"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.min_by("l_extendedprice", turn).alias("open"),
            F.sum("l_quantity").alias("volume"),
        )
    )


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices(spark, sf_dir).select("ticker", "date", "close")


def landed_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closes as a written table, for work that reads them more than once."""
    return stage(closes(spark, sf_dir), "closes")


def ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor ticker per supplier: some missing, of one token, of three, or of unknown country."""
    nation = F.col("s_nationkey")
    code = (
        F.when(nation % 5 == 0, "US")
        .when(nation % 5 == 1, "LN")
        .when(nation % 5 == 2, "JP")
        .when(nation % 5 == 3, "GY")
        .otherwise("FP")
    )
    symbol = F.col("s_suppkey").cast("string")
    vendor = (
        F.when(F.col("s_suppkey") % 17 == 3, F.lit(None).cast("string"))
        .when(F.col("s_suppkey") % 17 == 5, symbol)
        .when(F.col("s_suppkey") % 17 == 7, F.concat(symbol, F.lit(" ZZ")))
        .when(F.col("s_suppkey") % 17 == 9, F.concat(symbol, F.lit(" PFD "), code))
        .otherwise(F.concat(symbol, F.lit(" "), code))
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ticker"),
        vendor.alias("bloomberg_ticker"),
        F.concat(symbol, F.lit(".Y")).alias("yahoo"),
        F.col("s_suppkey").alias("line"),
    )


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector and industry per supplier; one region has none."""
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(place, F.col("s_nationkey") == F.col("n_nationkey"))
        .filter(F.col("r_name") != "ASIA")
        .select(
            F.concat(F.col("s_suppkey").cast("string"), F.lit(".Y")).alias("ticker"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
        )
    )


def targets(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Per ticker and date: 1, 0.5 or 0 for a next close above, equal or below; null at the end.

    ``landed`` are the closes as ``landed_closes`` gives them, where they are there already.
    """
    # Counted backwards, the next row is the one before.
    backwards = F.datediff(F.lit("1970-01-01").cast("date"), "date")

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy("_back")
        return frame.withColumn("_next", F.lag("close").over(w))

    rows = (landed_closes(spark, sf_dir) if landed is None else landed).withColumn("_back", backwards)
    made = over_series(rows, "ticker", "_back", 1, build)
    step = F.signum(F.col("_next") - F.col("close"))
    return made.select("date", "ticker", ((step + 1) / 2).alias("target"))


def live_universe(spark: SparkSession, sf_dir: str, date: str = LIVE_DATE) -> DataFrame:
    """Every supplier on one live date."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ticker"), F.lit(date).cast("date").alias("date")
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature matrix: one row per line item, features 0..4, target and split label by era."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    hundredth = {c: F.round(F.col(c) * 100).cast("int") for c in ("l_discount", "l_tax")}

    def cut(value, width):
        return F.least(F.floor(value / width), F.lit(4)).cast("int")

    era = F.date_format("l_shipdate", "yyyyMM")
    return line_items(spark, sf_dir).select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.date_format("l_shipdate", "yyyyMMdd"),
            cents,
        ).alias("id"),
        era.alias("era"),
        F.when(era < "200001", "train")
        .when(era < "200107", "validation")
        .otherwise("test")
        .alias("data_type"),
        cut(F.col("l_quantity") - 1, 10).alias("feature_quantity"),
        cut(hundredth["l_discount"], 2).alias("feature_discount"),
        cut(hundredth["l_tax"], 2).alias("feature_tax_group"),
        cut(F.col("l_extendedprice"), 20000).alias("feature_price_group"),
        cut(F.col("l_linenumber") - 1, 1).alias("feature_line"),
        F.when(F.col("l_returnflag") == "A", 0.0)
        .when(F.col("l_returnflag") == "R", 1.0)
        .when(F.col("l_returnflag") == "N", 0.5)
        .alias("target"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax") * 10).alias("target_late"),
        (F.col("l_discount") * F.col("l_quantity")).alias("prediction"),
        F.col("l_extendedprice").alias("price"),
    )


def vectors(spark: SparkSession, sf_dir: str, width: int = 64) -> DataFrame:
    """Vector matrix: feature_0.. from the embedding, target = label / 9."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(f"feature_{i}") for i in range(width)],
        (F.col("label") / 9.0).alias("target"),
        F.col("label"),
    )


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short histories: one series of values per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ticker"), F.col("ts").alias("date"), F.col("value").alias("close")
    )
