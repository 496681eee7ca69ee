"""Scoring predictions and mapping them to a submission range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.scalar import clip, inverse_normal, rescale, sigmoid, signed_power
from tidepanel.operators.cross_section import centered_rank, percent_rank
from tidepanel.operators.skew import attach


def center(
    df: DataFrame, value: str, keys: Sequence[str] = (), source: DataFrame | None = None
) -> DataFrame:
    """``value`` minus its mean, per group; ``source`` is a cheaper frame of the same rows."""
    mean = (df if source is None else source).groupBy(*keys).agg(F.avg(value).alias("_mean"))
    joined = attach(df, mean, keys) if keys else df.crossJoin(F.broadcast(mean))  # one row
    return joined.withColumn(value, F.col(value) - F.col("_mean")).drop("_mean")


def rank_correlation(
    df: DataFrame, prediction: str, target: str, keys: Sequence[str] = (), out: str = "corr"
) -> DataFrame:
    """One row per group: Pearson correlation of tail-weighted predictions and target.

    Predictions are ranked, mapped to normal quantiles and raised to a signed power of 1.5;
    the target is centered and raised to the same power, without ranking. Rows that miss
    either value are dropped first.
    """
    complete = df.dropna("any", subset=[prediction, target]).select(*keys, prediction, target)
    ranked = centered_rank(complete, keys, prediction, "_p")
    centered = center(ranked, target, keys, complete)
    pair = centered.select(
        *keys,
        signed_power(inverse_normal(F.col("_p"))).alias("_p"),
        signed_power(F.col(target)).alias("_t"),
    )
    return pair.groupBy(*keys).agg(F.corr("_p", "_t").alias(out))


def era_scores(
    df: DataFrame, prediction: str, target: str, era: str = "era"
) -> tuple[DataFrame, DataFrame]:
    """Correlation per era, and its mean and sample std over eras."""
    per_era = rank_correlation(df, prediction, target, [era])
    summary = per_era.agg(
        F.avg("corr").alias("mean_corr"),
        F.stddev_samp("corr").alias("std_corr"),
        F.count("corr").alias("eras"),
    )
    return per_era, summary


def error_metrics(
    df: DataFrame, prediction: str, target: str, keys: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MSE and MAE."""
    error = F.col(prediction) - F.col(target)
    return df.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def match_distribution(
    df: DataFrame, value: str, reference: DataFrame, reference_value: str
) -> DataFrame:
    """Shift and scale ``value`` to the mean and sample std of a reference column."""
    own = df.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    other = reference.agg(
        F.avg(reference_value).alias("_rm"), F.stddev_samp(reference_value).alias("_rs")
    )
    joined = df.crossJoin(F.broadcast(own.crossJoin(other)))  # one row
    unit = F.try_divide(F.col(value) - F.col("_m"), F.col("_s"))
    return joined.withColumn(value, unit * F.col("_rs") + F.col("_rm")).select(*df.columns)


def self_standardize(df: DataFrame, value: str) -> DataFrame:
    """Own mean and population std."""
    own = df.agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    joined = df.crossJoin(F.broadcast(own))  # one row
    unit = F.try_divide(F.col(value) - F.col("_m"), F.col("_s"))
    return joined.withColumn(value, unit).select(*df.columns)


def ranked_range(
    df: DataFrame, value: str, low: float = 0.001, high: float = 0.999, keys: Sequence[str] = ()
) -> DataFrame:
    """Percent rank stretched to [low, high] and clipped."""
    ranked = percent_rank(df, keys, value, "_pct")
    return ranked.withColumn(value, clip(rescale(F.col("_pct"), low, high), low, high)).drop("_pct")


def sigmoid_range(
    df: DataFrame, value: str, low: float = 0.001, high: float = 0.999
) -> DataFrame:
    """Logistic of the standardized value, clipped."""
    unit = self_standardize(df, value)
    return unit.withColumn(value, clip(sigmoid(F.col(value)), low, high))
