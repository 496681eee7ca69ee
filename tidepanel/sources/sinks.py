"""Submission and diagnostics files, and scorers on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks that share the rows of one date.
DATE_TASKS = 4


def submission(df: DataFrame, key: str, prediction: str, out: str = "prediction") -> DataFrame:
    """The two columns of a submission."""
    return df.select(key, df[prediction].alias(out))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV with a header, one file per task, optionally one folder per value."""
    writer = df.write.option("header", True).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_submission(df: DataFrame, path: str, key: str, prediction: str) -> None:
    write_csv(submission(df, key, prediction), path)


def write_diagnostics(
    df: DataFrame, path: str, key: str, date: str, signal: str, by_date: bool = False
) -> None:
    """Signals by key and date; ``by_date`` deals each date to a few tasks, so that it is a few files."""
    rows = df.select(key, date, signal)
    if by_date:
        rows = rows.repartition(date, F.pmod(F.xxhash64(key), F.lit(DATE_TASKS)))
    write_csv(rows, path, [date] if by_date else ())


def save_scorer(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load_scorer(path: str) -> PipelineModel:
    return PipelineModel.load(path)


TRIALS = T.StructType(
    [
        T.StructField("trial", T.LongType()),
        T.StructField("rung", T.IntegerType()),
        T.StructField("rounds", T.IntegerType()),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("score", T.DoubleType()),
    ]
)


def append_trials(spark: SparkSession, rows: Sequence[tuple], path: str) -> None:
    """Add the trials of one run, a handful of rows, to the search history."""
    spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("append").parquet(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """The search history; empty when there is none yet."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(jvm_path):
        return spark.createDataFrame([], TRIALS)
    return spark.read.schema(TRIALS).parquet(path)
