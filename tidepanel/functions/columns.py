"""Choosing, guarding and narrowing columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_prefix(columns: Iterable[str], prefix: str, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in columns if c.startswith(prefix) and c not in exclude]


def by_substring(columns: Iterable[str], part: str) -> list[str]:
    return [c for c in columns if part in c]


def all_but(columns: Iterable[str], exclude: Iterable[str]) -> list[str]:
    """The columns outside ``exclude``, in table order."""
    dropped = set(exclude)
    return [c for c in columns if c not in dropped]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: missing values per column, from one aggregate."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def complete_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns without a missing value."""
    counts = null_counts(df, columns).first()
    return [c for c in columns if counts[c] == 0]


def ensure_columns(df: DataFrame, order: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly the columns of ``order``; absent ones are filled with a constant."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in order])


def narrow_numeric(df: DataFrame) -> DataFrame:
    """double to float and long to int; a long that does not fit becomes null."""

    def narrowed(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return F.col(f.name).cast("float").alias(f.name)
        if isinstance(f.dataType, T.LongType):
            return F.col(f.name).try_cast("int").alias(f.name)
        return F.col(f.name)

    return df.select(*[narrowed(f) for f in df.schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value in the data model; Spark would treat it as the largest number."""

    def cleaned(f: T.StructField):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def prefix_columns(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})
