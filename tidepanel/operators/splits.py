"""Train and validation splits by date, era or label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.cross_section import held_out
from tidepanel.operators.skew import attach, running_total


def chronological_split(
    df: DataFrame, date: str, tie: str, share: float = 0.3, out: str = "part"
) -> DataFrame:
    """Mark the first rows in (date, tie) order as train and the last ceil(share * n) as test.

    Counts per date locate the date the cut falls in; only that date is put in order.
    """
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, [], [date], "_n")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    keep = total - held_out(total, share)
    cut = (
        placed.filter((F.col("_before") <= keep) & (F.col("_before") + F.col("_n") > keep))
        .select(date, "_before")
        .first()
    )
    if cut is None:
        return df.withColumn(out, F.lit("train"))
    day, before = F.lit(cut[date]), cut["_before"]
    whole = df.filter(F.col(date) != day).withColumn(
        out, F.when(F.col(date) < day, F.lit("train")).otherwise(F.lit("test"))
    )
    inside = running_total(df.filter(F.col(date) == day), [date], [tie]).withColumn(
        out, F.when(F.col("_before") < keep - before, F.lit("train")).otherwise(F.lit("test"))
    )
    return whole.unionByName(inside.drop("_before"))


def last_eras(df: DataFrame, era: str, k: int) -> DataFrame:
    """The last ``k`` distinct eras in text order."""
    return df.select(era).distinct().orderBy(F.col(era).desc()).limit(k)


def era_folds(df: DataFrame, era: str = "era", n_folds: int = 5, step: int = 3) -> DataFrame:
    """One row per (era, fold) with its role.

    Fold f holds out the last ``step * (f + 1)`` eras; the last fold holds out the last
    ``step`` again.
    """
    names = df.select(era).distinct()
    from_end = running_total(names, [], [era]).withColumnRenamed("_before", "_at")
    count = names.agg(F.count(F.lit(1)).alias("_count"))
    folds = from_end.crossJoin(F.broadcast(count)).withColumn(  # one row
        "fold", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1)))
    )
    held = F.when(F.col("fold") == n_folds - 1, F.lit(step)).otherwise(
        (F.col("fold") + 1) * step
    )
    role = F.when(F.col("_at") >= F.col("_count") - held, F.lit("validation"))
    return folds.select(era, "fold", role.otherwise(F.lit("train")).alias("role"))


def with_fold_roles(
    df: DataFrame, era: str = "era", n_folds: int = 5, step: int = 3, source: DataFrame | None = None
) -> DataFrame:
    """Rows with an array of roles, one per fold: labels all folds in one pass.

    ``source`` is a cheaper frame of the same rows.
    """
    table = era_folds(df if source is None else source, era, n_folds, step)
    roles = table.groupBy(era).agg(
        F.array_sort(F.collect_list(F.struct("fold", "role"))).alias("_roles")
    )
    return attach(df, roles.select(era, F.col("_roles.role").alias("roles")), [era])


def by_label(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rows whose split label equals ``value``."""
    return df.filter(F.col(label) == value)
