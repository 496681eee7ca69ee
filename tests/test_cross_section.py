"""Ranks, quantiles, codes and splits against pandas, in both plans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import cross_section
from tidepanel.operators.cross_section import percent_rank, quantile_edges, quintiles
from tidepanel.operators.lookup import encode, fill_next_code, map_values
from tidepanel.operators.skew import find_hot, running_total, salted_join
from tidepanel.operators.splits import chronological_split, era_folds
from tidepanel.sources.staging import stage


def qcut(group):
    try:
        return pd.qcut(group, 5, labels=False, duplicates="drop")
    except ValueError:
        return pd.Series(np.nan, index=group.index)


def table(rows, seed, spread):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(
        {
            "id": np.arange(rows),
            "day": rng.integers(0, 4, rows),
            "x": rng.integers(0, spread, rows).astype(float),
            "y": rng.normal(size=rows),
        }
    )
    frame.loc[frame["id"] % 11 == 0, "x"] = np.nan
    return frame


@pytest.mark.parametrize("limit", [10_000, 25])
@pytest.mark.parametrize("spread", [2, 6, 1000])
def test_quintiles_and_ranks(spark, hot, limit, spread):
    hot(limit)
    frame = table(400, spread, spread)
    one_day = pd.DataFrame({"id": [900, 901, 902], "day": 7, "x": [5.0, 5.0, 5.0], "y": [1.0, 2, 3]})
    frame = pd.concat([frame, one_day], ignore_index=True)
    df = spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    made = percent_rank(quintiles(df, ["day"], ["x", "y"]), ["day"], "x", "pct")
    made = made.toPandas().sort_values("id").reset_index(drop=True)
    by_day = frame.groupby("day")
    for c in ("x", "y"):
        expected = by_day[c].transform(qcut)
        np.testing.assert_array_equal(made[f"{c}_quintile"].astype(float), expected)
    np.testing.assert_allclose(made["pct"], by_day["x"].rank(pct=True), rtol=1e-12)
    assert made.loc[made["day"] == 7, "x_quintile"].isna().all()


def test_quintile_of_mostly_equal_values(spark):
    values = [1.0] * 30 + list(np.arange(2.0, 12.0))
    frame = pd.DataFrame({"day": 1, "x": values})
    made = quintiles(spark.createDataFrame(frame), ["day"], ["x"]).toPandas().sort_values("x")
    np.testing.assert_array_equal(made["x_quintile"].astype(float), qcut(pd.Series(values)))


def test_whole_frame_rank_without_keys(spark, hot):
    frame = table(300, 3, 20)
    df = spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for limit in (10_000, 30):
        hot(limit)
        made = percent_rank(df, [], "x", "pct").toPandas().sort_values("id")
        np.testing.assert_allclose(made["pct"], frame["x"].rank(pct=True), rtol=1e-12)


@pytest.mark.parametrize("rows", [500, 20_000])
def test_edges_of_large_groups_equal_edges_in_memory(spark, hot, monkeypatch, rows):
    frame = table(rows, 5, 50)
    frame["z"] = np.where(frame["id"] % 3 == 0, 1.5, frame["y"])
    df = spark.createDataFrame(frame[["day", "x", "y", "z"]])
    df = stage(df.withColumn("x", F.when(~F.isnan("x"), F.col("x"))), "t")
    columns = ["x", "y", "z"]
    small = quantile_edges(df, ["day"], columns).orderBy("day").collect()
    sorted_groups = []
    full = cross_section._sorted_edges

    def counted(hot_rows, *rest):
        sorted_groups.append(hot_rows.select("day").distinct().count())
        return full(hot_rows, *rest)

    monkeypatch.setattr(cross_section, "_sorted_edges", counted)
    hot(60)
    large = quantile_edges(df, ["day"], columns).orderBy("day").collect()
    assert len(small) == len(large) == 4
    for a, b in zip(small, large):
        for c in columns:
            np.testing.assert_allclose(a[c], b[c], rtol=1e-14)
    # With enough rows per group the brackets hold and nothing is sorted in full.
    assert rows < 20_000 or not sorted_groups


def test_edges_by_full_sort(spark):
    df = spark.createDataFrame(table(500, 6, 30)[["day", "y"]])
    small = quantile_edges(df, ["day"], ["y"]).orderBy("day").collect()
    full = cross_section._sorted_edges(df, ["day"], ["y"], cross_section.QUINTILES)
    for a, b in zip(small, full.orderBy("day").collect()):
        np.testing.assert_allclose(a["y"], b["y"], rtol=1e-14)


def test_running_total_of_one_hot_key(spark, hot):
    hot(30)
    frame = pd.DataFrame({"k": [1] * 200 + [2] * 5, "o": range(205), "w": 2})
    df = spark.createDataFrame(frame)
    assert find_hot(df, ["k"]).rows == 200
    made = running_total(df, ["k"], ["o"], "w").toPandas().sort_values("o")
    expected = list(range(0, 400, 2)) + [0, 2, 4, 6, 8]
    assert made["_before"].tolist() == expected


def test_salted_join_keeps_all_rows(spark, hot):
    hot(10)
    frame = pd.DataFrame({"id": range(120), "k": [1] * 90 + [2] * 20 + [3] * 10})
    df = spark.createDataFrame(frame)
    counts = stage(
        df.filter("k < 3").groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s")), "c"
    )
    made = salted_join(df, counts, ["k"], find_hot(df, ["k"])).toPandas()
    assert len(made) == 120
    sums = frame[frame["k"] < 3].groupby("k")["id"].sum()
    for k, s in sums.items():
        assert (made.loc[made["k"] == k, "s"] == s).all()
    assert made.loc[made["k"] == 3, "s"].isna().all()


@pytest.mark.parametrize("n", [1, 10, 11, 50])
@pytest.mark.parametrize("limit", [1000, 4])
def test_chronological_split(spark, hot, n, limit):
    hot(limit)
    frame = pd.DataFrame({"date": [i // 7 for i in range(n)], "t": [f"t{i:03}" for i in range(n)]})
    made = chronological_split(spark.createDataFrame(frame).repartition(3), "date", "t").toPandas()
    made = made.sort_values(["date", "t"])["part"].tolist()
    test = -(-3 * n // 10)
    assert made == ["train"] * (n - test) + ["test"] * test


def test_few_eras_are_all_held_out(spark):
    df = spark.createDataFrame([(f"{e:04}",) for e in range(5)], "era string")
    rows = era_folds(df).toPandas()
    held = rows[rows["role"] == "validation"].groupby("fold")["era"].count()
    assert held.tolist() == [3, 5, 5, 5, 3]


def test_dictionary_takes_the_last_duplicate(spark):
    table_ = spark.createDataFrame(
        [("a", 1, 0), ("a", 2, 1), ("b", None, 2), (None, 9, 3)], "k string, v int, line int"
    )
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    made = {r["k"]: r["v"] for r in map_values(rows, table_, "k", ["v"], "line").collect()}
    assert made == {"a": 2, "b": None, "c": None, None: None}


def test_codes(spark):
    rows = spark.createDataFrame([("x",), ("b",), ("m",), ("b",), (None,)], "v string")
    coded = encode(rows, {"v": "code"})
    assert sorted((r["v"] or "", r["code"]) for r in coded.dropna().collect()) == [
        ("b", 0), ("b", 0), ("m", 1), ("x", 2),
    ]
    filled = fill_next_code(coded, ["code"])
    assert {r["code"] for r in filled.filter("v is null").collect()} == {3}


@pytest.mark.parametrize("margin", [cross_section.MARGIN, 0.01])
def test_rows_of_large_groups_are_labelled_where_they_are(spark, hot, monkeypatch, margin):
    """The labels of the ordinary plan, with brackets that hold and with ones that miss; no row is written."""
    rng = np.random.default_rng(8)
    frame = table(20_000, 8, 30).assign(flat=1.0, none=np.nan)
    frame["z"] = np.where(rng.random(len(frame)) < 0.3, np.nan, rng.normal(size=len(frame)))
    df = stage(spark.createDataFrame(frame).withColumn("day", F.when(F.col("day") < 3, F.col("day"))).repartition(5), "t")
    columns = ["x", "y", "z", "flat", "none"]
    small = quintiles(df, ["day"], columns).toPandas().sort_values("id").reset_index(drop=True)
    hot(6000)
    staged = []
    for module in ("cross_section", "skew"):
        monkeypatch.setattr(f"tidepanel.operators.{module}.stage", lambda rows, tag: staged.append(rows.columns) or stage(rows, tag))
    monkeypatch.setattr(cross_section, "COUNTED_ROWS", 1500)
    monkeypatch.setattr(cross_section, "MARGIN", margin)
    large = quintiles(df, ["day"], columns)
    assert "_quintile" in large.columns[-1] and not [c for c in staged if {"x", "y"} & set(c)]
    assert "Exchange" not in large._jdf.queryExecution().executedPlan().toString()
    pd.testing.assert_frame_equal(small, large.toPandas().sort_values("id").reset_index(drop=True))
