"""Neutralization, metrics, scalar functions, as-of fill and feature helpers."""

import ctypes
import datetime as dt
from pathlib import Path
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.functions import scalar as S
from tidepanel.functions.columns import ensure_columns, nan_to_null, narrow_numeric
from tidepanel.operators import neutralize as N
from tidepanel.operators.asof import latest_within
from tidepanel.operators.features import choose_factors, hashed_sample
from tidepanel.operators.score import rank_correlation
from tidepanel.sources.frames import quotes_to_panel
from tidepanel.sources.staging import stage


def matrix(rows, k, seed=0, eras=1):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(rng.normal(size=(rows, k)), columns=[f"feature_{i}" for i in range(k)])
    frame["prediction"] = frame.sum(axis=1) * 0.3 + rng.normal(size=rows) + 2
    frame["era"] = np.arange(rows) % eras
    frame["id"] = np.arange(rows)
    return frame


def expected_full(frame, by, proportion):
    s = frame["prediction"].to_numpy()
    e = np.column_stack([frame[by].to_numpy(), np.full(len(s), s.mean())])
    r = s - proportion * (e @ (np.linalg.pinv(e) @ s))
    return r / r.std(ddof=1)


@pytest.mark.parametrize("k", [3, 20])
@pytest.mark.parametrize("proportion", [0.0, 0.5, 1.0])
def test_full_neutralization(spark, k, proportion):
    frame = matrix(200, k)
    by = [f"feature_{i}" for i in range(k)]
    df = spark.createDataFrame(frame).repartition(3)
    made = N.neutralize_full(df, proportion=proportion).toPandas().sort_values("id")
    np.testing.assert_allclose(
        made["prediction"], expected_full(frame, by, proportion), rtol=1e-8, atol=1e-9
    )
    if proportion == 1.0:
        assert np.abs(frame[by].to_numpy().T @ made["prediction"].to_numpy()).max() < 1e-7


@pytest.mark.parametrize("k", [2, 18])
def test_partial_neutralization_per_era(spark, hot, k):
    hot(40)
    frame = matrix(300, k, 1, eras=3)
    by = [f"feature_{i}" for i in range(k)]
    df = spark.createDataFrame(frame).repartition(3)
    made = N.neutralize_partial(df, ["prediction"], by, 0.6, ["era"]).toPandas().sort_values("id")
    for era, rows in frame.groupby("era"):
        z = rows[by].to_numpy()
        z = (z - z.mean(axis=0)) / z.std(axis=0)
        s = rows["prediction"].to_numpy()
        want = s - 0.6 * (z @ np.linalg.lstsq(z, s, rcond=None)[0])
        got = made.loc[made["era"] == era, "prediction"]
        np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-9)


def residuals(rows, by, proportion):
    z = rows[by].to_numpy()
    z = z - z.mean(axis=0)
    s = rows["prediction"].to_numpy()
    return s - proportion * (z @ np.linalg.lstsq(z, s, rcond=None)[0])


def wide_eras(eras, per_era, k, apart):
    """Eras whose factors lie far from each other."""
    frame = matrix(eras * per_era, k, 5, eras)
    by = [f"feature_{i}" for i in range(k)]
    frame[by] += apart * frame[["era"]].to_numpy()
    return frame, by


def test_matrices_merge_far_from_zero(spark, monkeypatch):
    """Small limits: matrices are handed on early and merged in several rounds; nothing is lost to the distance."""
    monkeypatch.setattr(N, "HELD_BYTES", 2 * 8 * 20**2)
    monkeypatch.setattr(N, "FAN", 2)
    frame, by = wide_eras(7, 60, 18, 1e6)
    frame.loc[5, "feature_3"], frame.loc[6, "prediction"] = np.nan, np.nan
    df = spark.createDataFrame(frame).repartition(5)
    df = df.withColumns({c: F.nanvl(c, F.lit(None)) for c in (*by, "prediction")})
    sums = N.gram(df, by, ["era"]).toPandas().set_index("era")
    for era, rows in frame.dropna(subset=by).groupby("era"):
        x = rows[by].to_numpy()
        assert sums.loc[era, "_n"] == len(x)
        np.testing.assert_allclose(sums.loc[era, "_mean"], x.mean(axis=0), rtol=1e-12)
        want = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
        np.testing.assert_allclose(np.reshape(sums.loc[era, "_gram"], (18, 18)), want, rtol=1e-7, atol=1e-7)
    whole = N.gram(df, by).first()
    x = frame[by].dropna().to_numpy()
    assert whole["_n"] == len(x)
    np.testing.assert_allclose(np.reshape(whole["_gram"], (18, 18)), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rtol=1e-10)
    made = N.neutralize_partial(df, ["prediction"], by, 0.7, ["era"]).toPandas().set_index("id")["prediction"]
    assert made[[5, 6]].isna().all() and made.isna().sum() == 2
    for _, rows in frame.dropna().groupby("era"):
        np.testing.assert_allclose(made[rows["id"]], residuals(rows, by, 0.7), rtol=1e-6, atol=1e-6)


def test_rows_stay_where_they_are_while_matrices_are_smaller(spark):
    """Many rows a group and task: only matrices are dealt out. Few: the rows are."""

    def exchanges(per_era, parts):
        frame, by = wide_eras(20, per_era, 30, 1.0)
        df = stage(spark.createDataFrame(frame).repartition(parts), "wide")
        text = N.gram(df, by, ["era"])._jdf.queryExecution().executedPlan().toString()
        # The matrices are staged before, so what is left reads them only.
        assert "feature_0" not in text
        return df, by

    df, by = exchanges(400, 2)
    staged = []
    plain = N.stage
    try:
        N.stage = lambda table, tag: staged.append((tag, table._jdf.queryExecution().executedPlan().toString())) or plain(table, tag)
        N.gram(df, by, ["era"]).collect()
        tags = [t for t, _ in staged]
        assert tags == ["matrices"] and "Exchange" not in staged[0][1]
        staged.clear()
        few, by = exchanges(4, 2)
        staged.clear()
        N.gram(few, by, ["era"]).collect()
        assert [t for t, _ in staged] == ["wide-rows", "matrices"] and "Exchange hashpartitioning" in staged[1][1]
    finally:
        N.stage = plain


def test_factors_travel_as_one_array(spark, monkeypatch):
    """Both passes hand Python one array a row, made outside whole-stage code; kinds of numbers and gaps as before."""
    frame, by = wide_eras(1, 120, 225, 0.0)
    kinds = {"feature_0": F.col("feature_0") > 0, "feature_1": (F.col("feature_1") * 9).cast("int"), "feature_2": F.col("feature_2").cast("decimal(9,3)")}
    df = spark.createDataFrame(frame).withColumns(kinds).withColumn("feature_3", F.when(F.col("id") != 7, F.col("feature_3")))
    df = stage(df.drop(*by[20:]), "kinds")
    plans, plain = {}, N.stage
    monkeypatch.setattr(N, "stage", lambda t, tag: plans.update({tag: t._jdf.queryExecution().executedPlan().toString()}) or plain(t, tag))
    made = N.neutralize_full(df, keep=["id", "prediction"]).toPandas().set_index("id")["prediction"]
    for tag in ("matrices", "residuals"):
        sent = next(line for line in plans[tag].splitlines() if "MapInArrow" in line)
        project = next(line for line in plans[tag].splitlines() if "Project" in line)
        assert "_row" in sent and "feature_" not in sent and "*(" not in project
    want = df.dropna().toPandas().astype(float)
    assert np.isnan(made[7]) and made.isna().sum() == 1
    left = residuals(want, by[:20], 1.0)
    left -= left.mean()
    np.testing.assert_allclose(made[want["id"]], left / left.std(ddof=1), rtol=1e-7, atol=1e-8)


def test_products_take_one_thread():
    """Tasks of an executor do not each start as many threads as it has cores."""
    for path in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        library.scipy_openblas_set_num_threads64_(ctypes.c_int(4))
        N._one_thread()
        assert library.scipy_openblas_get_num_threads64_() == 1


@pytest.mark.parametrize("limit", ["100000000", "10"])
def test_many_factors(spark, limit):
    """225 factors, coefficients sent along or joined; a null key has no group."""
    frame, by = wide_eras(3, 400, 225, 2.0)
    df = stage(spark.createDataFrame(frame).withColumn("era", F.when(F.col("id") != 7, F.col("era"))), "many")
    spark.conf.set("spark.tidepanel.broadcastBytes", limit)
    try:
        made = N.neutralize_full(df, by=by, keys=["era"], keep=["id", "prediction"]).toPandas().set_index("id")["prediction"]
        whole = N.neutralize_full(df, by=by, keep=["id", "prediction"]).toPandas().set_index("id")["prediction"]
    finally:
        spark.conf.unset("spark.tidepanel.broadcastBytes")
    assert np.isnan(made[7]) and made.isna().sum() == 1
    for _, rows in frame[frame["id"] != 7].groupby("era"):
        left = residuals(rows, by, 1.0)
        left -= left.mean()
        np.testing.assert_allclose(made[rows["id"]], left / left.std(ddof=1), rtol=1e-6, atol=1e-7)
    np.testing.assert_allclose(whole[frame["id"]], expected_full(frame, by, 1.0), rtol=1e-5, atol=1e-6)


def test_wide_neutralization_of_nothing(spark):
    frame, by = wide_eras(1, 30, 20, 0.0)
    df = spark.createDataFrame(frame).limit(0)
    assert N.neutralize_partial(df, ["prediction"], by, 0.5, ["era"]).count() == 0
    assert N.neutralize_full(df, by=by).count() == 0


@pytest.mark.parametrize("k", [4, 20])
def test_constant_and_duplicated_factors(spark, k):
    frame = matrix(150, k, 2)
    frame["feature_1"] = frame["feature_0"]
    frame["feature_2"] = 7.0
    by = [f"feature_{i}" for i in range(k)]
    made = N.neutralize_full(spark.createDataFrame(frame), by=by).toPandas().sort_values("id")
    np.testing.assert_allclose(
        made["prediction"], expected_full(frame, by, 1.0), rtol=1e-7, atol=1e-8
    )


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = sorted(tuple(r) for r in N.standardize(df, ["a", "b"]).collect())
    assert rows == [(-1.0, 0.0), (1.0, 0.0)]


def test_inverse_normal(spark):
    points = [1e-300, 1e-20, 1e-9, 0.01, 0.074, 0.076, 0.3, 0.5, 0.924, 0.926, 0.999999]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    made = [r[0] for r in df.select(S.inverse_normal(F.col("p"))).collect()]
    for p, z in zip(points, made):
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-13, abs=1e-15)
    edge = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    assert [r[0] for r in edge.select(S.inverse_normal(F.col("p"))).collect()] == [None] * 3


def test_rank_correlation(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"p": rng.integers(0, 40, 200) / 7.0, "t": rng.integers(0, 5, 200) / 4.0})
    ranked = (frame["p"].rank() - 0.5) / frame["p"].count()
    z = ranked.map(NormalDist().inv_cdf)
    t = frame["t"] - frame["t"].mean()
    want = np.corrcoef(np.sign(z) * abs(z) ** 1.5, np.sign(t) * abs(t) ** 1.5)[0, 1]
    made = rank_correlation(spark.createDataFrame(frame), "p", "t").first()["corr"]
    assert made == pytest.approx(want, rel=1e-12)


def test_tickers(spark):
    names = [None, "", "ABC", "ABC US", "ABC PFD LN", "ABC  JP", "ABC ZZ", " ABC UQ "]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    made = df.select(S.canonical_ticker(F.col("n")), S.country_token(F.col("n"))).collect()
    assert [r[0] for r in made] == [
        None, None, None, "ABC US", "ABC GB", "ABC JP", None, "ABC US",
    ]
    assert [r[1] for r in made] == [None, None, None, "US", "PFD", "", "ZZ", "ABC"]


def test_asof_boundary(spark):
    day = dt.date(2024, 3, 20)

    def ago(n):
        return day - dt.timedelta(days=n)

    live = spark.createDataFrame([(t, day) for t in "abcde"], "k string, date date")
    panel = spark.createDataFrame(
        [("a", day, 0), ("a", ago(1), 1), ("b", ago(9), 9), ("c", ago(10), 10),
         ("d", ago(3), 3), ("d", ago(7), 7), ("e", ago(-1), -1)],
        "k string, date date, v int",
    )
    made = latest_within(live, panel, "k").collect()
    assert {(r["k"], r["days_back"], r["v"]) for r in made} == {("a", 0, 0), ("b", 9, 9), ("d", 3, 3)}
    assert latest_within(live.limit(0), panel, "k").count() == 0


def test_asof_with_hot_keys(spark, hot):
    """Cut keys, many days back, several live days between two panel days, null keys and a clashing name."""
    day0 = dt.date(2000, 1, 1)
    rng = np.random.default_rng(2)
    panel = {("a", int(d)): float(d) for d in rng.choice(900, 250, replace=False)}
    live = {(k, int(d)) for k in ("a", "b") for d in rng.choice(900, 300, replace=False)}
    days = {k: day0 + dt.timedelta(days=k) for k in range(900)}
    p = spark.createDataFrame([(k, days[d], v, d) for (k, d), v in panel.items()] + [(None, day0, 0.0, 0)], "k string, date date, v double, _live int")
    q = spark.createDataFrame([(k, days[d], d) for k, d in live] + [(None, day0, 1)], "k string, date date, asked int")
    wanted = set()
    for k, d in live:
        hits = [x for x in range(d, d - 21, -1) if (k, x) in panel]
        if hits:
            wanted.add((k, days[d], d, d - hits[0], panel[k, hits[0]]))

    def run():
        made = latest_within(q, p, "k", days=20)
        assert made.columns == ["k", "date", "asked", "days_back", "found_date", "v", "_live"]
        return {(r["k"], r["date"], r["asked"], r["days_back"], r["v"]) for r in made.collect()}

    assert run() == wanted
    hot(50)
    assert run() == wanted


def test_sample_counts_by_hash_ranges(spark, monkeypatch):
    """Every size, ranges of any depth, repeated rows: always the first rows in hash order."""
    import hashlib

    from tidepanel.operators import features

    ids = [str(i) for i in range(3000)] + ["same"] * 40
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int").repartition(5)
    order = sorted(ids, key=lambda i: hashlib.md5(f"7{chr(31)}{i}".encode()).hexdigest())
    monkeypatch.setattr(features, "ORDERED_ROWS", 3)
    monkeypatch.setattr(features, "DIGITS", 1)
    at = order.index("same")
    for n in (0, 1, 500, at + 13, 3039, 3040, 5000):
        made = features.hashed_sample(df, ["id"], n, seed=7)
        assert made.columns == ["id", "n"] and sorted(r["id"] for r in made.collect()) == sorted(order[:n])
    text = features.hashed_sample(df, ["id"], 1500, seed=7)._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in text and "Union" in text
    assert features.hashed_sample(df.limit(0), ["id"], 5).count() == 0


def test_merging_aggregate_of_a_hot_group(spark, monkeypatch):
    """A group over many tasks and many states equals one that a single task sees."""
    from tidepanel.operators import series_functions as SF

    monkeypatch.setattr(SF, "HELD_STATES", 2)
    frame = pd.DataFrame({"k": ["hot"] * 5000 + [f"k{i % 7}" for i in range(70)], "x": np.arange(5070) % 101.0})
    df = spark.createDataFrame(frame).withColumn("x", F.when(F.col("x") != 5, F.col("x")))
    df = df.unionByName(spark.createDataFrame([(None, 2.0)], "k string, x double"))

    def run(rows):
        made = SF.merged_aggregate(
            rows, ["k"], ["x"], "n long, middle double",
            start=lambda: [],
            update=lambda s, x: s + [v for v in x["x"].tolist() if v == v],
            merge=lambda a, b: a + b,
            finish=lambda s: (len(s), float(np.median(s))),
        )
        return {r["k"]: (r["n"], r["middle"]) for r in made.collect()}

    many, one = run(df.repartition(16)), run(df.coalesce(1))
    kept = frame[frame["x"] != 5].groupby("k")["x"]
    wanted = {k: (len(v), float(v.median())) for k, v in kept} | {None: (1, 2.0)}
    assert many == one == wanted
    assert run(df.limit(0)) == {}


def test_ratio_guard(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, inf), (1.0, 2.0)], "a double, b double")
    plain = [r[0] for r in df.select(S.guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert plain == [1e8, None, 0.0, 0.5]
    both = df.select(S.guarded_ratio(F.col("a"), F.col("b"), missing=True, infinite=True))
    assert [r[0] for r in both.collect()] == [1e8, 1e8, 1e8, 0.5]


def test_factor_choice():
    names = [f"f{i}" for i in range(30)]
    assert choose_factors(names) == names[:20]
    grouped = names + [f"g{i}_group" for i in range(6)]
    assert choose_factors(grouped) == [f"g{i}_group" for i in range(6)]
    assert choose_factors(["a", "b"], {"a": 1.0, "b": 2.0, "z": 9.0}) == ["b", "a"]


def test_wide_quotes(spark):
    wide = spark.createDataFrame(
        [(1, 2.0, 3.0, None), (2, None, None, 4.0)], "date int, `close|A` double, `volume|A` double, `close|B` double"
    )
    made = quotes_to_panel(wide, "date", ["close", "volume"]).collect()
    assert {tuple(r) for r in made} == {(1, "A", 2.0, 3.0), (2, "B", 4.0, None)}


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2.5), (2**40, float("nan"))], "a long, b double")
    clean = nan_to_null(df)
    assert clean.filter("b is null").count() == 1
    narrow = narrow_numeric(clean)
    assert [f.dataType.simpleString() for f in narrow.schema] == ["int", "float"]
    assert narrow.filter("a is null").count() == 1
    assert ensure_columns(clean, ["z", "a"]).columns == ["z", "a"]


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(500)
    one = {r[0] for r in hashed_sample(df.repartition(7), ["id"], 50).collect()}
    two = {r[0] for r in hashed_sample(df.coalesce(1), ["id"], 50).collect()}
    assert one == two and len(one) == 50
