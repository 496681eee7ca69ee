"""Physical plans, models and sinks."""

import datetime
import importlib
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidepanel.operators import models as M
from tidepanel.operators.cross_section import peer_means, percent_rank, quintiles, with_group_means
from tidepanel.operators.indicators import PAIRS, PERIODS, WINDOW_KINDS
from tidepanel.operators.recurrence import RECURRENCE_KINDS, recurrence_indicators
from tidepanel.operators.asof import latest_within
from tidepanel.plans import panel as P
from tidepanel.plans.panel import indicators
from tidepanel.shipping import ship
from tidepanel.sources import fixtures as X
from tidepanel.sources import sinks, staging
from tidepanel.sources.frames import read_importance
from tidepanel.sources.staging import clear_staging, stage, staging_path

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def closes(spark):
    return X.landed_closes(spark, SF)


def test_all_indicators_and_returns_share_one_exchange_of_the_narrow_panel(closes):
    made = indicators(closes, "ticker", PERIODS, PAIRS, RECURRENCE_KINDS, WINDOW_KINDS, PAIRS, PAIRS, returns="ret")
    text = plan(made)
    assert text.count("Exchange hashpartitioning") == text.count("FlatMapGroupsInArrow") == 1
    # No window frame is evaluated at all, whatever the number of lengths.
    assert "Window" not in text and "SinglePartition" not in text
    assert len(made.columns) == 3 + 36 + 1


def test_recurrences_take_one_python_pass(closes):
    text = plan(recurrence_indicators(closes))
    assert text.count("FlatMapGroupsInArrow") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_group_means_do_not_shuffle_rows(closes):
    text = plan(with_group_means(closes, ["date"], ["close"], "mean_"))
    assert "BroadcastHashJoin" in text
    assert "SinglePartition" not in text


def test_ranks_within_groups_use_no_single_partition(closes):
    assert "SinglePartition" not in plan(percent_rank(closes, ["date"], "close", "p"))
    assert "SinglePartition" not in plan(quintiles(closes, ["date"], ["close"]))


def test_quintiles_shuffle_the_rows_once(closes):
    text = plan(quintiles(closes, ["date"], ["close"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text and "percentile" not in text


def test_peer_groups_share_one_scan_of_the_rows(closes):
    wide = stage(closes.withColumns({"industry": F.col("ticker") % 5, "sector": F.col("ticker") % 3, "label": F.lit("x")}), "wide")
    groups = {f"{p}_ret": ["date", p] for p in ("industry", "sector")}
    text = plan(peer_means(wide, groups, "close"))
    # One scan of the rows themselves, one of the staged sums for each group.
    assert text.count("label") and text.count("_sum") and text.count("FileScan") == 3
    assert sum("label" in line for line in text.splitlines() if "FileScan" in line) == 1


def test_scan_is_pruned_and_filtered(spark):
    from tidepanel.sources.frames import scan

    df = scan(
        spark, f"{SF}/lineitem.parquet", ["l_orderkey"], F.col("l_returnflag") == "R"
    )
    text = plan(df)
    assert "EqualTo(l_returnflag,R)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def synthetic(spark, rows=600):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"feature_a": rng.normal(size=rows), "feature_b": rng.normal(size=rows)})
    frame["target"] = np.where(frame["feature_a"] > 0, 1.0, 0.0) + 0.1 * rng.normal(size=rows)
    frame["era"] = [f"{i % 20:04}" for i in range(rows)]
    frame["id"] = np.arange(rows)
    return spark.createDataFrame(frame)


def test_boosted_trees_learn_and_repeat(spark):
    df = stage(synthetic(spark), "synthetic")
    features = ["feature_a", "feature_b"]
    runs = []
    for _ in range(2):
        model = M.fit_boosted(df, features, "target", validation=df, maxIter=5, maxDepth=3)
        scored = model.transform(df).orderBy("id")
        runs.append([r["prediction"] for r in scored.select("prediction").collect()])
    assert runs[0] == runs[1]
    target = np.array([r["target"] for r in df.orderBy("id").collect()])
    assert np.mean((np.array(runs[0]) - target) ** 2) < 0.5 * target.var()
    assert M.importance(model, features)[0][0] == "feature_a"


def test_boosting_keeps_the_best_round(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({f"f{i}": rng.normal(size=1500) for i in range(4)})
    frame["target"] = sum(np.sin(frame[f"f{i}"]) for i in range(4)) + rng.normal(size=1500)
    df = stage(spark.createDataFrame(frame), "additive")
    train, held = df.filter("f0 + f1 < 0.8"), df.filter("f0 + f1 >= 0.8")
    features = ["f0", "f1", "f2", "f3"]
    full = M.fit_boosted(train, features, "target", maxIter=12, maxDepth=2, stepSize=0.5)
    ready = full.transform(held).drop("prediction")
    errors = full.stages[-1].evaluateEachIteration(ready, "squared")
    kept = M.fit_boosted(train, features, "target", held, maxIter=12, maxDepth=2, stepSize=0.5)
    assert kept.stages[-1].getNumTrees == int(np.argmin(errors)) + 1
    with pytest.raises(ValueError, match="validation rows"):
        M.fit_boosted(train, features, "target", held.limit(0), maxIter=2)


def test_a_prefix_is_the_refit(spark, tmp_path):
    """The first rounds of a model predict what a fit of so many rounds does, also after a reload."""
    df = stage(synthetic(spark), "synthetic")
    ready = stage(M.assemble(df, ["feature_a", "feature_b"]), "vectors")
    learner = M.boosted("target", "made", maxIter=9, maxDepth=3)
    model = learner.fit(ready)
    for rounds in (1, 4, 9):
        cut = M.first_rounds(model, rounds)
        assert cut.getNumTrees == rounds and cut.getPredictionCol() == "made" and cut.getLabelCol() == "target"
        again = learner.copy({learner.maxIter: rounds}).fit(ready)
        cut.write().overwrite().save(str(tmp_path / "cut"))
        loaded = type(cut).load(str(tmp_path / "cut"))
        values = [[r["made"] for r in m.transform(ready).orderBy("id").select("made").collect()] for m in (cut, again, loaded)]
        assert values[0] == values[1] == values[2]
        assert len(cut.featureImportances) == 2


def test_errors_of_all_rounds_in_one_pass(spark):
    df = stage(synthetic(spark), "synthetic")
    ready = stage(M.assemble(df, ["feature_a", "feature_b"]).repartition(3), "vectors")
    model = M.boosted("target", maxIter=12, maxDepth=4).fit(ready)
    errors = M.round_errors(model, ready, "target")
    np.testing.assert_allclose(errors, model.evaluateEachIteration(ready, "squared"), rtol=1e-9)
    # A stump and a model of a single leaf have the same shape.
    flat = M.boosted("target", maxIter=2, maxDepth=0).fit(ready)
    np.testing.assert_allclose(M.round_errors(flat, ready, "target"), flat.evaluateEachIteration(ready, "squared"), rtol=1e-9)


def test_splits_learn_where_missing_values_go(spark):
    """A target that is high above a value and also where the value is missing: below all others is wrong."""
    rng = np.random.default_rng(8)
    rows = 4000
    frame = pd.DataFrame({"f": rng.uniform(0, 1, rows), "g": rng.uniform(0, 1, rows), "id": np.arange(rows)})
    missing = rng.uniform(0, 1, rows) < 0.3
    frame["target"] = np.where(missing | (frame["f"] > 0.7), 1.0, 0.0) + 0.05 * rng.normal(size=rows)
    frame.loc[missing, "f"] = np.nan
    df = stage(spark.createDataFrame(frame).withColumn("f", F.nanvl("f", F.lit(None))), "gaps")
    train, held = df.filter("id < 3000"), df.filter("id >= 3000")
    assert M.with_gaps(train, ["f", "g"]) == ["f"] and M.with_gaps(train.limit(0), ["f", "g"]) == []

    def error(scored):
        return scored.agg(F.avg((F.col("prediction") - F.col("target")) ** 2)).first()[0]

    model = M.fit_boosted(train, ["f", "g"], "target", held, maxIter=3, maxDepth=1, stepSize=1.0)
    medians = Pipeline(stages=[*M._median_vector(["f", "g"], "features"), M.boosted("target", maxIter=3, maxDepth=1, stepSize=1.0)]).fit(train)
    below = M.boosted("target", maxIter=3, maxDepth=1, stepSize=1.0).fit(M.assemble(train, ["f", "g"]))
    learned = error(model.transform(held))
    assert learned < 0.02 and 3 * learned < min(error(medians.transform(held)), error(below.transform(M.assemble(held, ["f", "g"]))))
    assert [f for f, _ in M.importance(model, ["f", "g"])] == ["f", "g"]
    assert abs(sum(w for _, w in M.importance(model, ["f", "g"])) - 1) < 1e-9
    folds = M.fit_folds(train.withColumn("era", F.format_string("%04d", F.col("id") % 20)), ["f", "g"], "target", n_folds=2, step=2, maxIter=3, maxDepth=1, stepSize=1.0)
    assert folds.gaps == ["f"] and error(M.predict_folds(folds, ["f", "g"], held)) < 0.03
    three = M.fit_three(train, ["f", "g"], "target", held, maxIter=3, maxDepth=1, stepSize=1.0)
    assert M.predict_three(three, held).filter("prediction is null").count() == 0


def test_a_small_model_chooses_features(spark):
    df = stage(synthetic(spark).withColumn("feature_c", F.rand(3)), "synthetic")
    names = ["feature_c", "feature_a", "feature_b"]
    assert M.most_important(df, names, "target", 3) == names
    assert M.most_important(df, names, "target", 1, maxIter=3) == ["feature_a"]


def test_best_round_waits_for_patience():
    errors = [5, 4, 4.5, 4.2, 3, 3.5]
    assert M.best_round(errors, 10) == 5
    assert M.best_round(errors, 3) == 5
    assert M.best_round(errors, 2) == 2


def test_folds_need_eras(spark):
    with pytest.raises(ValueError, match="need over 20 eras; there are 20"):
        M.fit_folds(synthetic(spark, 60), ["feature_a"], "target", n_folds=5, step=5)


def test_package_reaches_the_executors(spark):
    """Workers that cannot see this folder import the package from what was shipped."""
    ship(spark)
    here = str(Path(__file__).resolve().parents[1])

    def where(batches):
        # As on an executor elsewhere: neither this folder nor modules that came from it.
        sys.path[:] = [p for p in sys.path if Path(p or ".").resolve() != Path(here)]
        for name in [m for m in sys.modules if m.split(".")[0] == "tidepanel"]:
            del sys.modules[name]
        importlib.invalidate_caches()
        made = importlib.import_module("tidepanel.operators.recurrence")
        values = made.series_values(np.arange(5.0), (3,), (), ("EMA",))["EMA_3"]
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"file": [made.__file__], "value": [float(values[-1])]})

    found = spark.range(1).mapInArrow(where, "file string, value double").collect()
    assert found and all(".zip" in r["file"] and not r["file"].startswith(here) and r["value"] == 3.0 for r in found)


def test_fold_models(spark):
    df = stage(synthetic(spark), "synthetic")
    features = ["feature_a", "feature_b"]
    models = M.fit_folds(df, features, "target", n_folds=3, step=2, maxIter=2, maxDepth=2)
    assert len(models) == 4
    errors = M.fold_errors(models, features, "target", df).toPandas()
    assert sorted(errors["fold"]) == [0, 1, 2]
    assert (errors["mae"] < 0.5).all()


def test_search_history_grows(spark):
    df = stage(synthetic(spark, 300), "synthetic")
    path = staging_path(spark, "history")
    table, best = M.search(df, df, ["feature_a"], "target", path, trials=2, rounds=1)
    assert sorted(r["trial"] for r in table.collect()) == [0, 1]
    table, best = M.search(df, df, ["feature_a"], "target", path, trials=1, rounds=1)
    assert sorted(r["trial"] for r in table.collect()) == [0, 1, 2]
    assert isinstance(best["maxDepth"], int)


def test_search_halves_its_trials(spark):
    assert M.rungs(9, 18) == [(9, 2), (3, 6), (1, 18)]
    assert M.rungs(3, 10) == [(3, 3), (1, 10)] and M.rungs(2, 10) == [(2, 10)] and M.rungs(9, 2) == [(9, 2)]
    df = stage(synthetic(spark, 300), "synthetic")
    table, best = M.search(df, df, ["feature_a", "feature_b"], "target", staging_path(spark, "history"), trials=9, rounds=9)
    rows = table.collect()
    assert sum(r["rounds"] for r in rows) == 27 < 81
    for rung in (0, 1):
        order = sorted((r for r in rows if r["rung"] == rung), key=lambda r: (-r["score"], r["trial"]))
        assert sorted(r["trial"] for r in rows if r["rung"] == rung + 1) == sorted(r["trial"] for r in order[: len(order) // 3])
    (last,) = [r for r in rows if r["rung"] == 2]
    assert best == M.typed_params(last["params"])
    model = M.refit(df, df, ["feature_a", "feature_b"], "target", best, rounds=4)
    assert model.stages[-1].getMaxDepth() == best["maxDepth"] and model.stages[-1].getNumTrees <= 4


def test_a_failing_fit_is_heard(spark):
    def fail():
        raise RuntimeError("no fit")

    with pytest.raises(RuntimeError, match="no fit"):
        M.together([fail, lambda: 1])


def test_diagnostics_by_date(spark, closes):
    path = staging_path(spark, "diagnostics")
    few = closes.filter("date < '1995-02-01'").withColumn("signal", F.lit(0.5))
    sinks.write_diagnostics(few, path, "ticker", "date", "signal", by_date=True)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == few.count()
    assert set(back.columns) == {"ticker", "signal", "date"}


def test_staged_tables_can_be_cleared(spark, monkeypatch, tmp_path):
    """In a folder of its own, so that the tables of other tests stay."""
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path))
    kept = stage(spark.range(3), "x")
    assert kept.count() == 3 and list(tmp_path.rglob("*.parquet"))
    clear_staging(spark)
    assert not list(tmp_path.rglob("*.parquet"))
    clear_staging(spark)


def test_asof_moves_one_wide_row_per_live_row(spark, closes):
    live = X.live_universe(spark, SF)
    wide = stage(closes.withColumns({f"wide_{i}": F.lit(i) for i in range(5)}), "wide")
    text = plan(latest_within(live, wide, "ticker"))
    assert "Generate" not in text
    # The wide columns are read by one scan only, and not before the days have been found.
    assert sum("wide_0" in line for line in text.splitlines() if "FileScan" in line) == 1
    assert all("wide_0" not in line for line in text.splitlines() if "Window" in line)


def test_importance_file(spark, tmp_path):
    assert read_importance(spark, str(tmp_path / "none.json")) is None
    (tmp_path / "some.json").write_text('{"feature_a": 0.5,\n "feature_b": 2}')
    assert read_importance(spark, str(tmp_path / "some.json")) == {"feature_a": 0.5, "feature_b": 2.0}


def test_histograms_grow_the_trees_of_mllib(spark, monkeypatch):
    """The same trees, with gaps, early stopping and folds, also when nodes are judged in tasks."""
    rng = np.random.default_rng(3)
    rows = [(i, f"{i % 15:02}", float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(rng.integers(0, 5, 1500), rng.normal(size=1500).round(2), rng.normal(size=1500), strict=True))]
    df = spark.createDataFrame(rows, "id int, era string, a double, b double, c double")
    df = df.withColumn("target", F.col("a") * 0.3 + F.sin("b") + F.col("c") * 0.2).withColumn("b", F.when(F.col("id") % 7 > 0, F.col("b"))).cache()
    train, held = df.filter("id % 3 < 2"), df.filter("id % 3 = 2")
    params = {"maxDepth": 3, "stepSize": 0.5}

    def fits():
        stopped = M.fit_boosted(train, ["a", "b"], "target", held, maxIter=6, patience=2, **params)
        folds = M.fit_folds(df, ["a", "b"], "target", maxIter=3, final_rounds=2, **params)
        scored = M.predict_folds(folds, ["a", "b"], stopped.transform(df).select("id", "a", "b", F.col("prediction").alias("one")))
        made = scored.orderBy("id").select("one", "prediction").toPandas().to_numpy()
        return made, [stopped.stages[-1].getNumTrees, *[m.getNumTrees for m in folds]], M.importance(stopped, ["a", "b"])

    ours = fits()
    monkeypatch.setattr("tidepanel.operators.histograms.TOLD_BYTES", 0)
    again = fits()
    monkeypatch.setattr(M, "fits_by_histograms", lambda learner: False)
    theirs = fits()
    for made in (ours, again):
        assert np.allclose(made[0], theirs[0], atol=1e-9) and made[1] == theirs[1]
        assert [n for n, _ in made[2]] == [n for n, _ in theirs[2]]
        assert np.allclose([w for _, w in made[2]], [w for _, w in theirs[2]])


def test_a_fit_spreads_rows_that_lie_in_one_file(spark):
    """Columns of few values take few bytes, so a scan may give one task most rows."""
    from tidepanel.operators import histograms as H

    rows = spark.range(0, 200_000, 1, 1).select((F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("target"))
    boosting = H.Boosting(rows, ["a"], [M.boosted("target", maxIter=1)], [F.lit(H.TRAIN)])
    held = [r["n"] for r in boosting._blocks().select("n").collect()]
    assert sum(held) == 200_000 and len(held) >= spark.sparkContext.defaultParallelism
    assert M.dealt(rows.limit(500), 1).rdd.getNumPartitions() == 1


def test_boosting_ends_with_its_patience(spark, monkeypatch):
    """No round is fitted after the one at which early stopping ends."""
    from tidepanel.operators import histograms as H

    df = spark.createDataFrame([(float(i % 4), float(i % 2), float(i)) for i in range(400)], "f double, noise double, id double")
    train, held = df.withColumn("target", F.col("f")), df.withColumn("target", -F.col("f"))
    rounds, grow = [], H.Boosting._grow

    def counted(self, fit, tree, found, level):
        rounds.extend([1] if level == 0 else [])
        grow(self, fit, tree, found, level)

    monkeypatch.setattr(H.Boosting, "_grow", counted)
    model = M.fit_boosted(train, ["f", "noise"], "target", held, maxIter=40, patience=3)
    assert model.stages[-1].getNumTrees == 1 and len(rounds) <= 5


def test_crypto_targets_meet_the_narrow_panel(spark):
    """Targets that come twice or not at all join as before, and the wide rows are shuffled by date only."""
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(i) for i in range(30)]
    quotes = spark.createDataFrame([(d, k, float(10 + k + (i * (k + 3)) % 7)) for k in range(6) for i, d in enumerate(days)], "date date, symbol int, close double")
    targets = [(days[25], 1, 1.0), (days[25], 1, 0.0), (days[26], 1, None), (days[27], 2, 0.5)]
    targets = spark.createDataFrame(targets, "date date, symbol int, target double")
    made = P.crypto_features(quotes, targets, min_rows=20, periods=(3,), pairs=(), recurrences=(), windows=("SMA", "MOM"), macd=False)
    assert made._jdf.queryExecution().toString().count("Join ") == 0
    found = [(r["date"], r["symbol"], r["target"]) for r in made.collect()]
    assert len(found) == 6 * 27 + 1
    assert sorted(t for d, k, t in found if (d, k) == (days[25], 1)) == [0.0, 1.0]
    assert [t for d, k, t in found if (d, k) == (days[27], 2)] == [0.5] and sum(t is not None for *_, t in found) == 3


def test_trials_on_samples_of_rows_share_their_passes(spark, monkeypatch):
    """A search and the choice of features fit by histograms too, and a round sees about its share of the rows."""
    from tidepanel.operators import histograms as H

    df = stage(synthetic(spark, 2000), "synthetic")
    features = ["feature_a", "feature_b"]
    learners = [M.boosted("target", maxIter=3, maxDepth=2, subsamplingRate=r) for r in (0.2, 0.2, 1.0)]
    grown, passes, one = [], [], H.Boosting._pass

    def seen(self, *asked):
        passes.append(len(asked[2]))
        return one(self, *asked)

    monkeypatch.setattr(H.Boosting, "_pass", seen)
    monkeypatch.setattr(H.Boosting, "_model", lambda self, fit, trees: grown.append([t.moments[0][0] for t in trees]))
    boosting = H.Boosting(df, features, learners, [F.lit(H.TRAIN)] * 3)
    boosting.fit([None] * 3)
    total = df.filter("target is not null").count()
    assert grown[2] == [total] * 3 and grown[0] == grown[1] and len(set(grown[0])) > 1
    assert all(0.15 * total < n < 0.25 * total for n in grown[0])
    packed = boosting.packed()
    boosting.fit([None] * 3, {1: 2}, packed)
    boosting.fit([None] * 3, {1: 3}, packed)
    packed.unpersist()
    assert grown[3] == grown[0][:2] and grown[4] == grown[0]
    monkeypatch.undo()

    def alone(self, *_):
        raise AssertionError("a fit of its own")

    monkeypatch.setattr(H.Boosting, "_pass", seen)
    monkeypatch.setattr(M.GBTRegressor, "fit", alone)
    passes.clear()
    M.search(df, df, features, "target", staging_path(spark, "history"), trials=9, rounds=9)
    assert max(passes) == 9 and len(passes) <= 5 * 13
    assert M.most_important(df, features, "target", 1) in (["feature_a"], ["feature_b"])


def test_samples_of_rows_are_those_of_mllib(spark, monkeypatch):
    df = stage(synthetic(spark, 3000).repartition(3, "id"), "synthetic")
    train, held = df.filter("id % 3 < 2"), df.filter("id % 3 = 2")
    params = {"maxIter": 4, "maxDepth": 3, "subsamplingRate": 0.4, "minInstancesPerNode": 7}

    def fits():
        made = M.fit_boosted(train, ["feature_a", "feature_b"], "target", held, patience=3, **params).transform(df)
        return np.sort(made.toPandas()["prediction"].to_numpy())

    ours = fits()
    monkeypatch.setattr(M, "fits_by_histograms", lambda learner: False)
    assert np.allclose(ours, fits(), atol=1e-9)


def test_a_round_that_draws_no_row_adds_nothing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 0.0)], "a double, target double").coalesce(1)
    model = M.fit_trees(df, ["a"], "target", maxIter=2, subsamplingRate=1e-9)
    assert model.predict(Vectors.dense([1.0])) == 0.0


def test_equity_indicators_are_not_written(spark, closes, monkeypatch):
    """Only narrow rows are staged on the way to the feature table."""
    staged, write = [], staging.stage

    def seen(df, tag):
        staged.append(df.columns)
        return write(df, tag)

    for module in ("operators.cross_section", "operators.lookup", "operators.skew", "plans.panel"):
        monkeypatch.setattr(f"tidepanel.{module}.stage", seen)
    made = P.equity_features(closes, X.ticker_map(spark, SF), X.sectors(spark, SF), periods=(3,), pairs=((2, 3),), recurrences=("EMA",), windows=("SMA",))
    assert "SMA_3_quintile" in made.columns and {c for c in made.columns if "_ret" in c} >= {"sector_ret", "country_ret"}
    assert staged and not [c for c in staged if {"SMA_3", "EMA_3"} & set(c)]
    assert made.count() > 0


def test_rows_that_agree_in_features_and_roles_are_merged(spark, monkeypatch):
    """Merged rows are few, and fits on them, draws and held-out rows too, are those on the rows themselves."""
    from tidepanel.operators import histograms as H

    rng = np.random.default_rng(12)
    frame = pd.DataFrame({"a": rng.integers(0, 5, 4000), "b": rng.integers(0, 4, 4000) / 3, "held": rng.random(4000) < 0.2})
    frame["target"] = np.sin(frame["a"]) * frame["b"] + rng.normal(size=4000)
    rows = spark.createDataFrame(frame).repartition(3).cache()
    learners = [M.boosted("target", maxIter=12, maxDepth=3), M.boosted("target", maxIter=4, maxDepth=2, subsamplingRate=0.5)]
    roles = [F.when(F.col("held"), H.HELD).otherwise(H.TRAIN), F.lit(H.TRAIN)]

    def fitted():
        boosting = H.Boosting(rows, ["a", "b"], learners, roles)
        models = boosting.fit([3, None])
        scores = [[m.predict(Vectors.dense([a, b / 3])) for a in range(5) for b in range(4)] for m in models]
        return boosting._blocks().agg(F.sum("n")).first()[0], [m.getNumTrees for m in models], np.array(scores)

    count, single, scores = fitted()
    assert count == len(frame)
    monkeypatch.setattr(H, "MERGED_ROWS", 1000)
    count, merged, same = fitted()
    assert count == len(frame.drop_duplicates(["a", "b", "held"]))
    assert merged == single
    np.testing.assert_allclose(same, scores, rtol=1e-9)
