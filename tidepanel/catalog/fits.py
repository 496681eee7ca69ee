"""Neutralization and models."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.catalog.registry import query, rounded
from tidepanel.catalog.sql import over
from tidepanel.operators import models as M
from tidepanel.operators.boosting import Trees
from tidepanel.operators.neutralize import neutralize_full, neutralize_partial
from tidepanel.operators.splits import by_label
from tidepanel.plans.tournament import searched_score
from tidepanel.sources import fixtures as X
from tidepanel.sources import sinks
from tidepanel.sources.staging import stage, staging_path

FEATURES = list(X.MATRIX_FEATURES)


def residual_sql(part: str, proportion: float, constant: bool, scaled: bool) -> str:
    """Residual on all five factors: each in turn is taken out of the score and of the later factors."""
    by = f"partition by {part}" if part else ""
    k = len(FEATURES)
    centered = ", ".join(f"{c} - avg({c}) over ({by}) as f{i}" for i, c in enumerate(FEATURES))
    steps = [
        f"s0 as (select id, era, prediction, avg(prediction) over ({by}) as ms, prediction - avg(prediction) over ({by}) as y, {centered} from matrix)"
    ]
    for i in range(k):

        def without(column, i=i):
            share = f"sum({column} * f{i}) over ({by}) / nullif(sum(f{i} * f{i}) over ({by}), 0)"
            return f"{column} - coalesce({share}, 0) * f{i} as {column}"

        rest = "".join(f", {without(f'f{j}')}" for j in range(i + 1, k))
        steps.append(f"s{i + 1} as (select id, era, prediction, ms, {without('y')}{rest} from s{i})")
    mean = "ms" if constant else "0"
    value = f"r / stddev_samp(r) over ({by})" if scaled else "r"
    return over(
        "matrix",
        body=f"""@{", ".join(steps)},
        r as (select id, era, prediction - {proportion}::double * ({mean} + prediction - ms - y) as r from s{k})
        select id, round({value}, 6) as prediction from r""",
    )


def _rows(spark, sf_dir):
    return X.matrix(spark, sf_dir).select("id", "era", "prediction", *FEATURES)


def _result(df):
    return rounded(df.select("id", "prediction"), 6, "prediction")


@query("n1_full_neutralization", residual_sql("", 1.0, True, True))
def full_neutralization(spark, sf_dir):
    return _result(neutralize_full(_rows(spark, sf_dir)))


@query("n2_partial_neutralization", residual_sql("", 0.6, False, False))
def partial_neutralization(spark, sf_dir):
    return _result(neutralize_partial(_rows(spark, sf_dir), ["prediction"], FEATURES, 0.6))


@query("n3_era_neutralization", residual_sql("era", 1.0, True, True))
def era_neutralization(spark, sf_dir):
    return _result(neutralize_full(_rows(spark, sf_dir), keys=["era"]))


@query("n3_era_partial_neutralization", residual_sql("era", 0.5, False, False))
def era_partial_neutralization(spark, sf_dir):
    return _result(neutralize_partial(_rows(spark, sf_dir), ["prediction"], FEATURES, 0.5, ["era"]))


@query("n4_present_factors", residual_sql("", 0.6, False, False))
def present_factors(spark, sf_dir):
    wanted = ["feature_absent", *FEATURES, "feature_gone"]
    return _result(neutralize_partial(_rows(spark, sf_dir), ["prediction"], wanted, 0.6))


# The names under which all five features were registered while the ones above took two.
query("n1_full_neutralization_all")(full_neutralization)
query("n2_partial_neutralization_all")(partial_neutralization)
query("n3_era_neutralization_all")(era_neutralization)
query("n3_era_partial_neutralization_all")(era_partial_neutralization)
query("n4_present_factors_all")(present_factors)


@query("n1_vector_neutralization")
def vector_neutralization(spark, sf_dir):
    """All 64 vector entries as factors, which takes the matrix-product path."""
    rows = X.vectors(spark, sf_dir).withColumnRenamed("target", "prediction").drop("label")
    return neutralize_full(rows).select("vec_id", F.round("prediction", 6).alias("prediction"))


def staircase(spark, sf_dir, k: int):
    """The matrix with ``k`` strongly related factors: whether a row's cell, 0 to ``k``, is below each step."""
    part = F.split("id", "-")
    cell = F.pmod(part[2].cast("long") * 31 + part[3].cast("long"), F.lit(k + 1))
    rows = X.matrix(spark, sf_dir).select("id", "era", "prediction", cell.alias("cell"))
    steps = [(F.col("cell") <= i).cast("double").alias(f"feature_{i}") for i in range(k)]
    return rows.select("id", "era", "prediction", *steps)


def staircase_sql(k: int, part: str = "") -> str:
    """The steps span all functions of the cell, so the residual is the distance from the cell's mean."""
    within = f"{part}, cell" if part else "cell"
    by = f"partition by {part}" if part else ""
    return over(
        "matrix",
        body=f"""@c as (select id, era, prediction, (cast(split_part(id, '-', 3) as bigint) * 31
            + cast(split_part(id, '-', 4) as bigint)) % {k + 1} as cell from matrix),
        r as (select id, era, prediction - avg(prediction) over (partition by {within}) as r from c)
        select id, round(r / stddev_samp(r) over ({by}), 6) as prediction from r""",
    )


@query("n1_many_factors", staircase_sql(225))
def many_factors(spark, sf_dir):
    """225 factors."""
    return _result(neutralize_full(staircase(spark, sf_dir, 225), keep=["id", "prediction"]))


@query("n1_most_factors", staircase_sql(780))
def most_factors(spark, sf_dir):
    """780 factors."""
    return _result(neutralize_full(staircase(spark, sf_dir, 780), keep=["id", "prediction"]))


@query("n3_era_many_factors", staircase_sql(40, "era"))
def era_many_factors(spark, sf_dir):
    """40 factors within every era."""
    return _result(neutralize_full(staircase(spark, sf_dir, 40), keys=["era"], keep=["id", "prediction"]))


def parts(spark, sf_dir):
    """Train, validation and test rows of the matrix, staged once for the fits that reread them."""
    matrix = stage(X.matrix(spark, sf_dir).drop("prediction"), "matrix")
    return tuple(by_label(matrix, "data_type", v) for v in ("train", "validation", "test"))


#: Rounds that leave early stopping room for its patience.
STOPPED = {"maxIter": 2 * M.PATIENCE}


@query("l1_boosted_early_stop")
def boosted_early_stop(spark, sf_dir):
    train, validation, test = parts(spark, sf_dir)
    model = M.fit_boosted(train, FEATURES, "target", validation, **STOPPED)
    return model.transform(test).select("id", "prediction")


@query("l2_boosted")
def boosted(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    model = M.fit_boosted(train, FEATURES, "target")
    return model.transform(test).select("id", "prediction")


@query("l3_two_targets")
def two_targets(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    model = M.fit_targets(train, FEATURES, ["target", "target_late"])
    scored = model.transform(test)
    return scored.select("id", "prediction_target", "prediction_target_late")


@query("l4_three_learners")
def three_learners(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    model = M.fit_three(train, FEATURES, "target")
    return M.predict_three(model, test.select("id", *FEATURES)).select("id", "prediction")


@query("l5_fold_ensemble")
def fold_ensemble(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    models = M.fit_folds(train, FEATURES, "target")
    scored = M.predict_folds(models, FEATURES, test.select("id", *FEATURES))
    return scored.select("id", "prediction")


def trials_path(spark):
    return staging_path(spark, "trials")


@query("l6_random_search")
def random_search(spark, sf_dir):
    train, validation, _ = parts(spark, sf_dir)
    table, _ = M.search(train, validation, FEATURES, "target", trials_path(spark), trials=9, rounds=18)
    return table.select("trial", "rung", "rounds", "score", F.map_keys("params").alias("names"))


@query("l6_search_submission")
def search_submission(spark, sf_dir):
    """Search, fit with the best parameters, predict, rank."""
    train, validation, test = parts(spark, sf_dir)
    return searched_score(train, validation, test, FEATURES, trials_path(spark), trials=3, rounds=40, patience=20)


@query("l7_batch_scoring")
def batch_scoring(spark, sf_dir):
    """The boosted model's trees as a scorer of Arrow batches."""
    train, _, _ = parts(spark, sf_dir)
    return _scored_in_batches(M.fit_boosted(train, FEATURES, "target"), X.matrix(spark, sf_dir).drop("prediction"))


def _scored_in_batches(model, rows):
    trees = Trees(model.stages[-1])

    def predict(frame):
        *_, made = trees.rounds(frame.to_numpy(float))
        return pd.Series(made)

    # The features of the matrix have no gaps: their vector is the columns themselves.
    return M.score_in_batches(rows, predict, FEATURES, ["id"])


@query("l8_feature_importance")
def feature_importance(spark, sf_dir):
    train, _, _ = parts(spark, sf_dir)
    model = M.fit_boosted(train, FEATURES, "target")
    return spark.createDataFrame(M.importance(model, FEATURES), "feature string, importance double")


@query("t5_top_by_importance")
def top_by_importance(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    rows = train.filter(F.col("target").isNotNull())
    return _top(test, M.fit_trees(rows, FEATURES, "target"))


def _top(test, model):
    sliced = M.slice_top(M.assemble(test, FEATURES), model, 3)
    return sliced.select("id", vector_to_array("top_features").alias("top_features"))


@query("a10_saved_scorer")
def saved_scorer(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    return _reloaded(spark, M.fit_boosted(train, FEATURES, "target"), test)


def _reloaded(spark, model, test):
    path = staging_path(spark, "scorer")
    sinks.save_scorer(model, path)
    M.write_scorer_card(test, f"{path}-card", {"features": FEATURES, "target": "target"})
    return sinks.load_scorer(path).transform(test).select("id", "prediction")


@query("a11_search_history")
def search_history(spark, sf_dir):
    train, validation, _ = parts(spark, sf_dir)
    path = trials_path(spark)
    M.search(train, validation, FEATURES, "target", path, trials=1)
    table, _ = M.search(train, validation, FEATURES, "target", path, trials=1)
    return table.select("trial", "score")


@query("g11_fold_errors")
def fold_errors(spark, sf_dir):
    """Hold-out errors of every fold and their means, of the fold ensemble."""
    train, _, _ = parts(spark, sf_dir)
    models = M.fit_folds(train, FEATURES, "target")
    errors = stage(M.fold_errors(models, FEATURES, "target", train), "errors").withColumn("fold", F.col("fold").cast("string"))
    mean = errors.agg(F.lit("mean").alias("fold"), *[F.avg(c).alias(c) for c in ("rmse", "mse", "mae")])
    return errors.unionByName(mean)


# What SQL can say of fitted models: which rows they score, that every one has a number, and facts that
# hold for any right fit. One row per operator, (operator, rows, holds).


def _facts(spark, *found):
    """(operator, rows, holds) of frames (rows, holds), as one frame."""
    made = [df.select(F.lit(name).alias("operator"), F.col("rows").cast("bigint"), "holds") for name, df in found]
    return reduce(DataFrame.unionByName, made)


def _given(scored, column="prediction"):
    """How many rows, and whether all have a finite number."""
    number = F.col(column).isNotNull() & ~F.isnan(column)
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(number).alias("holds"))


def _closer(scored, target="target", column="prediction"):
    """How many rows have a target, and whether the predictions' squared error is below that of its mean."""
    error = F.avg((F.col(column) - F.col(target)) ** 2)
    return scored.agg(F.count(target).alias("rows"), (error < F.var_pop(target)).alias("holds"))


def _facts_sql(**rows: str) -> str:
    each = [f"select '{name}' as operator, cast(({sql}) as bigint) as rows, true as holds" for name, sql in rows.items()]
    return over("matrix", body=" union all ".join(each))


def _count(part: str, column: str = "*") -> str:
    return f"select count({column}) from matrix where data_type = '{part}'"


@query(
    "l1_facts",
    _facts_sql(given=_count("test"), closer=_count("train", "target"), stopped=_count("validation", "target")),
)
def early_stop_facts(spark, sf_dir):
    """Early stopping: no other prefix of the same trees has a lower error on validation."""
    train, validation, test = parts(spark, sf_dir)
    model = M.fit_boosted(train, FEATURES, "target", validation, maxIter=40, patience=40)
    full = M.fit_boosted(train, FEATURES, "target", maxIter=40)
    held = M.assemble(validation.filter(F.col("target").isNotNull()), FEATURES)
    errors = M.round_errors(full.stages[-1], held, "target")
    kept = model.transform(validation).agg(
        F.count("target").alias("rows"),
        (F.abs(F.avg((F.col("prediction") - F.col("target")) ** 2) - min(errors)) < 1e-9).alias("holds"),
    )
    return _facts(spark, ("given", _given(model.transform(test))), ("closer", _closer(model.transform(train))), ("stopped", kept))


@query(
    "l2_l7_l8_a10_t5_facts",
    _facts_sql(l2=_count("train", "target"), l7="select count(*) from matrix", l8="select 5", a10=_count("test"), t5=_count("test")),
)
def boosted_facts(spark, sf_dir):
    """One fit: closer than the mean, the same in batches, importances that sum to one, the same after a reload."""
    train, _, test = parts(spark, sf_dir)
    model = M.fit_boosted(train, FEATURES, "target")

    def same(one, other):
        both = one.select("id", "prediction").join(other.select("id", F.col("prediction").alias("again")), "id", "full")
        near = F.coalesce(F.abs(F.col("prediction") - F.col("again")) < 1e-9, F.lit(False))
        return both.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(near).alias("holds"))

    matrix = X.matrix(spark, sf_dir).drop("prediction")
    weights = spark.createDataFrame(M.importance(model, FEATURES), "feature string, importance double")
    sums = weights.agg(F.count_distinct("feature").alias("rows"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("holds"))
    chosen = [FEATURES.index(f) for f, _ in M.importance(model, FEATURES)[:3]]
    values = F.array(*[F.col(FEATURES[i]).cast("double") for i in sorted(chosen)])
    top = test.select("id", values.alias("wanted")).join(_top(test, model.stages[-1]), "id")
    top = top.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("wanted") == F.col("top_features")).alias("holds"))
    return _facts(
        spark,
        ("l2", _closer(model.transform(train))),
        ("l7", same(model.transform(matrix), _scored_in_batches(model, matrix))),
        ("l8", sums),
        ("a10", same(model.transform(test), _reloaded(spark, model, test))),
        ("t5", top),
    )


@query(
    "l3_l4_l5_facts",
    _facts_sql(
        l3="select count(*) from matrix where data_type = 'train' and target is not null and target_late is not null",
        l3_late="select count(*) from matrix where data_type = 'train' and target is not null and target_late is not null",
        l4=_count("train", "target"),
        l5=_count("train", "target"),
        folds="select 5",
    ),
)
def ensemble_facts(spark, sf_dir):
    """Two targets, three learners and folds are closer than the mean on what they were fitted to."""
    train, _, _ = parts(spark, sf_dir)
    both = train.dropna("any", subset=["target", "target_late"])
    two = M.fit_targets(train, FEATURES, ["target", "target_late"]).transform(both)
    three = M.predict_three(M.fit_three(train, FEATURES, "target"), train)
    models = M.fit_folds(train, FEATURES, "target")
    mean = M.mean_fold_error(models, FEATURES, "target", train)
    return _facts(
        spark,
        ("l3", _closer(two, "target", "prediction_target")),
        ("l3_late", _closer(two, "target_late", "prediction_target_late")),
        ("l4", _closer(three)),
        ("l5", _closer(M.predict_folds(models, FEATURES, train))),
        ("folds", mean.select(F.col("folds").alias("rows"), (F.col("mae") > 0).alias("holds"))),
    )


@query("l6_a11_facts", _facts_sql(trials="select 13", rungs="select 3", history="select 10", submission=_count("test")))
def search_facts(spark, sf_dir):
    """Nine trials by rungs, then one more at the same history, and the submission of the best."""
    train, validation, test = parts(spark, sf_dir)
    path = trials_path(spark)
    M.search(train, validation, FEATURES, "target", path, trials=9, rounds=9)
    scored = searched_score(train, validation, test, FEATURES, path, trials=1, rounds=5, search_rounds=9, patience=5)
    table = stage(sinks.read_trials(spark, path), "history")
    fits = table.filter("trial < 9")
    used = fits.agg(F.count(F.lit(1)).alias("rows"), (F.sum("rounds") < 9 * 9).alias("holds"))
    rungs = fits.groupBy("rung").agg(F.count(F.lit(1)).alias("n"), F.max("rounds").alias("rounds"))
    rungs = rungs.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("n") * F.col("rounds") == 9).alias("holds"))
    trials = table.agg(F.count_distinct("trial").alias("rows"), (F.max("trial") == 9).alias("holds"))
    inside = scored.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("prediction").between(0, 1)).alias("holds"))
    return _facts(spark, ("trials", used), ("rungs", rungs), ("history", trials), ("submission", inside))
