"""Fitting, combining and searching regressors, all through MLlib on DataFrames."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions.scalar import mean_of
from tidepanel.operators.boosting import (
    PATIENCE,
    assemble,
    best_round,
    feature_weights,
    first_rounds,
    importance,
    round_errors,
    tree_cells,
    tree_vector,
    with_gaps,
)
from tidepanel.operators.histograms import HELD, TRAIN, Boosting, dealt, fits_by_histograms
from tidepanel.operators.score import error_metrics, rank_correlation
from tidepanel.operators.splits import with_fold_roles
from tidepanel.sources.sinks import append_trials, read_trials

SEED = 46
#: Fits of one call that run at a time; they share the persisted vectors.
AT_ONCE = 3


def boosted(target: str, prediction: str = "prediction", **params) -> GBTRegressor:
    settings = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": SEED, **params}
    return GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol=prediction, **settings
    )


def together(fits: Sequence[Callable]) -> list:
    """The results of all fits, AT_ONCE at a time; one that fails stops those that have not begun."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = [pool.submit(fit) for fit in fits]
        try:
            return [r.result() for r in running]
        finally:
            for r in running:
                r.cancel()


def _labelled(part: DataFrame, features: Sequence[str], *targets: str) -> DataFrame:
    return part.select(*features, *targets).dropna("any", subset=list(targets))


def _median_vector(features: Sequence[str], out: str) -> list:
    """Stages of a vector with medians of the training rows for missing features."""
    names = [f"_number_{i}" for i in range(len(features))]
    numbers = [f"cast(`{c}` as double) as {n}" for c, n in zip(features, names, strict=True)]
    filled = [f"_filled_{i}" for i in range(len(features))]
    return [
        SQLTransformer(statement=f"select *, {', '.join(numbers)} from __THIS__"),
        Imputer(strategy="median", inputCols=names, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol=out, handleInvalid="keep"),
    ]


def fit_stopped(
    learner: GBTRegressor, train: DataFrame, validation: DataFrame, patience: int
) -> GBTRegressionModel:
    """Boosted trees up to the best round on ``validation``: one fit of all rounds, cut to that round."""
    if validation.isEmpty():
        raise ValueError("early stopping needs validation rows with a target")
    model = learner.fit(train)
    rounds = best_round(round_errors(model, validation, learner.getLabelCol()), patience)
    return model if rounds == model.getNumTrees else first_rounds(model, rounds)


def _grown(
    learner: GBTRegressor, train: DataFrame, held: DataFrame | None, features: Sequence[str], gaps: Sequence[str], patience: int
) -> GBTRegressionModel:
    """One fit by histograms; with ``held`` it keeps the rounds up to its best one there."""
    target = learner.getLabelCol()

    def part(df: DataFrame, role: int) -> DataFrame:
        made, names = tree_cells(df, features, gaps)
        return made.select(*names, F.col(target).cast("double").alias(target), F.lit(role).alias("_role"))

    rows = part(train, TRAIN)
    if held is not None:
        rows = rows.unionByName(part(held, HELD))
    names = [c for c in rows.columns if c not in (target, "_role")]
    return Boosting(rows, names, [learner], [F.col("_role")]).fit([None if held is None else patience])[0]


def fit_trees(rows: DataFrame, features: Sequence[str], target: str, gaps: Sequence[str] = (), **params) -> GBTRegressionModel:
    """Boosted trees alone, for the vector of ``assemble``, on rows that have a target."""
    learner = boosted(target, **params)
    if fits_by_histograms(learner):
        return _grown(learner, rows, None, features, gaps, PATIENCE)
    return learner.fit(assemble(dealt(rows, len(features)), features, gaps).select("features", target))


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    validation: DataFrame | None = None,
    prediction: str = "prediction",
    patience: int = PATIENCE,
    **params,
) -> PipelineModel:
    """Boosted trees; with ``validation`` only the rounds up to its best one, see ``fit_stopped``.

    Splits learn where rows with a missing feature go; no row is dropped.
    """
    learner = boosted(target, prediction, **params)
    rows = _labelled(train, features, target)
    held = None if validation is None else _labelled(validation, features, target)
    gaps = with_gaps(rows, features)
    before = Pipeline(stages=tree_vector(features, gaps)).fit(rows)
    if fits_by_histograms(learner):
        return PipelineModel([*before.stages, _grown(learner, rows, held, features, gaps, patience)])
    rows = dealt(rows, len(features))
    if held is None:
        return PipelineModel([*before.stages, learner.fit(before.transform(rows).select("features", target))])
    held = dealt(held, len(features))
    rows, held = (before.transform(part).select("features", target).persist() for part in (rows, held))
    try:
        return PipelineModel([*before.stages, fit_stopped(learner, rows, held, patience)])
    finally:
        rows.unpersist()
        held.unpersist()


def fit_targets(
    train: DataFrame, features: Sequence[str], targets: Sequence[str], **params
) -> PipelineModel:
    """One boosted model per target over one shared vector; columns ``prediction_<target>``."""
    rows = _labelled(train, features, *targets)
    gaps = with_gaps(rows, features)
    before = Pipeline(stages=tree_vector(features, gaps)).fit(rows)
    learners = [boosted(t, f"prediction_{t}", **params) for t in targets]
    if all(fits_by_histograms(x) for x in learners):
        made, names = tree_cells(rows, features, gaps)
        models = Boosting(made, names, learners, [F.lit(TRAIN)] * len(learners)).fit([None] * len(learners))
        return PipelineModel([*before.stages, *models])
    ready = before.transform(dealt(rows, len(features))).select("features", *targets).persist()
    try:
        return PipelineModel([*before.stages, *together([lambda one=one: one.fit(ready) for one in learners])])
    finally:
        ready.unpersist()


def fit_three(
    train: DataFrame, features: Sequence[str], target: str, validation: DataFrame | None = None, patience: int = PATIENCE, **params
) -> PipelineModel:
    """Three different learners; with ``validation`` the boosted one keeps the rounds up to its best one there.

    The rows are decoded and made into vectors once, and all three are fitted from those at a time. Trees
    learn where missing values go; the line takes medians for them.
    """
    rows = _labelled(train, features, target)
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=target,
        predictionCol="_forest",
        numTrees=params.pop("numTrees", 10),
        maxDepth=params.get("maxDepth", 5),
        seed=SEED,
    )
    line = LinearRegression(
        featuresCol="line_features", labelCol=target, predictionCol="_line", regParam=1e-3
    )
    trees = boosted(target, "_boosted", **params)
    gaps = with_gaps(rows, features)
    stages = [*tree_vector(features, gaps), *_median_vector(features, "line_features")]
    before = Pipeline(stages=stages).fit(rows)
    ready = before.transform(dealt(rows, 2 * len(features))).select("features", "line_features", target).persist()
    labelled = None if validation is None else _labelled(validation, features, target)
    held, grown = None, fits_by_histograms(trees)
    if labelled is not None and not grown:
        held = before.transform(dealt(labelled, len(features))).select("features", target).persist()

    def boost() -> GBTRegressionModel:
        if grown:
            return _grown(trees, rows, labelled, features, gaps, patience)
        return trees.fit(ready) if held is None else fit_stopped(trees, ready, held, patience)

    try:
        fits = [
            boost,
            lambda: forest.fit(ready),
            lambda: line.fit(ready),
        ]
        return PipelineModel([*before.stages, *together(fits)])
    finally:
        for part in (ready, held):
            if part is not None:
                part.unpersist()


def predict_three(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Mean of the three learners."""
    scored = model.transform(df)
    members = [F.col(c) for c in ("_boosted", "_forest", "_line")]
    return scored.withColumn(out, mean_of(members)).select(*df.columns, out)


class FoldModels(list):
    """The models of the folds and the final one, and which features their vector holds twice."""

    def __init__(self, models: Sequence[GBTRegressionModel], gaps: Sequence[str]) -> None:
        super().__init__(models)
        self.gaps = list(gaps)


def fit_folds(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    era: str = "era",
    n_folds: int = 5,
    step: int = 3,
    final_rounds: int | None = None,
    patience: int = PATIENCE,
    **params,
) -> FoldModels:
    """One model per era hold-out fold, kept up to its best round, and a final one on all rows.

    Every fold needs an era to train on, so more than ``step * (n_folds - 1)`` of them. The folds are
    labelled in one pass and the vector is assembled once; every fit reads the same persisted frame,
    some of them at a time. Splits learn where rows with a missing feature go.
    """
    rows = train.filter(F.col(target).isNotNull()).select(era, *features, target)
    gaps = with_gaps(rows, features)
    least, eras = step * max(1, n_folds - 1), rows.agg(F.count_distinct(era)).first()[0]
    if eras <= least:
        raise ValueError(f"{n_folds} folds in steps of {step} need over {least} eras; there are {eras}")
    last = {**params, "maxIter": final_rounds} if final_rounds else params
    learners = [boosted(target, f"_fold_{fold}", **params) for fold in range(n_folds)]
    learners.append(boosted(target, "_final", **last))
    if all(fits_by_histograms(x) for x in learners):
        made, names = tree_cells(with_fold_roles(rows, era, n_folds, step), features, gaps)
        roles = [F.when(F.col("roles")[i] == "train", TRAIN).when(F.col("roles")[i] == "validation", HELD).otherwise(0) for i in range(n_folds)]
        models = Boosting(made, names, learners, [*roles, F.lit(TRAIN)]).fit([*[patience] * n_folds, None])
        return FoldModels(models, gaps)
    labelled = assemble(with_fold_roles(dealt(rows, len(features)), era, n_folds, step, rows), features, gaps)
    ready = labelled.select("features", target, "roles").persist()

    def one(fold: int) -> GBTRegressionModel:
        train_rows, held = (ready.filter(F.col("roles")[fold] == r) for r in ("train", "validation"))
        return fit_stopped(learners[fold], train_rows, held, patience)

    try:
        fits = [lambda fold=fold: one(fold) for fold in range(n_folds)]
        return FoldModels(together([*fits, lambda: learners[-1].fit(ready)]), gaps)
    finally:
        ready.unpersist()


def predict_folds(
    models: FoldModels, features: Sequence[str], df: DataFrame, out: str = "prediction"
) -> DataFrame:
    """Mean of all fold models and the final one."""
    scored = assemble(df, features, models.gaps)
    for model in models:
        scored = model.transform(scored)
    members = [F.col(m.getPredictionCol()) for m in models]
    return scored.withColumn(out, mean_of(members)).select(*df.columns, out)


def fold_errors(
    models: FoldModels, features: Sequence[str], target: str, df: DataFrame, era: str = "era"
) -> DataFrame:
    """Hold-out RMSE, MSE and MAE per fold; the mean over folds is one more aggregate."""
    folds = len(models) - 1
    rows = df.filter(F.col(target).isNotNull())
    scored = assemble(with_fold_roles(rows, era, folds), features, models.gaps)
    for model in models[:-1]:
        scored = model.transform(scored)
    cases = F.array(
        *[
            F.struct(
                F.lit(i).alias("fold"),
                F.col("roles")[i].alias("role"),
                F.col(m.getPredictionCol()).alias("p"),
            )
            for i, m in enumerate(models[:-1])
        ]
    )
    held = (
        scored.select(target, F.explode(cases).alias("_case"))
        .select(target, "_case.*")
        .filter(F.col("role") == "validation")
    )
    return error_metrics(held, "p", target, ["fold"])


def mean_fold_error(
    models: FoldModels, features: Sequence[str], target: str, df: DataFrame, era: str = "era"
) -> DataFrame:
    """The hold-out errors averaged over the folds, one row."""
    errors = fold_errors(models, features, target, df, era)
    return errors.agg(F.count(F.lit(1)).alias("folds"), *[F.avg(c).alias(c) for c in ("rmse", "mse", "mae")])


def most_important(df: DataFrame, features: Sequence[str], target: str, k: int, **params) -> list[str]:
    """The ``k`` most important features of a small model on all rows, in feature order; all, if there are no more."""
    if len(features) <= k:
        return list(features)
    rows = _labelled(df, features, target)
    gaps = with_gaps(rows, features)
    model = fit_trees(rows, features, target, gaps, **{"maxDepth": 2, "subsamplingRate": 0.2, **params})
    weights = feature_weights(model.featureImportances.toArray(), features, gaps)
    best = sorted(range(len(features)), key=lambda i: (-weights[i], i))[:k]
    return [features[i] for i in sorted(best)]


def slice_top(df: DataFrame, model, k: int, vector: str = "features") -> DataFrame:
    """Keep the ``k`` most important entries of the feature vector."""
    weights = model.featureImportances.toArray()
    order = sorted(range(len(weights)), key=lambda i: (-weights[i], i))[:k]
    return VectorSlicer(inputCol=vector, outputCol="top_features", indices=sorted(order)).transform(
        df
    )


class RankCorrelationEvaluator(Evaluator):
    """Larger is better: the tail-weighted rank correlation of predictions and target."""

    def __init__(self, prediction: str, target: str):
        super().__init__()
        self.prediction = prediction
        self.target = target

    def _evaluate(self, dataset: DataFrame) -> float:
        score = rank_correlation(dataset, self.prediction, self.target).first()["corr"]
        return float("-inf") if score is None else float(score)

    def isLargerBetter(self) -> bool:
        return True


def draw_params(rng: random.Random) -> dict[str, float]:
    """One random point of the search space."""
    return {
        "maxDepth": float(rng.randint(2, 5)),
        "stepSize": 10 ** rng.uniform(-2, -0.5),
        "subsamplingRate": rng.uniform(0.4, 1.0),
        "minInstancesPerNode": float(rng.randint(5, 100)),
    }


WHOLE = ("maxDepth", "minInstancesPerNode", "maxIter")
#: Of the trials of a rung, one in KEEP goes on to the next, with KEEP times the rounds.
KEEP = 3


def typed_params(point: Mapping[str, float]) -> dict:
    return {k: int(v) if k in WHOLE else v for k, v in point.items()}


def rungs(trials: int, rounds: int, keep: int = KEEP) -> list[tuple[int, int]]:
    """(trials, rounds) of every rung: all trials with few rounds up to one with all of them."""
    steps = [(trials, rounds)]
    while steps[-1][0] >= keep and steps[-1][1] >= keep:
        steps.append((steps[-1][0] // keep, steps[-1][1] // keep))
    return list(zip([t for t, _ in steps], [r for _, r in steps][::-1], strict=True))


def search(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str,
    history: str,
    trials: int = 3,
    rounds: int = 10,
) -> tuple[DataFrame, dict]:
    """Try ``trials`` new random points by successive halving; the whole history and the best parameters.

    Every rung fits its trials together, all in the same passes over blocks of rows that are made once, and
    scores them on the validation rows, AT_ONCE at a time; the best of them go on with more rounds, so that
    few trials take all ``rounds``. The
    history is a parquet table that later runs append to. The best parameters are those of the best score
    among the trials with the most rounds; ties go to the earliest.
    """
    spark = train.sparkSession
    rows, held = (part.filter(F.col(target).isNotNull()).select(*features, target) for part in (train, validation))
    gaps = with_gaps(rows, features)
    cells, names = tree_cells(rows, features, gaps)
    held = assemble(dealt(held, len(features)), features, gaps).select("features", target).persist()
    evaluator = RankCorrelationEvaluator("prediction", target)
    done = read_trials(spark, history).agg(F.max("trial")).first()[0]
    first = 0 if done is None else done + 1
    points = {i: draw_params(random.Random(SEED + i)) for i in range(first, first + trials)}
    made, alive = [], sorted(points)
    learners = [boosted(target, **{**typed_params(points[i]), "maxIter": rounds}) for i in alive]
    growing = Boosting(cells, names, learners, [F.lit(TRAIN)] * trials)
    packed = growing.packed()

    try:
        for rung, (count, rung_rounds) in enumerate(rungs(trials, rounds)):
            alive = alive[:count]
            models = growing.fit([None] * trials, {i - first: rung_rounds for i in alive}, packed)
            scores = together([lambda m=m: evaluator.evaluate(m.transform(held)) for m in models])
            made += [(i, rung, rung_rounds, points[i], s) for i, s in zip(alive, scores, strict=True)]
            order = sorted(zip(scores, alive, strict=True), key=lambda x: (-x[0], x[1]))
            alive = [i for _, i in order]
    finally:
        packed.unpersist()
        held.unpersist()
    append_trials(spark, made, history)
    table = read_trials(spark, history)
    best = table.orderBy(F.desc_nulls_last("rounds"), F.desc("score"), "trial").first()["params"]
    return table, typed_params(best)


def refit(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str,
    params: Mapping,
    rounds: int,
    patience: int = PATIENCE,
) -> PipelineModel:
    """A boosted model with the parameters that a search found, kept up to its best round on ``validation``."""
    return fit_boosted(train, features, target, validation, patience=patience, **{**params, "maxIter": rounds})


def score_in_batches(
    df: DataFrame,
    predict: Callable[[pd.DataFrame], pd.Series],
    features: Sequence[str],
    keep: Sequence[str],
    out: str = "prediction",
) -> DataFrame:
    """A row-local Python scorer over Arrow batches of bounded size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[list(keep)].assign(**{out: predict(frame[list(features)])})

    needed = df.select(*dict.fromkeys([*keep, *features]))
    schema = T.StructType(
        [*df.select(*keep).schema.fields, T.StructField(out, T.DoubleType())]
    )
    return needed.mapInPandas(run, schema)


def write_scorer_card(df: DataFrame, path: str, card: Mapping) -> None:
    """A scorer's column lists and constants, one JSON line next to the saved model."""
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(dict(card), sort_keys=True),)], "value string").coalesce(
        1
    ).write.text(path)
