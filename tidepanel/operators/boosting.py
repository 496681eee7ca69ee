"""Boosted trees: a learned direction for missing values, errors of all rounds in one pass, and prefixes.

MLlib's trees have no notion of a missing value. A feature with gaps is therefore offered to them twice,
with its gaps below and above all values; whichever a split uses decides on which side missing rows go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stand for a missing feature in a vector for trees.
BELOW_ALL, ABOVE_ALL = -1e12, 1e12
#: Rounds without a lower validation error after which boosting stops.
PATIENCE = 100


def with_gaps(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that are null or NaN in some row."""
    if not features:
        return []
    missing = [F.bool_or(F.isnull(c) | F.isnan(F.col(c).cast("double"))).alias(f"_{i}") for i, c in enumerate(features)]
    found = df.agg(*missing).first()
    return [c for i, c in enumerate(features) if found[f"_{i}"]]


def tree_vector(features: Sequence[str], gaps: Sequence[str] = (), out: str = "features") -> list[Transformer]:
    """Stages that make the vector for trees: every feature with its gaps below all, those of ``gaps`` also above."""
    gaps = [c for c in features if c in set(gaps)]

    def cell(c: str, filler: float, name: str) -> str:
        return f"coalesce(nanvl(cast(`{c}` as double), cast(null as double)), {filler!r}D) as {name}"

    places = {c: i for i, c in enumerate(features)}
    cells = [cell(c, BELOW_ALL, f"_low_{i}") for c, i in places.items()]
    cells += [cell(c, ABOVE_ALL, f"_high_{places[c]}") for c in gaps]
    names = [f"_low_{i}" for i in range(len(features))] + [f"_high_{places[c]}" for c in gaps]
    return [
        SQLTransformer(statement=f"select *, {', '.join(cells)} from __THIS__"),
        VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep"),
    ]


def assemble(df: DataFrame, features: Sequence[str], gaps: Sequence[str] = (), out: str = "features") -> DataFrame:
    """``df`` with the vector for trees; every row stays."""
    made = df
    for step in tree_vector(features, gaps, out):
        made = step.transform(made)
    return made.select(*df.columns, out)


def tree_cells(df: DataFrame, features: Sequence[str], gaps: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``df`` with the entries of the vector for trees as columns, and their names in its order."""
    cells, vector = tree_vector(features, gaps)
    return cells.transform(df), vector.getInputCols()


def feature_weights(weights: Sequence[float], features: Sequence[str], gaps: Sequence[str] = ()) -> list[float]:
    """Importances of vector entries added up by feature."""
    total = [float(w) for w in weights[: len(features)]]
    for c, w in zip([c for c in features if c in set(gaps)], weights[len(features) :], strict=True):
        total[list(features).index(c)] += float(w)
    return total


def importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Features of a fitted pipeline with one tree learner by falling importance; ties in feature order."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler) and s.getOutputCol() == "features").getInputCols()
    gaps = [features[int(n.removeprefix("_high_"))] for n in names if n.startswith("_high_")]
    learner = next(s for s in model.stages if hasattr(s, "featureImportances"))
    weights = feature_weights(learner.featureImportances.toArray(), features, gaps)
    order = sorted(range(len(features)), key=lambda i: (-weights[i], i))
    return [(features[i], weights[i]) for i in order]


class Trees:
    """The trees of a boosted model as arrays, so that a batch of rows goes through a tree in a few steps."""

    LINE = re.compile(r"^ *(?:If \(feature (\d+) <= (\S+)\)|Predict: (\S+)|(Else|Tree \d+)\b.*|(\S.*))$")

    def __init__(self, model: GBTRegressionModel) -> None:
        self.weights = [float(w) for w in model.treeWeights]
        self.trees = []
        nodes: list[list[float]] = []
        open_nodes: list[int] = []
        for line in model.toDebugString.splitlines()[1:]:
            found = self.LINE.match(line)
            if not found or found[5]:
                raise ValueError(f"a split on something else than a number: {line.strip()}")
            if found[4]:
                if found[4].startswith("Tree"):
                    nodes, open_nodes = [], []
                    self.trees.append(nodes)
                continue
            # In this order a node is the first child of its parent, or the second once that has one.
            place = len(nodes)
            while open_nodes and nodes[open_nodes[-1]][3] >= 0:
                open_nodes.pop()
            if open_nodes:
                parent = nodes[open_nodes[-1]]
                parent[2 if parent[2] < 0 else 3] = place
            if found[1] is None:
                nodes.append([-1, 0.0, place, place, float(found[3])])
            else:
                nodes.append([int(found[1]), float(found[2]), -1, -1, 0.0])
                open_nodes.append(place)
        self.trees = [tuple(np.array(c) for c in zip(*t, strict=True)) for t in self.trees]

    def rounds(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The prediction of the rows after each round."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(rows), int)
            while True:
                split = feature[at] >= 0
                if not split.any():
                    break
                low = rows[every, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(split, np.where(low, left[at], right[at]), at).astype(int)
            total = total + weight * value[at]
            yield total


def round_errors(model: GBTRegressionModel, df: DataFrame, target: str, vector: str = "features") -> list[float]:
    """Mean squared error after every round, all in one pass over ``df``."""
    trees = Trees(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, errors = 0, np.zeros(len(trees.trees))
        for batch in batches:
            wanted = batch.column("_target").to_numpy(zero_copy_only=False)
            rows = batch.column("_vector").flatten().to_numpy(zero_copy_only=False).reshape(len(wanted), -1)
            count += len(wanted)
            for i, made in enumerate(trees.rounds(rows)):
                errors[i] += ((made - wanted) ** 2).sum()
        yield pa.RecordBatch.from_pydict({"n": [count], "errors": [errors.tolist()]})

    rows = df.select(F.col(target).cast("double").alias("_target"), vector_to_array(vector).alias("_vector"))
    parts = rows.mapInArrow(add, "n long, errors array<double>")
    total = parts.select("n", F.posexplode("errors").alias("round", "error")).groupBy("round")
    made = total.agg((F.sum("error") / F.sum("n")).alias("error")).orderBy("round").collect()
    return [r["error"] for r in made]


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model cut to its first rounds; trees, weights and settings are its own."""
    java = model._java_obj
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i] = java.trees()[i]
        weights[i] = float(java.treeWeights()[i])
    cut = ml.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    java.copyValues(cut, ml.param.ParamMap.empty())
    made = GBTRegressionModel(cut)
    made._resetUid(java.uid())
    made._transfer_params_from_java()
    return made


def best_round(errors: Sequence[float], patience: int) -> int:
    """How many rounds to keep: up to the least error seen before ``patience`` rounds without a lower one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1
