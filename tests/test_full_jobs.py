"""The composite jobs at their full width."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidepanel.catalog.fits import STOPPED, parts
from tidepanel.operators import models as M
from tidepanel.sources import fixtures as X

SF = "/root/testdata/sf0.01"


def _quintiles(df):
    return [c for c in df.columns if c.endswith("_quintile")]


def test_equity_sets_carry_the_full_feature_table(spark):
    made = entry.queries()["q2_equity_sets_full"](spark, SF)
    table = entry.queries()["q1_equity_features_full"](spark, SF)
    assert len(_quintiles(made)) == 39 and _quintiles(made) == _quintiles(table)
    rows = {(r.date, r.canonical_ticker): tuple(r[c] for c in _quintiles(table)) for r in table.collect()}
    parts = made.filter("part <> 'live'").collect()
    assert parts and all(rows[r.date, r.canonical_ticker] == tuple(r[c] for c in _quintiles(made)) for r in parts)


def test_crypto_sets_carry_the_full_feature_table(spark):
    made = entry.queries()["q3_crypto_sets_full"](spark, SF)
    table = entry.queries()["q3_crypto_features_full"](spark, SF)
    assert len(_quintiles(made)) == 30 and _quintiles(made) == _quintiles(table)
    rows = {(r.date, r.symbol): tuple(r[c] for c in _quintiles(table)) for r in table.collect()}
    found = made.collect()
    assert found and all(rows[r.date, r.symbol] == tuple(r[c] for c in _quintiles(made)) for r in found)


def _largest_correlation(df, factors):
    sums = df.agg(*[F.corr("prediction", f).alias(f) for f in factors]).first()
    return max(abs(x) for x in sums if x is not None)


def test_neutralization_leaves_no_feature_correlated(spark):
    matrix = X.matrix(spark, SF).select("id", "era", *X.MATRIX_FEATURES)
    assert len(X.MATRIX_FEATURES) == 5
    left = entry.queries()["n1_full_neutralization"](spark, SF).join(matrix, "id")
    assert _largest_correlation(left, X.MATRIX_FEATURES) < 1e-4


def test_fits_use_all_rows_and_default_rounds(spark):
    train, _, test = parts(spark, SF)
    rows = train.filter(F.col("target").isNotNull())
    model = M.boosted("target").fit(M.assemble(rows, X.MATRIX_FEATURES))
    assert rows.count() > 5000 and model.getNumTrees == 20
    want = {r.id: r.v for r in M.slice_top(M.assemble(test, X.MATRIX_FEATURES), model, 3).select("id", vector_to_array("top_features").alias("v")).collect()}
    found = {r.id: r.top_features for r in entry.queries()["t5_top_by_importance"](spark, SF).collect()}
    assert found == want and STOPPED["maxIter"] > M.PATIENCE
