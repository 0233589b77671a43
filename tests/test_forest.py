"""Forests from sparse histograms against MLlib's and against themselves."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from ledgerline.operators import forest as H


@pytest.fixture(scope="module")
def rows(spark):
    """Few values per column, so that every threshold is known; negative values and rows with zeros only are among them."""
    df = spark.range(0, 3000, 1, 6).select(
        "id", (F.hash("id") % 9).cast("double").alias("a"), (F.hash("id", F.lit(1)) % 7).cast("double").alias("b"), (F.abs(F.hash("id", F.lit(2))) % 5).cast("double").alias("c"),
        F.concat(F.lit("k"), (F.abs(F.hash("id", F.lit(3))) % 6).cast("string")).alias("k"))
    df = df.withColumn("y", F.col("a") * 0.7 + F.when(F.col("k") == "k3", 4.0).otherwise(0.0) + F.col("b") * F.col("c") * 0.2
                       + (F.abs(F.hash("id", F.lit(4))) % 100) / 100)
    df = df.withColumn("label", (F.col("y") > 2).cast("double")).withColumn("weight", F.when(F.col("label") == 1, 0.5).otherwise(2.0))
    made = Pipeline(stages=[StringIndexer(inputCol="k", outputCol="i"), OneHotEncoder(inputCol="i", outputCol="o"),
                            VectorAssembler(inputCols=["a", "b", "c", "o"], outputCol="features", handleInvalid="keep")]).fit(df).transform(df)
    return made.cache()


def scores(model, rows, column="prediction"):
    return np.array([r[0] for r in model.transform(rows).orderBy("id").select(column).collect()])


def test_boosted_trees_are_those_of_mllib(rows):
    """Boosting draws nothing at random: trees, importances and predictions are the same."""
    kind = {"labelCol": "y", "maxIter": 4, "maxDepth": 4, "seed": 3}
    ours, theirs = H.HistogramGBTRegressor(**kind).fit(rows), GBTRegressor(**kind).fit(rows)
    assert type(ours) is type(theirs) and ours.treeWeights == theirs.treeWeights and ours.getNumTrees == 4
    assert np.abs(scores(ours, rows) - scores(theirs, rows)).max() < 1e-6
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)
    assert [t.depth for t in ours.trees] == [t.depth for t in theirs.trees]
    assert ours.getMaxDepth() == 4 and ours.uid


def test_a_forest_predicts_as_well_as_that_of_mllib(rows):
    kind = {"labelCol": "y", "numTrees": 30, "maxDepth": 6, "seed": 3}
    ours, theirs = H.HistogramForestRegressor(**kind).fit(rows), RandomForestRegressor(**kind).fit(rows)
    y = np.array([r["y"] for r in rows.orderBy("id").select("y").collect()])
    err = [((scores(m, rows) - y) ** 2).mean() for m in (ours, theirs)]
    assert err[0] < 1.15 * err[1] < 0.5 * y.var()
    assert ours.getNumTrees == 30 and ours.numFeatures == theirs.numFeatures and ours.totalNumNodes > 30 * 31
    assert ours.featureImportances.toArray().sum() == pytest.approx(1)
    counts = [t._call_java("rootNode").impurityStats().count() for t in ours.trees]
    assert len(set(counts)) > 10 and np.mean(counts) == pytest.approx(3000, rel=0.02)  # drawn with replacement, each tree anew


def test_class_weights_count_in_a_forest_of_two_classes(rows):
    kind = {"numTrees": 20, "maxDepth": 5, "seed": 3, "weightCol": "weight"}
    ours, theirs = H.HistogramForestClassifier(**kind).fit(rows), RandomForestClassifier(**kind).fit(rows)
    share = lambda m: scores(m, rows.withColumn("w", F.lit(1)), vector_to_array("probability")[1])
    assert np.abs(share(ours) - share(theirs)).mean() < 0.1 and share(ours).mean() == pytest.approx(share(theirs).mean(), abs=0.03)
    plain = H.HistogramForestClassifier(**(kind | {"weightCol": "one"})).fit(rows.withColumn("one", F.lit(1.0)))
    assert share(plain).mean() > share(ours).mean() + 0.05
    assert ours.numClasses == 2 and set(scores(ours, rows)) == {0.0, 1.0}


def test_sums_on_the_driver_and_in_tasks_give_the_same_trees(rows, monkeypatch):
    kind = {"labelCol": "y", "numTrees": 5, "maxDepth": 4, "seed": 3}
    here = scores(H.HistogramForestRegressor(**kind).fit(rows), rows)
    monkeypatch.setattr(H, "DRIVER_BYTES", 0)
    assert np.allclose(scores(H.HistogramForestRegressor(**kind).fit(rows), rows), here, atol=1e-9)
    monkeypatch.setattr(H, "DRIVER_BYTES", 20_000)  # begins on the driver
    monkeypatch.setattr(H, "PASS_BYTES", 1)  # a tree at a time
    assert np.allclose(scores(H.HistogramForestRegressor(**kind).fit(rows), rows), here, atol=1e-9)


def test_blocks_hold_every_row_once(rows, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 100)
    bins = H.feature_bins(rows, "features", 32, 3000, 1)
    blocks = H.binned(rows, "features", "y", None, bins, 3000).collect()
    assert sum(r["n"] for r in blocks) == 3000 and max(r["n"] for r in blocks) == 100 and len({r["block"] for r in blocks}) == len(blocks)
    x = np.array([r[0] for r in rows.select(vector_to_array("features")).collect()])
    dense = np.concatenate([bins.dense(np.frombuffer(r["entries"], np.uint16).reshape(-1, r["n"]))[:-1] for r in blocks], axis=1)
    want = np.array([np.searchsorted(c, x[:, s]) for s, c in enumerate(bins.cuts)])
    assert sorted(map(tuple, dense.T)) == sorted(map(tuple, want.T))
    # a row is a bin per column that is not zero, not one per slot
    assert max(len(r["entries"]) // 2 // r["n"] for r in blocks) <= 4 < len(bins.cuts)


def test_thresholds_are_quantiles_or_all_middles():
    assert H.thresholds(np.array([3.0, 1.0, 1.0, np.nan]), 31).tolist() == [2.0]
    assert not len(H.thresholds(np.array([5.0, 5.0]), 31))
    many = H.thresholds(np.arange(10_000.0), 31)
    assert len(many) == 31 and np.abs(np.diff(many) - 312.5).max() < 1


def test_other_settings_and_nothing_to_split(spark, rows):
    assert not H.supported(H.HistogramForestRegressor(minInstancesPerNode=5)) and not H.supported(H.HistogramForestRegressor(bootstrap=False))
    assert H.supported(H.HistogramForestRegressor()) and H.supported(H.HistogramGBTRegressor()) and H.supported(H.HistogramForestClassifier())
    assert H.HistogramForestRegressor(labelCol="y", numTrees=3, minInstancesPerNode=500).fit(rows).getNumTrees == 3
    flat = rows.limit(50).withColumn("y", F.lit(2.5))
    model = H.HistogramForestRegressor(labelCol="y", numTrees=3, maxDepth=3).fit(flat)
    assert model.totalNumNodes == 3 and set(scores(model, flat)) == {2.5}
    for y in (None, float("nan")):
        with pytest.raises(ValueError, match="1 rows whose label"):
            H.HistogramForestRegressor(labelCol="y", numTrees=3).fit(rows.withColumn("y", F.when(F.col("id") != 7, F.col("y")).otherwise(y)))
    gap = VectorAssembler(inputCols=["a", "b"], outputCol="v", handleInvalid="keep").transform(
        rows.withColumn("b", F.when(F.col("id") != 7, F.col("b"))))
    for est in (H.HistogramForestRegressor, RandomForestRegressor):  # MLlib takes no NaN either
        with pytest.raises(Exception):  # noqa: B017
            est(featuresCol="v", labelCol="y", numTrees=3).fit(gap)
