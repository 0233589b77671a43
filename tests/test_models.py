"""Models: what must hold of any fit (small ones here), and of what the registered queries make of them."""

import math

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import models as M
from ledgerline.sources.io import scratch_path


@pytest.fixture(scope="module")
def split(spark):
    return M.split_profit(spark, SF_SMALL)


def small_forest():
    return M.rf_regressor(num_trees=8, depth=5)


@pytest.fixture(scope="module")
def forest(split):
    return M.fit_profit(split[0], small_forest(), split[2])


def r2(model, test):
    return M._eval_usd(model.transform(test)).first()["r2"]


def test_every_test_row_is_predicted_once(split, forest):
    train, test, shift = split
    pred = forest.transform(test).select("row_id", "prediction", "prediction_usd").collect()
    assert len(pred) == len({r["row_id"] for r in pred}) == test.count() > 0
    assert train.join(test, "row_id").count() == 0
    assert all(math.isclose(r["prediction_usd"], math.exp(r["prediction"]) - shift, rel_tol=1e-9, abs_tol=1e-6) for r in pred)


def test_reloaded_model_predicts_the_same(spark, split, forest):
    path = scratch_path(spark, "model")
    M.save_model(forest, path)
    again = M.load_model(spark, scratch_path(spark, "nothing"), fallback=path)
    a, b = (sorted(tuple(r) for r in m.transform(split[1]).select("row_id", "prediction_usd").collect()) for m in (forest, again))
    assert a == b
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, scratch_path(spark, "nothing"))


def test_linear_regression_finds_an_exact_line(spark):
    """log(profit + shift) is linear in two columns; the rest is constant."""
    rows = spark.range(600).select(F.col("id").alias("row_id"), *[F.lit(0.0).alias(c) for c in M.PROFIT_NUMERIC if c not in ("quantity", "discount_d")],
                                   (F.col("id") % 17).cast("double").alias("quantity"), ((F.col("id") % 5) / 10).alias("discount_d"),
                                   *[F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias(c) for c in M.PROFIT_CATEGORICAL])
    rows = rows.withColumn("profit_d", F.exp(0.1 * F.col("quantity") - F.col("discount_d") + 1) - 3.0)
    model = M.fit_profit(rows.where("row_id < 400"), M.linear_regressor(), 3.0)
    assert r2(model, rows.where("row_id >= 400")) == pytest.approx(1, abs=1e-3)
    line = next(x for x in model.stages if hasattr(x, "coefficients"))
    assert line.coefficients[1] == pytest.approx(0.1, abs=1e-3)
    # the discount is also an interaction with the sub-category: its parts add up
    names = [n for n, _ in enumerate(line.coefficients)]
    assert len(names) == len(line.coefficients)


def test_boosted_trees_and_forest_beat_the_mean(split, forest):
    train, test, shift = split
    gbt = M.fit_profit(train, M.gbt_regressor().setMaxIter(4), shift)
    table = M.compare_regressors({"random_forest": forest, "gbt": gbt}, test).collect()
    assert {r["model"] for r in table} == {"random_forest", "gbt"} and sorted(r["place"] for r in table) == [1, 2]
    assert all(r["r2"] > 0.2 and r["n"] == test.count() and r["mae"] <= r["rmse"] for r in table)
    assert min(table, key=lambda r: r["rmse"])["place"] == 1


def test_importances_sum_to_one_and_match_the_slots(split, forest):
    found = M.feature_importances(forest, split[0])
    size = forest.transform(split[0].limit(1)).first()["features"].size
    assert len(found) == size and len({n for n, _ in found}) == size
    assert sum(x for _, x in found) == pytest.approx(1) and all(x >= 0 for _, x in found)
    assert [n for n, _ in found[:len(M.PROFIT_NUMERIC)]] == M.PROFIT_NUMERIC
    assert sum(x for n, x in found if n.startswith(("sales_capped", "discount", "avg_item", "shipping_cost"))) > 0.3


def test_importance_groups_are_a_partition(spark):
    names = [*M.REPURCHASE_NUMERIC, *[f"{c}_ohe_x" for c in M.REPURCHASE_CATEGORICAL], "something else"]
    df = spark.createDataFrame([(n, 1.0) for n in names], "feature string, importance double")
    got = {r["g"]: r["s"] for r in df.groupBy(M.importance_group().alias("g")).agg(F.sum("importance").alias("s")).collect()}
    assert sum(got.values()) == len(names) and got["Other"] >= 1 and {g for g, _ in M.IMPORTANCE_GROUPS} >= set(got) - {"Other"}


def test_shuffling_a_used_column_hurts_and_an_unused_one_does_not(split):
    train, test, shift = split
    without = [c for c in M.PROFIT_NUMERIC if c not in ("cust_hist_margin", "cust_hist_profit")]
    model = M.fit_profit(train, small_forest(), shift, numeric=without)
    got = {r["feature"]: r for r in M.permutation_importance(model, test, ["sales_capped", "cust_hist_margin"]).collect()}
    assert got["cust_hist_margin"]["r2_drop"] == pytest.approx(0, abs=1e-9)
    assert got["sales_capped"]["r2_drop"] > 0.05
    assert got["sales_capped"]["r2_after"] + got["sales_capped"]["r2_drop"] == pytest.approx(r2(model, test), abs=1e-3)


def test_more_features_do_not_hurt_much(split):
    train, test, shift = split
    got = [tuple(r) for r in M.ablation(train, test, shift, small_forest, M.FEATURE_SETS[:1] + M.FEATURE_SETS[3:]).collect()]
    assert [n for n, _ in got] == ["base", "full"] and got[1][1] > got[0][1] - 0.1 and got[0][1] > 0


def test_best_of_the_grid_is_the_least_error(spark, split):
    train, test, shift = split
    cvm, grid, rf = M.cross_validate(train.limit(1500), shift, trees=(3,), depths=(1, 5))
    best = min(range(len(grid)), key=lambda i: cvm.avgMetrics[i])
    assert len(cvm.avgMetrics) == 2 and grid[best][rf.maxDepth] == 5
    forest = next(x for x in cvm.bestModel.stages if hasattr(x, "featureImportances"))
    assert forest.getOrDefault("maxDepth") == 5 and forest.getNumTrees == 3
    assert cvm.bestModel.transform(test).where("prediction_usd IS NULL").count() == 0


@pytest.fixture(scope="module")
def made_orders(spark):
    """Orders whose label is decided by the time since the one before; 1 in 5 returns."""
    num = [c for c in M.REPURCHASE_NUMERIC if c != "days_since_previous_order"]
    df = spark.range(800).select(
        F.col("id").alias("order_key"), F.when(F.col("id") % 4 < 2, "train").when(F.col("id") % 4 == 2, "valid").otherwise("test").alias("split"),
        (F.hash("id") % 10 + F.lit(0.0)).alias("x"), F.when(F.col("id") % 40 == 7, None).otherwise(F.col("id") % 100).cast("double").alias("days_since_previous_order"),
        *[((F.hash("id", F.lit(k)) % 50) / 7.0).alias(c) for k, c in enumerate(num)],
        *[F.when(F.hash("id", F.lit(c)) % 3 == 0, "a").otherwise("b").alias(c) for c in M.REPURCHASE_CATEGORICAL])
    return M.freeze(df.withColumn("label", F.when(F.coalesce("days_since_previous_order", F.lit(50)) < 20, 1.0).otherwise(0.0)))


@pytest.mark.parametrize("name", ["logistic", "forest"])
def test_classifiers_learn_what_decides(made_orders, name):
    df = M.apply_class_weights(made_orders, M.class_weights(made_orders.where("split = 'train'")))
    estimator = M.logistic() if name == "logistic" else M.rf_classifier().setNumTrees(10)
    scored = M.with_return_score(M.fit_repurchase(df, estimator).transform(df.where("split = 'test'")))
    report = M.classifier_report(scored).first()
    assert scored.where("return_score < 0 OR return_score > 1").count() == 0
    p = scored.select(M.vector_to_array("probability").alias("p"), "return_score").collect()
    assert all(len(r["p"]) == 2 and sum(r["p"]) == pytest.approx(1) and r["p"][1] == r["return_score"] for r in p)
    areas = [v for k, v in report.asDict().items() if "auc" in k.lower() or "roc" in k.lower()]
    assert areas and max(areas) > 0.85


def test_class_weight_moves_the_scores(made_orders):
    """With weights for the rare class its scores are higher on average than without."""
    df = M.apply_class_weights(made_orders, M.class_weights(made_orders.where("split = 'train'")))
    mean = lambda est: M.with_return_score(M.fit_repurchase(df, est).transform(df)).agg(F.avg("return_score")).first()[0]
    plain = LogisticRegression(featuresCol="features", labelCol="label", maxIter=50, regParam=0.01)
    assert mean(M.logistic()) > mean(plain) + 0.02


def test_fits_follow_the_data_and_can_be_forgotten(spark):
    base, made = scratch_path(spark, "data"), []
    spark.range(3).write.parquet(f"{base}/t.parquet")
    fit = lambda: made.append(1) or len(made)
    assert M.fitted(spark, base, "x", fit) == M.fitted(spark, base, "x", fit) == 1
    spark.range(4).write.mode("append").parquet(f"{base}/t.parquet")
    assert M.fitted(spark, base, "x", fit) == 2
    kept = dict(M._FITTED)
    M.forget()
    assert M.fitted(spark, base, "x", fit) == 3
    M._FITTED.update(kept)


def test_frozen_rows_are_dealt_over_all_cores(spark):
    """Rows of a single task, or of one file with one row group, are read by at least a task per core."""
    cores = spark.sparkContext.defaultParallelism
    frozen = M.freeze(spark.range(0, 64 * cores, 1, 1))
    sizes = frozen.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 64 * cores and sum(n > 0 for n in sizes) >= cores / 2 and max(sizes) <= 64 * 4


def test_a_large_frame_is_written_where_it_is(spark, monkeypatch):
    """Rows that come out of many tasks, or fill many files, are read evenly without being shuffled first."""
    from ledgerline.plans import lineage
    monkeypatch.setattr(lineage, "dealt", lambda df: pytest.fail("dealt"))
    monkeypatch.setattr(lineage, "FILE_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    one_task = M.freeze(spark.range(0, 400 * cores, 1, 1))
    assert len(one_task.inputFiles()) == 4 * cores and one_task.count() == one_task.distinct().count() == 400 * cores
    assert M.freeze(spark.range(0, 50 * cores, 1, 2 * cores)).count() == 50 * cores


def test_training_split_is_dealt_over_all_cores(split):
    sizes = split[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < sum(sizes) / 2


def test_a_report_scores_each_row_once(spark):
    """The counts and the ranking read the same scores."""
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return x / 100

    scored = spark.range(0, 100, 1, 4).select(
        F.udf(score, "double")("id").alias("return_score"), (F.col("id") % 2).cast("double").alias("label")) \
        .withColumn("prediction", F.lit(1.0))
    report = M.classifier_report(scored).first()
    assert (report["tp"], report["fp"]) == (50, 50) and seen.value == 100


def test_a_pass_of_the_forest_fills_few_statistics(split):
    """A pass of the registered forest keeps within a core's cache, and passes of a node each grow whole trees."""
    assert M.rf_regressor().getMaxMemoryInMB() <= 8
    train, test, shift = split
    one_pass = M.fit_profit(train, M.rf_regressor(4, 3).setMaxMemoryInMB(256), shift)
    parts = M.fit_profit(train, M.rf_regressor(4, 3).setMaxMemoryInMB(0), shift)
    trees = lambda m: next(x for x in m.stages if hasattr(x, "featureImportances"))
    assert trees(parts).getNumTrees == trees(one_pass).getNumTrees == 4
    assert [t.depth for t in trees(parts).trees] == [t.depth for t in trees(one_pass).trees] == [3] * 4
    assert r2(parts, test) == pytest.approx(r2(one_pass, test), abs=0.15)
