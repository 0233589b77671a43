"""Models (survey 2.13): MLlib pipelines for the profit regression and the
90-day repurchase classifier, tuning, importances, save / load.

The settings are the full ones (100 trees of depth 8, 20 boosting rounds of
depth 5, a grid of 50 / 100 trees by depth 5 / 8).  What a trained model
decides has no SQL oracle; the encoders, the imputer, the split and the
reloading of a model are checked against SQL.

The log shift is fitted on the training split only and travels inside the
saved pipeline, whose last stage turns predictions back into money.

Training frames are written once to the session's ``spark.checkpoint.dir``
and read back (``plans.lineage.cut``) before fitting: iterative learners scan their
input many times and must not recompute the feature lineage on each pass.  They
are written in even parts, so that every pass runs on all cores.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (Imputer, Interaction, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.functions.realtime import ServingParams, line_features
from ledgerline.operators.features import (_HIST_CTE, _ORDER_CTE, TEST_SERVING, TEST_SPLIT, apply_class_weights,
                                           capped_orders, class_weights, customer_history, fit_log_shift,
                                           labeled_orders, split_cte)
from ledgerline.operators.metrics import (best_threshold, confusion_metrics, ranking_metrics, regression_metrics,
                                          threshold_sweep)
from ledgerline.operators.forest import HistogramForestClassifier, HistogramForestRegressor, HistogramGBTRegressor
from ledgerline.operators.relational import hash_split, hash_unit, hash_unit_sql
from ledgerline.plans import sqltext as S
from ledgerline.plans.registry import register
from ledgerline.plans.lineage import cut, cut_evenly, drop_cut
from ledgerline.plans.ordered import ordered_scan
from ledgerline.sources.fact import order_lines
from ledgerline.sources.io import path_exists, scratch_path

# ------------------------------------------------------- feature lists

# The inputs of the two models.
PROFIT_NUMERIC = ["sales_capped", "quantity", "discount_d", "shipping_cost_capped", "year", "weeknum",
                  "discount_amount", "shipping_ratio", "avg_item_value", "delivery_days", "is_discounted",
                  "high_discount", "cust_hist_sales", "cust_hist_profit", "cust_hist_margin"]
PROFIT_CATEGORICAL = ["category", "sub_category", "segment", "market", "country", "ship_mode", "order_priority",
                      "market_category"]

REPURCHASE_NUMERIC = ["order_sales_d", "order_quantity", "order_avg_discount", "order_max_discount",
                      "order_shipping_cost_d", "order_line_count", "num_products", "num_categories",
                      "num_sub_categories", "ship_days", "order_month", "order_quarter", "weekday_of_order",
                      "is_first_order", "days_since_previous_order", "previous_order_count",
                      "previous_total_sales", "previous_total_quantity", "previous_avg_order_value",
                      "previous_avg_discount", "previous_avg_shipping_cost", "customer_lifetime_days",
                      "order_frequency_rate", "sales_vs_previous_avg", "discount_vs_previous_avg"]
REPURCHASE_CATEGORICAL = ["market", "country", "segment", "ship_mode", "order_priority", "main_category",
                          "main_sub_category"]


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage: written to the shared checkpoint folder in even parts, read back."""
    return cut_evenly(df, "train")


# ------------------------------------------------------ training frames


def profit_lines(spark, sf_dir) -> DataFrame:
    """The fact lines of the profit models, written once."""
    return freeze(order_lines(spark, sf_dir, ["customer_id", "order_id", "order_date", "ship_date", "product_id",
                                               "sales", "profit", "quantity", "discount", "shipping_cost", "category",
                                               "sub_category", "segment", "market", "country", "ship_mode",
                                               "order_priority"]))


def profit_frame(lines: DataFrame, params: ServingParams = TEST_SERVING) -> DataFrame:
    """ML2 line-level frame: the shared line features and the order-level
    customer history, joined back; both read ``lines``."""
    hist = customer_history(capped_orders(lines, params.sales_lo, params.sales_hi)) \
        .select("customer_id", "order_id", "cust_hist_sales", "cust_hist_profit", "cust_hist_margin")
    return line_features(lines, params).withColumn("profit_d", N.dbl("profit")).join(hist, ["customer_id", "order_id"])


def repurchase_frame(spark, sf_dir) -> DataFrame:
    lab = labeled_orders(spark, sf_dir, TEST_SPLIT, with_history=True)
    return (lab.withColumn("order_sales_d", N.dbl("order_sales"))
            .withColumn("order_shipping_cost_d", N.dbl("order_shipping_cost"))
            .fillna("Unknown", subset=REPURCHASE_CATEGORICAL))


# ------------------------------------------------------------ pipelines


def encoders(categorical: list[str], ohe_invalid: str = "error", drop_last: bool = True):
    """StringIndexer (unseen/null -> extra bucket) and OneHotEncoder stages."""
    idx = StringIndexer(inputCols=categorical, outputCols=[c + "_idx" for c in categorical],
                        handleInvalid="keep", stringOrderType="frequencyDesc")
    ohe = OneHotEncoder(inputCols=[c + "_idx" for c in categorical], outputCols=[c + "_ohe" for c in categorical],
                        handleInvalid=ohe_invalid, dropLast=drop_last)
    return idx, ohe


def profit_stages(estimator, numeric=PROFIT_NUMERIC, categorical=PROFIT_CATEGORICAL, interaction: bool = True):
    idx, ohe = encoders(categorical)
    stages = [idx, ohe]
    inputs = list(numeric) + [c + "_ohe" for c in categorical]
    if interaction:
        stages.append(Interaction(inputCols=["sub_category_ohe", "discount_d"], outputCol="subcat_discount_inter"))
        inputs.append("subcat_discount_inter")
    stages += [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"), estimator]
    return stages


def repurchase_stages(estimator, numeric=REPURCHASE_NUMERIC, categorical=REPURCHASE_CATEGORICAL):
    imputed = [c + "_imp" for c in numeric]
    imp = Imputer(inputCols=numeric, outputCols=imputed, strategy="median")
    num_vec = VectorAssembler(inputCols=imputed, outputCol="num_vec", handleInvalid="keep")
    scaler = StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True)
    idx, ohe = encoders(categorical, ohe_invalid="keep")
    assemble = VectorAssembler(inputCols=["num_scaled"] + [c + "_ohe" for c in categorical],
                               outputCol="features", handleInvalid="keep")
    return [imp, num_vec, scaler, idx, ohe, assemble, estimator]


#: MB of node statistics that a pass of MLlib's own forest fills, where ``forest.supported`` leaves a forest to it.  Every row
#: adds to a third of the slots of a node in each tree, at random places: a share of this size stays in a core's cache, all
#: nodes of a level (90 MB a task at depth 8) do not.
NODE_GROUP_MB = 4


def rf_regressor(num_trees=100, depth=8, seed=42) -> RandomForestRegressor:
    return HistogramForestRegressor(featuresCol="features", labelCol="log_profit", numTrees=num_trees,
                                    maxDepth=depth, seed=seed, maxMemoryInMB=NODE_GROUP_MB)


def money_stage(shift: float) -> Transformer:
    """Inverts the log target; the shift is part of the saved stage."""
    return SQLTransformer(statement=f"SELECT *, exp(prediction) - CAST({shift!r} AS DOUBLE) AS prediction_usd FROM __THIS__")


def with_log_target(df: DataFrame, shift: float) -> DataFrame:
    """log(profit + shift); null where that has no logarithm (never in the split the shift was fitted on)."""
    x = F.col("profit_d") + F.lit(shift)
    return df.withColumn("log_profit", F.when(x > 0, F.log(x)))


def fit_profit(train: DataFrame, estimator, shift: float, **stages) -> PipelineModel:
    pipeline = Pipeline(stages=[*profit_stages(estimator, **stages), money_stage(shift)])
    return pipeline.fit(with_log_target(train, shift))


SPLIT_KEY = ["order_id", "product_id", "ship_date", "sales", "quantity", "discount"]


def split_profit(spark, sf_dir):
    """(train, test, shift): split by a hash of the line's content, the shift fitted on the training split."""
    # the row id, used only to pair rows, is materialised by the lineage cut, and so is the split
    lines = profit_lines(spark, sf_dir)
    df = freeze(hash_split(profit_frame(lines).withColumn("row_id", F.monotonically_increasing_id()), SPLIT_KEY, (0.8, 0.2)))
    drop_cut(lines)
    train, test = df.where(F.col("split_id") == 0), df.where(F.col("split_id") == 1)
    return train, test, float(fit_log_shift(train).first()["shift"])


def fit_repurchase(df: DataFrame, estimator) -> PipelineModel:
    return Pipeline(stages=repurchase_stages(estimator)).fit(df.where(F.col("split") == "train"))


def weighted_repurchase(spark, sf_dir) -> DataFrame:
    """Labelled orders with the class weights of the training split (written once)."""
    df = freeze(repurchase_frame(spark, sf_dir))
    weights = cut(class_weights(df.where(F.col("split") == "train")), "weights")  # one row per class
    return apply_class_weights(df, weights)


def logistic() -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="class_weight", maxIter=50, regParam=0.01)


def rf_classifier(weighted: bool = True) -> RandomForestClassifier:
    rf = HistogramForestClassifier(featuresCol="features", labelCol="label", numTrees=100, maxDepth=8, seed=42)
    return rf.setWeightCol("class_weight") if weighted else rf


def with_return_score(pred: DataFrame) -> DataFrame:
    return pred.withColumn("return_score", vector_to_array("probability")[1])


# ---------------------------------------------------------- registered

_FITTED: dict = {}


def data_version(spark, sf_dir: str) -> tuple:
    """Path, size and time of every file of the tables under ``sf_dir``: changes when they do."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def fitted(spark, sf_dir: str, what: str, fit):
    """What ``fit()`` returns, made once per application and state of the data folder: several registered
    queries report on the same full-size model.  Library callers fit and pass models themselves; ``forget``
    drops what was made, so that a timed query does all of its work."""
    key = (spark.sparkContext.applicationId, data_version(spark, sf_dir), what)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def forget() -> None:
    _FITTED.clear()


def profit_split(spark, sf_dir):
    return fitted(spark, sf_dir, "profit split", lambda: split_profit(spark, sf_dir))


def profit_forest(spark, sf_dir) -> PipelineModel:
    train, _, shift = profit_split(spark, sf_dir)
    return fitted(spark, sf_dir, "profit forest", lambda: fit_profit(train, rf_regressor(), shift))


def repurchase_data(spark, sf_dir) -> DataFrame:
    return fitted(spark, sf_dir, "repurchase data", lambda: weighted_repurchase(spark, sf_dir))


def repurchase_model(spark, sf_dir, name: str) -> PipelineModel:
    estimator = {"logistic_regression": logistic, "random_forest": rf_classifier}[name]
    return fitted(spark, sf_dir, name, lambda: fit_repurchase(repurchase_data(spark, sf_dir), estimator()))


@register("ml_index", sql=S.with_fact("""
SELECT category, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, category) - 1 AS DOUBLE) AS category_idx
FROM fact GROUP BY category"""))
def _ml_index(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["category"])
    model = StringIndexer(inputCol="category", outputCol="category_idx", handleInvalid="keep").fit(df)
    labels = spark.createDataFrame([(v,) for v in model.labels], "category string")
    return model.transform(labels)


@register("ml_onehot", sql=S.with_fact("""
SELECT f.order_id, f.product_id, f.ship_date, f.category, CAST(i.idx AS INTEGER) AS hot_slot
FROM fact f JOIN (SELECT category, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, category) - 1 AS idx
                  FROM fact GROUP BY category) i ON f.category = i.category"""))
def _ml_onehot(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "category"])
    idx, ohe = encoders(["category"])
    out = Pipeline(stages=[idx, ohe]).fit(df).transform(df)
    # with the extra 'unseen' bucket kept and the last slot dropped, every
    # known category has its own slot: report which one is hot
    arr = vector_to_array("category_ohe")
    return out.select("order_id", "product_id", "ship_date", "category",
                      (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_slot"))


@register("ml_interaction", sql=S.with_fact("""
SELECT f.order_id, f.product_id, f.ship_date, CAST(i.idx AS INTEGER) AS sub_slot,
       CAST(f.discount AS DOUBLE) AS inter_total
FROM fact f JOIN (SELECT sub_category, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, sub_category) - 1 AS idx
                  FROM fact GROUP BY sub_category) i ON f.sub_category = i.sub_category"""))
def _ml_interaction(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sub_category", "discount"]) \
        .withColumn("discount_d", N.dbl("discount"))
    idx, ohe = encoders(["sub_category"])
    inter = Interaction(inputCols=["sub_category_ohe", "discount_d"], outputCol="inter")
    out = Pipeline(stages=[idx, ohe, inter]).fit(df).transform(df)
    arr = vector_to_array("inter")
    # one-hot x discount: the discount sits in the sub-category's slot
    return out.select("order_id", "product_id", "ship_date",
                      (F.array_position(vector_to_array("sub_category_ohe"), 1.0) - 1).cast("int").alias("sub_slot"),
                      F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x).alias("inter_total"))


@register("ml_assemble", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, CAST(sales AS DOUBLE) AS f0, CAST(quantity AS DOUBLE) AS f1,
       CAST(discount AS DOUBLE) AS f2 FROM fact"""))
def _ml_assemble(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sales", "quantity", "discount"])
    df = df.select("order_id", "product_id", "ship_date", N.dbl("sales").alias("s"),
                   F.col("quantity").cast("double").alias("q"), N.dbl("discount").alias("d"))
    out = VectorAssembler(inputCols=["s", "q", "d"], outputCol="v", handleInvalid="keep").transform(df)
    arr = vector_to_array("v")
    return out.select("order_id", "product_id", "ship_date", *[arr[i].alias(f"f{i}") for i in range(3)])


@register("fn_vector_to_array")
def _fn_vector_to_array(spark, sf_dir):
    model = repurchase_model(spark, sf_dir, "logistic_regression")
    scored = with_return_score(model.transform(repurchase_data(spark, sf_dir)))  # every labelled order
    return scored.select("order_key", "split", "label", "return_score")


@register("fn_vector_to_array_rows", sql=S.with_fact("""
SELECT order_key, split, CAST(label AS INTEGER) AS label, TRUE AS is_share FROM cens""", _ORDER_CTE, _HIST_CTE, split_cte("hist")))
def _fn_vector_to_array_rows(spark, sf_dir):
    """The labelled orders that get a score, with whether it is the second of two shares that sum to 1."""
    scored = repurchase_model(spark, sf_dir, "logistic_regression").transform(repurchase_data(spark, sf_dir))
    p = vector_to_array("probability")
    return scored.select("order_key", "split", F.col("label").cast("int").alias("label"), (
        (F.size(p) == 2) & (p[1] >= 0) & (p[1] <= 1) & (F.abs(p[0] + p[1] - 1) < 1e-9)).alias("is_share"))


_IMPUTED = ["days_since_previous_order", "previous_avg_discount"]


@register("ml_impute", sql=S.with_fact(
    "SELECT order_key, " + ", ".join(
        f"{S.rnd(c, 6)} AS {c}, {S.rnd(f'COALESCE({c}, (SELECT quantile_disc({c}, 0.5) FROM cens))', 6)} AS {c}_imp"
        for c in _IMPUTED) + " FROM cens", _ORDER_CTE, _HIST_CTE, split_cte("hist")))
def _ml_impute(spark, sf_dir):
    df = repurchase_frame(spark, sf_dir).select("order_key", *_IMPUTED)
    imp = Imputer(inputCols=_IMPUTED, outputCols=[f"{c}_imp" for c in _IMPUTED], strategy="median", relativeError=0.0)
    out = imp.fit(df).transform(df)
    return out.select("order_key", *[N.rnd(c, 6).alias(c) for x in _IMPUTED for c in (x, f"{x}_imp")])


@register("ml_scale", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date,
       {S.rnd('(CAST(sales AS DOUBLE) - avg(CAST(sales AS DOUBLE)) OVER ()) / stddev_samp(CAST(sales AS DOUBLE)) OVER ()', 6)} AS sales_z,
       {S.rnd('(CAST(quantity AS DOUBLE) - avg(CAST(quantity AS DOUBLE)) OVER ()) / stddev_samp(CAST(quantity AS DOUBLE)) OVER ()', 6)} AS quantity_z
FROM fact"""))
def _ml_scale(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sales", "quantity"])
    df = df.select("order_id", "product_id", "ship_date", N.dbl("sales").alias("s"),
                   F.col("quantity").cast("double").alias("q"))
    vec = VectorAssembler(inputCols=["s", "q"], outputCol="v").transform(df)
    out = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vec).transform(vec)
    z = vector_to_array("z")
    return out.select("order_id", "product_id", "ship_date", N.rnd(z[0], 6).alias("sales_z"),
                      N.rnd(z[1], 6).alias("quantity_z"))


def _eval_usd(pred: DataFrame) -> DataFrame:
    return regression_metrics(pred, y="profit_d", p="prediction_usd")


@register("ml_pipeline_rows", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date, COUNT(*) AS n, TRUE AS predicted FROM fact
WHERE NOT ({hash_unit_sql(SPLIT_KEY)} < 0.8) GROUP BY order_id, product_id, ship_date"""))
def _ml_pipeline_rows(spark, sf_dir):
    """The rows that the served pipeline predicts: every test row, once, with a number."""
    pred = profit_forest(spark, sf_dir).transform(profit_split(spark, sf_dir)[1])
    p = F.col("prediction_usd")
    return pred.groupBy("order_id", "product_id", "ship_date").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(p.isNotNull() & ~F.isnan(p)).alias("predicted"))


@register("ml_pipeline")
def _ml_pipeline(spark, sf_dir):
    test = profit_split(spark, sf_dir)[1]
    return profit_forest(spark, sf_dir).transform(test).select("row_id", "profit_d", "prediction_usd")


def gbt_regressor() -> GBTRegressor:
    return HistogramGBTRegressor(featuresCol="features", labelCol="log_profit", maxIter=20, maxDepth=5, seed=42)


def linear_regressor() -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol="log_profit")


REGRESSORS = {"linear_regression": linear_regressor, "random_forest": rf_regressor, "gbt": gbt_regressor}


def profit_model(spark, sf_dir, name: str) -> PipelineModel:
    if name == "random_forest":
        return profit_forest(spark, sf_dir)
    train, _, shift = profit_split(spark, sf_dir)
    return fitted(spark, sf_dir, f"profit {name}", lambda: fit_profit(train, REGRESSORS[name](), shift))


def compare_regressors(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Errors of several models on the same rows, one row each, with their place by RMSE."""
    rows = None
    for name, model in models.items():
        one = _eval_usd(model.transform(test)).withColumn("model", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    best = rows.agg(F.array_sort(F.collect_list("rmse")).alias("order"))  # a value per model
    return rows.crossJoin(F.broadcast(best)).withColumn("place", F.array_position("order", F.col("rmse")).cast("int")).drop("order")


@register("ml_compare_regressors")
def _ml_compare_regressors(spark, sf_dir):
    """Linear regression, forest and boosted trees on the same test split."""
    return compare_regressors({name: profit_model(spark, sf_dir, name) for name in REGRESSORS}, profit_split(spark, sf_dir)[1])


def _regression_query(name):
    def run(spark, sf_dir):
        return _eval_usd(profit_model(spark, sf_dir, name).transform(profit_split(spark, sf_dir)[1])).withColumn("model", F.lit(name))
    return run


register("ml_linreg")(_regression_query("linear_regression"))
register("ml_gbt_reg")(_regression_query("gbt"))


@register("ml_rf_reg")
def _ml_rf_reg(spark, sf_dir):
    pred = profit_forest(spark, sf_dir).transform(profit_split(spark, sf_dir)[1])
    return _eval_usd(pred).withColumn("model", F.lit("random_forest"))


def cross_validate(train: DataFrame, shift: float, trees=(50, 100), depths=(5, 8), folds: int = 2, seed: int = 42):
    """The fitted cross validator over the grid; its best model is a whole pipeline, ready to save."""
    rf = rf_regressor()
    grid = ParamGridBuilder().addGrid(rf.numTrees, list(trees)).addGrid(rf.maxDepth, list(depths)).build()
    cv = CrossValidator(estimator=Pipeline(stages=[*profit_stages(rf), money_stage(shift)]), estimatorParamMaps=grid,
                        evaluator=RegressionEvaluator(labelCol="log_profit", metricName="rmse"),
                        numFolds=folds, seed=seed, parallelism=2)
    return cv.fit(with_log_target(train, shift)), grid, rf


@register("ml_cv")
def _ml_cv(spark, sf_dir):
    """Grid results, and the test error of the best model after saving and reloading it."""
    train, test, shift = profit_split(spark, sf_dir)
    cvm, grid, rf = cross_validate(train, shift)
    path = scratch_path(spark, "cv-best")
    save_model(cvm.bestModel, path)
    rmse = RegressionEvaluator(labelCol="profit_d", predictionCol="prediction_usd", metricName="rmse")
    best_rmse = float(rmse.evaluate(load_model(spark, path).transform(test)))
    best = min(range(len(grid)), key=lambda i: cvm.avgMetrics[i])
    rows = [(int(pm[rf.numTrees]), int(pm[rf.maxDepth]), float(m), i == best, best_rmse if i == best else None)
            for i, (pm, m) in enumerate(zip(grid, cvm.avgMetrics, strict=True))]
    return spark.createDataFrame(rows, "num_trees int, max_depth int, avg_rmse_log double, best boolean, "
                                       "best_test_rmse double")


def classifier_report(scored: DataFrame) -> DataFrame:
    """Confusion counts, rates, weighted F1 and both areas of a scored frame (one row).

    The frame is read twice, so the three columns that count are written once: the model scores each row once.
    """
    scored = cut(scored.select("label", "prediction", "return_score"), "scored")
    return confusion_metrics(scored).crossJoin(F.broadcast(ranking_metrics(scored)))  # one row each


def _classifier_query(name):
    def run(spark, sf_dir):
        test = repurchase_data(spark, sf_dir).where(F.col("split") == "test")
        return classifier_report(with_return_score(repurchase_model(spark, sf_dir, name).transform(test)))
    return run


register("ml_logreg")(_classifier_query("logistic_regression"))
register("ml_rf_cls")(_classifier_query("random_forest"))


@register("ml_rf_threshold")
def _ml_rf_threshold(spark, sf_dir):
    """The forest's scores through the sweep on validation; its cut-off applied to the test split."""
    df = repurchase_data(spark, sf_dir).where(F.col("split") != "train")
    scored = freeze(with_return_score(repurchase_model(spark, sf_dir, "random_forest").transform(df))
                    .select("order_key", "split", "label", "return_score"))
    sweep = threshold_sweep(scored.where(F.col("split") == "valid"))
    cut_off = best_threshold(sweep).select("threshold")  # one row
    test = scored.where(F.col("split") == "test").crossJoin(F.broadcast(cut_off)) \
        .withColumn("prediction", N.flag(F.col("return_score") >= F.col("threshold")))
    applied = confusion_metrics(test, by=["threshold"]).withColumn("split", F.lit("test"))
    return sweep.withColumn("split", F.lit("valid")).unionByName(applied)


@register("ml_compare_models")
def _ml_compare_models(spark, sf_dir):
    """Both trained classifiers on the validation and test splits."""
    df = repurchase_data(spark, sf_dir)
    rows = None
    for name in ("logistic_regression", "random_forest"):
        model = repurchase_model(spark, sf_dir, name)
        for split in ("valid", "test"):
            report = classifier_report(with_return_score(model.transform(df.where(F.col("split") == split)))) \
                .select(F.lit(name).alias("model"), F.lit(split).alias("split"), "*")
            rows = report if rows is None else rows.unionByName(report)
    return rows


def feature_importances(model: PipelineModel, frame: DataFrame, features_col: str = "features") -> list:
    """(name, importance) using the assembler's ML attribute metadata, so
    one-hot slot names line up with the vector (H13)."""
    out = model.transform(frame.limit(1))
    meta = out.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = next(x for x in model.stages if hasattr(x, "featureImportances")).featureImportances
    return [(names.get(i, f"f{i}"), float(imp[i])) for i in range(imp.size)]


@register("ml_importance")
def _ml_importance(spark, sf_dir):
    train, model = profit_split(spark, sf_dir)[0], profit_forest(spark, sf_dir)
    return spark.createDataFrame(feature_importances(model, train), "feature string, importance double")


# Fixed values that must equal the reference's: feature-name patterns per
# importance group, checked in this order; the first match wins.
IMPORTANCE_GROUPS = [
    ("Historical customer behavior", ["previous_", "days_since_previous", "customer_lifetime",
                                      "order_frequency_rate", "sales_vs_previous", "discount_vs_previous",
                                      "is_first_order"]),
    ("Current order size/value", ["order_sales", "order_quantity", "order_line_count", "num_products",
                                  "num_categories", "num_sub_categories"]),
    ("Discount", ["discount"]),
    ("Shipping", ["shipping", "ship_days", "ship_mode"]),
    ("Time", ["order_month", "order_quarter", "weekday"]),
    ("Product category", ["main_category", "main_sub_category"]),
    ("Market/customer segment", ["market", "region", "country", "segment", "order_priority"]),
]


def importance_group(name_col: str = "feature"):
    """Feature name -> group as a CASE over ``contains`` (lower-cased)."""
    n = F.lower(F.col(name_col))
    expr = None
    for group, pats in IMPORTANCE_GROUPS:
        cond = None
        for p in pats:
            c = n.contains(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit("Other"))


@register("ml_importance_group")
def _ml_importance_group(spark, sf_dir):
    df = freeze(repurchase_frame(spark, sf_dir).where(F.col("split") == "train"))
    model = fit_repurchase(df, rf_classifier(weighted=False))
    imp = spark.createDataFrame(feature_importances(model, df), "feature string, importance double")
    return imp.groupBy(importance_group().alias("feature_group")).agg(F.sum("importance").alias("importance"))


#: The columns whose shuffling is measured.
PERMUTED = ["sales_capped", "discount_d", "shipping_cost_capped", "cust_hist_profit", "cust_hist_sales", "cust_hist_margin"]


def permutation_importance(model: PipelineModel, test: DataFrame, columns: list[str] = PERMUTED,
                           seed: int = 42) -> DataFrame:
    """R2 drop when one column is shuffled.  The rows are numbered twice, once
    each for all columns (by row id and in hash order, by the skew-safe scan);
    shuffling a column joins its value at one number to the row at the other."""
    ev = RegressionEvaluator(labelCol="profit_d", predictionCol="prediction_usd", metricName="r2")
    numbered = ordered_scan(test, [], ["row_id"], {"place": ("row_number", None)})
    numbered = numbered.withColumn("_h", hash_unit(["row_id"], seed))
    numbered = freeze(ordered_scan(numbered, [], ["_h", "row_id"], {"other": ("row_number", None)}).drop("_h"))
    base = ev.evaluate(model.transform(numbered))
    rows = []
    for c in columns:
        moved = numbered.select(F.col("other").alias("place"), c)
        r2 = ev.evaluate(model.transform(numbered.drop(c).join(moved, "place")))
        rows.append((c, float(r2), float(base - r2)))
    return test.sparkSession.createDataFrame(rows, "feature string, r2_after double, r2_drop double")


@register("ml_perm_importance")
def _ml_perm_importance(spark, sf_dir):
    return permutation_importance(profit_forest(spark, sf_dir), profit_split(spark, sf_dir)[1])


FEATURE_SETS = [("base", PROFIT_NUMERIC[:6], False), ("base+engineered", PROFIT_NUMERIC[:12], False),
                ("base+engineered+history", PROFIT_NUMERIC, False), ("full", PROFIT_NUMERIC, True)]


def ablation(train: DataFrame, test: DataFrame, shift: float, estimator=rf_regressor, sets=FEATURE_SETS) -> DataFrame:
    """R2 on the test rows of one model per set of features."""
    ev = RegressionEvaluator(labelCol="profit_d", predictionCol="prediction_usd", metricName="r2")
    rows = []
    for name, num, inter in sets:
        model = fit_profit(train, estimator(), shift, numeric=num, interaction=inter)
        rows.append((name, float(ev.evaluate(model.transform(test)))))
    return train.sparkSession.createDataFrame(rows, "feature_set string, r2 double")


@register("ml_ablation")
def _ml_ablation(spark, sf_dir):
    return ablation(*profit_split(spark, sf_dir))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark, path: str, fallback: str | None = None) -> PipelineModel:
    """The model at ``path``, or at ``fallback`` if there is nothing at ``path``; a broken model is an error."""
    for p in (path, fallback):
        if p and path_exists(spark, f"{p}/metadata"):
            return PipelineModel.load(p)
    raise FileNotFoundError(f"no model at {path!r} or {fallback!r}")


@register("model_save_load", sql=S.with_fact(f"""
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_equal FROM fact WHERE NOT ({hash_unit_sql(SPLIT_KEY)} < 0.8)"""))
def _model_save_load(spark, sf_dir):
    test, model = profit_split(spark, sf_dir)[1], profit_forest(spark, sf_dir)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:6]}")
    save_model(model, path)
    loaded = load_model(spark, scratch_path(spark, "missing"), fallback=path)
    a = model.transform(test).select("row_id", F.col("prediction_usd").alias("p_fit"))
    b = loaded.transform(test).select("row_id", F.col("prediction_usd").alias("p_loaded"))
    return a.join(b, "row_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.count_if(F.col("p_fit") == F.col("p_loaded")).alias("n_equal"))
