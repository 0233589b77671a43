"""Model evaluation on scored frames (survey 2.13, metric rows).

Every metric family is ONE aggregation over the scored frame (the
reference ran one job per metric, per slice, per bucket and per
threshold).  The registered forms score with fixed rules over the test
tables, so no trained model is needed to check them against SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.functions.realtime import risk_tier
from ledgerline.operators.features import (_HIST_CTE, _ORDER_CTE, TEST_SPLIT, labeled_orders, split_cte)
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut
from ledgerline.plans.ordered import ordered_scan
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines

# ----------------------------------------------------------- regression


def _abs_err(y: str, p: str) -> Column:
    return F.abs(F.col(y) - F.col(p))


def bounded_rel(y: str, p: str, smaller: bool) -> Column:
    """|y - p| divided by the smaller (MBRE) or larger (MIBRE) of |y|, |p|;
    a zero denominator becomes 1e-5, a missing value gives null."""
    both = F.abs(F.col(y)), F.abs(F.col(p))
    den = F.least(*both) if smaller else F.greatest(*both)
    return _abs_err(y, p) / F.when(den == 0, F.lit(1e-5)).otherwise(den)


def regression_metrics(df: DataFrame, y: str = "profit", p: str = "prediction", digits: int = 4) -> DataFrame:
    """RMSE, MAE, R2 (1 - SSE/SST), MAPE and PRED(25) on y != 0, MBRE, MIBRE."""
    e = F.col(y) - F.col(p)
    rel = F.when(F.col(y) != 0, F.abs(e / F.col(y)))
    wide = df.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
        (F.avg(rel) * 100).alias("mape"),
        (F.avg(F.when(rel.isNotNull(), F.when(rel <= 0.25, 1.0).otherwise(0.0))) * 100).alias("pred25"),
        F.avg(bounded_rel(y, p, True)).alias("mbre"), F.avg(bounded_rel(y, p, False)).alias("mibre"),
        F.count(F.lit(1)).alias("n"))
    return wide.select(*[N.rnd(c, digits).alias(c) for c in
                         ("rmse", "mae", "r2", "mape", "pred25", "mbre", "mibre")], "n")


def _reg_sql(src: str, digits: int = 4) -> str:
    e = "(profit - prediction)"
    rel = f"CASE WHEN profit <> 0 THEN abs({e} / profit) END"

    def br(smaller):
        cmp = "<" if smaller else ">"
        return (f"abs({e}) / CASE WHEN abs(profit) {cmp} abs(prediction) THEN "
                f"(CASE WHEN abs(profit) = 0 THEN 1e-5 ELSE abs(profit) END) ELSE "
                f"(CASE WHEN abs(prediction) = 0 THEN 1e-5 ELSE abs(prediction) END) END")
    return (f"SELECT {S.rnd(f'sqrt(avg({e} * {e}))', digits)} AS rmse, {S.rnd(f'avg(abs({e}))', digits)} AS mae, "
            f"{S.rnd(f'1.0 - sum({e} * {e}) / (var_pop(profit) * count(profit))', digits)} AS r2, "
            f"{S.rnd(f'avg({rel}) * 100', digits)} AS mape, "
            f"{S.rnd(f'avg(CASE WHEN ({rel}) IS NOT NULL THEN (CASE WHEN ({rel}) <= 0.25 THEN 1.0 ELSE 0.0 END) END) * 100', digits)} AS pred25, "
            f"{S.rnd(f'avg({br(True)})', digits)} AS mbre, {S.rnd(f'avg({br(False)})', digits)} AS mibre, "
            f"COUNT(*) AS n FROM {src}")


def naive_predictions(spark, sf_dir, cols=()) -> DataFrame:
    """A fixed rule as the 'model': predicted profit = 0.3 * sales - 10000."""
    df = order_lines(spark, sf_dir, ["order_id", "product_id", "ship_date", "sales", "profit", *cols])
    return df.withColumn("prediction", N.dbl(F.col("sales") * F.lit(0.3).cast("decimal(2,1)") - F.lit(10000))) \
             .withColumn("profit", N.dbl("profit"))


_PRED_CTE = """pr AS (SELECT *, CAST(sales * 0.3 - 10000 AS DOUBLE) AS prediction, CAST(profit AS DOUBLE) AS profit_d
  FROM fact),
scored AS (SELECT * EXCLUDE (profit, profit_d), profit_d AS profit FROM pr)"""


@register("ml_eval_reg", sql=S.with_fact(_reg_sql("scored"), _PRED_CTE))
def _ml_eval_reg(spark, sf_dir):
    return regression_metrics(naive_predictions(spark, sf_dir))


def error_buckets(df: DataFrame, edges=(20, 50, 100, 200), y: str = "profit", p: str = "prediction") -> DataFrame:
    """% of rows with |error| below each edge, one aggregation, long form."""
    err = _abs_err(y, p)
    wide = df.agg(*[(F.count_if(err < F.lit(float(e))) * 100.0 / F.count(F.lit(1))).alias(f"b{i}")
                    for i, e in enumerate(edges)])
    stack = ", ".join(f"CAST({float(e)} AS DOUBLE), b{i}" for i, e in enumerate(edges))
    return wide.selectExpr(f"stack({len(edges)}, {stack}) AS (max_abs_error, pct_rows)") \
        .withColumn("pct_rows", N.rnd("pct_rows", 4))


_TEST_EDGES = (2000, 5000, 10000, 20000)


@register("ml_error_buckets", sql=S.with_fact(" UNION ALL ".join(
    f"SELECT CAST({float(e)} AS DOUBLE) AS max_abs_error, "
    f"{S.rnd(f'(COUNT(*) FILTER (WHERE abs(profit - prediction) < {float(e)})) * 100.0 / COUNT(*)', 4)} AS pct_rows "
    f"FROM scored" for e in _TEST_EDGES), _PRED_CTE))
def _ml_error_buckets(spark, sf_dir):
    return error_buckets(naive_predictions(spark, sf_dir), _TEST_EDGES)


SEGMENT_DIMS = ["category", "market", "segment", "order_priority"]


def error_by_segment(df: DataFrame, dims=SEGMENT_DIMS, y="profit", p="prediction") -> DataFrame:
    """MAE and count per value of each dimension: ONE grouping-sets pass."""
    g = df.groupingSets([[d] for d in dims], *dims).agg(
        N.rnd(F.avg(_abs_err(y, p)), 4).alias("mae"), F.count(F.lit(1)).alias("n"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dim = reduce(lambda acc, d: acc.when(F.col(f"_g_{d}") == 0, F.lit(d)), dims[1:],
                 F.when(F.col(f"_g_{dims[0]}") == 0, F.lit(dims[0])))
    val = F.coalesce(*[F.col(d).cast("string") for d in dims])
    return g.select(dim.alias("dimension"), val.alias("value"), "mae", "n")


@register("ml_error_by_segment", sql=S.with_fact(" UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, {S.rnd('avg(abs(profit - prediction))', 4)} AS mae, "
    f"COUNT(*) AS n FROM scored GROUP BY {d}" for d in SEGMENT_DIMS), _PRED_CTE))
def _ml_error_by_segment(spark, sf_dir):
    return error_by_segment(naive_predictions(spark, sf_dir, SEGMENT_DIMS))


def metric_by_slice(df: DataFrame, dim: str, y="profit", p="prediction") -> DataFrame:
    """MAE, RMSE, R2 and count per slice in one groupBy (no per-slice jobs)."""
    e = F.col(y) - F.col(p)
    return df.groupBy(dim).agg(
        N.rnd(F.avg(F.abs(e)), 4).alias("mae"), N.rnd(F.sqrt(F.avg(e * e)), 4).alias("rmse"),
        N.rnd(F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(y)), 4).alias("r2"),
        F.count(F.lit(1)).alias("n"))


@register("ml_metric_by_slice", sql=S.with_fact(f"""
SELECT category, {S.rnd('avg(abs(profit - prediction))', 4)} AS mae,
       {S.rnd('sqrt(avg((profit - prediction) * (profit - prediction)))', 4)} AS rmse,
       {S.rnd('1.0 - sum((profit - prediction) * (profit - prediction)) / (var_pop(profit) * count(profit))', 4)} AS r2,
       COUNT(*) AS n
FROM scored GROUP BY category""", _PRED_CTE))
def _ml_metric_by_slice(spark, sf_dir):
    return metric_by_slice(naive_predictions(spark, sf_dir, ["category"]), "category")


def residual_summary(df: DataFrame, y="profit", p="prediction", bias_tol: float = 1.0) -> DataFrame:
    r = F.col(y) - F.col(p)
    return df.agg(F.count(r).alias("n"), N.rnd(F.avg(r), 4).alias("mean"), N.rnd(F.stddev_samp(r), 4).alias("stddev"),
                  N.rnd(F.min(r), 4).alias("min"), N.rnd(F.max(r), 4).alias("max")) \
        .withColumn("unbiased", F.abs(F.col("mean")) < F.lit(bias_tol))


@register("ml_residuals", sql=S.with_fact(f"""
SELECT COUNT(profit - prediction) AS n, {S.rnd('avg(profit - prediction)', 4)} AS mean,
       {S.rnd('stddev_samp(profit - prediction)', 4)} AS stddev, {S.rnd('min(profit - prediction)', 4)} AS min,
       {S.rnd('max(profit - prediction)', 4)} AS max,
       abs({S.rnd('avg(profit - prediction)', 4)}) < 1.0 AS unbiased
FROM scored""", _PRED_CTE))
def _ml_residuals(spark, sf_dir):
    return residual_summary(naive_predictions(spark, sf_dir))


@register("ml_worst_k", sql=S.with_fact("""
SELECT order_id, product_id, ship_date, profit, prediction, abs(profit - prediction) AS abs_error
FROM scored ORDER BY abs_error DESC, order_id, product_id, ship_date, profit LIMIT 10""", _PRED_CTE))
def _ml_worst_k(spark, sf_dir):
    df = naive_predictions(spark, sf_dir).withColumn("abs_error", _abs_err("profit", "prediction"))
    return df.orderBy(F.desc("abs_error"), "order_id", "product_id", "ship_date", "profit").limit(10) \
        .select("order_id", "product_id", "ship_date", "profit", "prediction", "abs_error")


def prediction_interval(df: DataFrame, y="profit", p="prediction", z: float = 1.96) -> DataFrame:
    sd = df.agg(F.stddev_samp(F.col(y) - F.col(p)).alias("_sd"))  # one row
    return df.crossJoin(F.broadcast(sd)) \
        .withColumn("lower", F.col(p) - F.lit(z) * F.col("_sd")) \
        .withColumn("upper", F.col(p) + F.lit(z) * F.col("_sd")).drop("_sd")


@register("ml_interval", sql=S.with_fact(f"""
SELECT order_id, product_id, ship_date, {S.rnd('prediction - 1.96 * s.sd', 2)} AS lower,
       {S.rnd('prediction + 1.96 * s.sd', 2)} AS upper
FROM scored, (SELECT stddev_samp(profit - prediction) AS sd FROM scored) s""", _PRED_CTE))
def _ml_interval(spark, sf_dir):
    iv = prediction_interval(naive_predictions(spark, sf_dir))
    return iv.select("order_id", "product_id", "ship_date", N.rnd("lower", 2).alias("lower"),
                     N.rnd("upper", 2).alias("upper"))


@register("ml_risk_dist", sql=S.with_fact("""
SELECT CASE WHEN prediction < 0.0 THEN 'LOSS RISK' WHEN prediction >= 0.0 AND prediction <= 10000 THEN 'LOW PROFIT'
            WHEN prediction > 10000 AND prediction <= 50000 THEN 'MEDIUM PROFIT' ELSE 'HIGH PROFIT OPPORTUNITY' END
         AS risk_level, COUNT(*) AS n
FROM scored GROUP BY 1""", _PRED_CTE))
def _ml_risk_dist(spark, sf_dir):
    df = naive_predictions(spark, sf_dir)
    return df.groupBy(risk_tier("prediction", 10000.0, 50000.0).alias("risk_level")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- classification


def confusion_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", digits: int = 4,
                      by: list[str] | None = None) -> DataFrame:
    """TN/FP/FN/TP, accuracy, precision, recall, F1 (denominators floored at
    1, F1's at 1e-12) and the F1 of both classes weighted by their rows, in
    one aggregation (optionally per group)."""
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0.0) & (p == 0.0)).alias("tn"), F.count_if((y == 0.0) & (p == 1.0)).alias("fp"),
            F.count_if((y == 1.0) & (p == 0.0)).alias("fn"), F.count_if((y == 1.0) & (p == 1.0)).alias("tp")]
    base = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return with_rates(base, digits)


def with_rates(cm: DataFrame, digits: int = 4) -> DataFrame:
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    prec = tp / F.greatest(tp + fp, F.lit(1.0))
    rec = tp / F.greatest(tp + fn, F.lit(1.0))
    return (cm.withColumn("accuracy", N.rnd((tp + tn) / F.greatest(tp + tn + fp + fn, F.lit(1.0)), digits))
            .withColumn("precision_pos", N.rnd(prec, digits)).withColumn("recall_pos", N.rnd(rec, digits))
            .withColumn("f1_pos", N.rnd(_f1(tp, fp, fn), digits))
            .withColumn("weighted_f1", N.rnd((_f1(tp, fp, fn) * (tp + fn) + _f1(tn, fn, fp) * (tn + fp))
                                             / F.greatest(tp + tn + fp + fn, F.lit(1.0)), digits)))


def _f1(hit: Column, false: Column, missed: Column) -> Column:
    prec, rec = hit / F.greatest(hit + false, F.lit(1.0)), hit / F.greatest(hit + missed, F.lit(1.0))
    return F.lit(2.0) * prec * rec / F.greatest(prec + rec, F.lit(1e-12))


def ranking_metrics(scored: DataFrame, score: str = "return_score", label: str = "label", digits: int = 6) -> DataFrame:
    """ROC-AUC and PR-AUC (average precision) of a score, ties counted as ties; one row.

    Rows are reduced to one per distinct score; the running counts from the
    highest score down come from the skew-safe global scan.
    """
    y = F.col(label)
    per = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.count_if(y == 1.0).alias("pos"), F.count_if(y == 0.0).alias("neg"))
    run = ordered_scan(per, [], [F.desc("s")], {"tp": ("run_sum", "pos"), "fp": ("run_sum", "neg")})
    above = F.col("tp") - F.col("pos") / F.lit(2.0)
    sums = run.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(F.col("neg") * above).alias("ranked"),
                   F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("precise"))
    return sums.select(N.rnd(F.try_divide(F.col("ranked"), F.col("p") * F.col("n").cast("double")), digits).alias("roc_auc"),
                       N.rnd(F.try_divide(F.col("precise"), F.col("p").cast("double")), digits).alias("pr_auc"))


def _rates_sql(src: str, digits: int = 4) -> str:
    prec = "(CAST(tp AS DOUBLE) / GREATEST(CAST(tp + fp AS DOUBLE), 1.0))"
    rec = "(CAST(tp AS DOUBLE) / GREATEST(CAST(tp + fn AS DOUBLE), 1.0))"
    return (f"SELECT *, {S.rnd('CAST(tp + tn AS DOUBLE) / GREATEST(CAST(tp + tn + fp + fn AS DOUBLE), 1.0)', digits)} AS accuracy, "
            f"{S.rnd(prec, digits)} AS precision_pos, {S.rnd(rec, digits)} AS recall_pos, "
            f"{S.rnd(_f1_sql('tp', 'fp', 'fn'), digits)} AS f1_pos, {S.rnd(_WEIGHTED_F1_SQL, digits)} AS weighted_f1 "
            f"FROM {src}")


def _f1_sql(hit: str, false: str, missed: str) -> str:
    prec = f"(CAST({hit} AS DOUBLE) / GREATEST(CAST({hit} + {false} AS DOUBLE), 1.0))"
    rec = f"(CAST({hit} AS DOUBLE) / GREATEST(CAST({hit} + {missed} AS DOUBLE), 1.0))"
    return f"2.0 * {prec} * {rec} / GREATEST({prec} + {rec}, 1e-12)"


_WEIGHTED_F1_SQL = (f"(({_f1_sql('tp', 'fp', 'fn')}) * CAST(tp + fn AS DOUBLE) + ({_f1_sql('tn', 'fn', 'fp')}) "
                    "* CAST(tn + fp AS DOUBLE)) / GREATEST(CAST(tp + tn + fp + fn AS DOUBLE), 1.0)")


def _ranking_sql(score: str, where: str) -> str:
    return f"""(SELECT {S.rnd('SUM(neg * (tp - pos / 2.0::DOUBLE)) / NULLIF(SUM(pos) * CAST(SUM(neg) AS DOUBLE), 0)', 6)} AS roc_auc,
       {S.rnd('SUM(pos * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / NULLIF(CAST(SUM(pos) AS DOUBLE), 0)', 6)} AS pr_auc
FROM (SELECT pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp
      FROM (SELECT {score} AS s, COUNT(*) FILTER (WHERE label = 1.0) AS pos, COUNT(*) FILTER (WHERE label = 0.0) AS neg
            FROM cens WHERE {where} GROUP BY 1) per
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) run)"""


def _cm_sql(pred_sql: str, where: str = "TRUE", group: str = "") -> str:
    g_sel = f"{group}, " if group else ""
    g_by = f" GROUP BY {group}" if group else ""
    return (f"(SELECT {g_sel}COUNT(*) FILTER (WHERE label = 0.0 AND ({pred_sql}) = 0.0) AS tn, "
            f"COUNT(*) FILTER (WHERE label = 0.0 AND ({pred_sql}) = 1.0) AS fp, "
            f"COUNT(*) FILTER (WHERE label = 1.0 AND ({pred_sql}) = 0.0) AS fn, "
            f"COUNT(*) FILTER (WHERE label = 1.0 AND ({pred_sql}) = 1.0) AS tp FROM cens WHERE {where}{g_by}) cm")


_HIST_SPLIT = (_ORDER_CTE, _HIST_CTE, split_cte("hist"))


def _labeled(spark, sf_dir) -> DataFrame:
    return labeled_orders(spark, sf_dir, TEST_SPLIT, with_history=True)


# The rule classifiers (name, condition); the oracle uses the same text
RULES = [
    ("previous_order_count >= 1", "previous_order_count >= 1"),
    ("previous_order_count >= 2", "previous_order_count >= 2"),
    ("days_since_previous_order <= 90", "days_since_previous_order <= 90"),
    ("previous_order_count >= 2 OR days_since_previous_order <= 90",
     "previous_order_count >= 2 OR days_since_previous_order <= 90"),
    ("previous_order_count >= 2 AND days_since_previous_order <= 180",
     "previous_order_count >= 2 AND days_since_previous_order <= 180"),
]


def _rule_pred_sql(cond: str) -> str:
    return f"CASE WHEN COALESCE({cond}, FALSE) THEN 1.0 ELSE 0.0 END"


_SCORE_SQL = "CASE WHEN days_since_previous_order IS NULL THEN 0.0 ELSE 90.0 / (90.0 + days_since_previous_order) END"


@register("ml_eval_cls", sql=S.with_fact(
    "SELECT * FROM (" + _rates_sql(_cm_sql(_rule_pred_sql(RULES[1][1]), "split = 'test'")) + ") c, "
    + _ranking_sql(_SCORE_SQL, "split = 'test'") + " a", *_HIST_SPLIT))
def _ml_eval_cls(spark, sf_dir):
    df = return_score(_labeled(spark, sf_dir).where(F.col("split") == "test")).withColumn("prediction", N.flag(F.expr(RULES[1][1])))
    df = cut(df.select("label", "prediction", "return_score"), "scored")  # read for the counts and for the ranking
    rates = confusion_metrics(df)
    return rates.crossJoin(F.broadcast(ranking_metrics(df)))  # one row each


def rule_predictions(df: DataFrame, rules=RULES) -> DataFrame:
    """All rule classifiers in one pass: each row is replicated once per rule
    (a fixed, small number) and evaluated with one grouped aggregation."""
    arr = F.array(*[F.struct(F.lit(name).alias("model"), N.flag(F.expr(cond)).alias("prediction"))
                    for name, cond in rules])
    return df.select("*", F.explode(arr).alias("_r")).select("*", "_r.model", "_r.prediction").drop("_r")


def select_rule(valid_metrics: DataFrame) -> DataFrame:
    """Best rule on validation: highest F1, then precision, then name."""
    return valid_metrics.orderBy(F.desc("f1_pos"), F.desc("precision_pos"), "model").limit(1)


_ALL_RULES_SQL = "(" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, split, tn, fp, fn, tp, accuracy, precision_pos, recall_pos, f1_pos, weighted_f1 FROM ("
    + _rates_sql(_cm_sql(_rule_pred_sql(sql), "split IN ('valid', 'test')", "split")) + ") r" for name, sql in RULES) + ")"
_BEST_RULE_SQL = "(SELECT model FROM rules WHERE split = 'valid' ORDER BY f1_pos DESC, precision_pos DESC, model LIMIT 1)"


def rules_report(labeled: DataFrame) -> DataFrame:
    """All rules on validation and test; ``selected`` marks the rule that validation chooses."""
    df = labeled.where(F.col("split").isin("valid", "test"))
    report = confusion_metrics(rule_predictions(df), by=["model", "split"])
    best = select_rule(report.where(F.col("split") == "valid")).select(F.col("model").alias("_best"))  # one row
    return report.crossJoin(F.broadcast(best)).withColumn("selected", F.col("model") == F.col("_best")).select(
        "model", "split", "selected", "tn", "fp", "fn", "tp", "accuracy", "precision_pos", "recall_pos", "f1_pos",
        "weighted_f1")


@register("ml_rules", sql=S.with_fact(f"SELECT *, model = {_BEST_RULE_SQL} AS selected FROM rules", *_HIST_SPLIT,
                                      f"rules AS (SELECT * FROM {_ALL_RULES_SQL} t)"))
def _ml_rules(spark, sf_dir):
    return rules_report(_labeled(spark, sf_dir))


@register("ml_majority", sql=S.with_fact(_rates_sql(_cm_sql(
    "(SELECT label FROM cens WHERE split = 'train' GROUP BY label ORDER BY COUNT(*) DESC, label LIMIT 1)",
    "split = 'test'")), *_HIST_SPLIT))
def _ml_majority(spark, sf_dir):
    lab = _labeled(spark, sf_dir)
    mode = lab.where(F.col("split") == "train").groupBy("label").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "label").limit(1).select(F.col("label").alias("prediction"))  # one row
    test = lab.where(F.col("split") == "test").crossJoin(F.broadcast(mode))
    return confusion_metrics(test)


def return_score(df: DataFrame) -> DataFrame:
    """A rule score in [0, 1]: recency of the previous order (0 if none)."""
    d = F.col("days_since_previous_order")
    return df.withColumn("return_score", F.when(d.isNull(), F.lit(0.0)).otherwise(F.lit(90.0) / (F.lit(90.0) + d)))


THRESHOLDS = [i * 0.05 for i in range(1, 20)]  # the same doubles as id * 0.05 in Spark


def threshold_sweep(scored: DataFrame, score: str = "return_score", label: str = "label",
                    thresholds=THRESHOLDS) -> DataFrame:
    """Confusion counts and rates for every threshold (score >= t).

    Each row is reduced to the index of the highest threshold it passes
    (exact comparisons against the same doubles), counted per (index,
    label) -- at most len(thresholds)+1 groups -- and the per-threshold
    counts are sums over indexes; no row is replicated per threshold.
    """
    s = F.col(score)
    idx = F.lit(0)
    for i, t in enumerate(thresholds, start=1):
        idx = F.when(s >= F.lit(t), F.lit(i)).otherwise(idx)
    buckets = scored.groupBy(idx.alias("idx")).agg(F.count_if(F.col(label) == 1.0).alias("pos"),
                                                   F.count_if(F.col(label) == 0.0).alias("neg"))
    spark = scored.sparkSession
    grid = spark.range(1, len(thresholds) + 1).select(
        F.col("id").cast("int").alias("t_id"), (F.col("id") * F.lit(0.05)).alias("threshold"))
    if thresholds != THRESHOLDS:
        grid = spark.createDataFrame(list(enumerate(thresholds, start=1)), "t_id int, threshold double")
    tot = buckets.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # grid (<= 19 rows) x buckets (<= 20 rows): bounded, broadcast
    cm = (grid.crossJoin(F.broadcast(buckets)).where(F.col("idx") >= F.col("t_id"))
          .groupBy("t_id", "threshold").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")))
    cm = grid.join(cm, ["t_id", "threshold"], "left").na.fill({"tp": 0, "fp": 0}).crossJoin(F.broadcast(tot)) \
        .withColumn("fn", F.col("P") - F.col("tp")).withColumn("tn", F.col("N") - F.col("fp")).drop("P", "N")
    return with_rates(cm).drop("t_id").select("threshold", "tn", "fp", "fn", "tp", "accuracy", "precision_pos",
                                              "recall_pos", "f1_pos", "weighted_f1")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1, then precision, then the lowest threshold."""
    return sweep.orderBy(F.desc("f1_pos"), F.desc("precision_pos"), "threshold").limit(1)


def _sweep_sql(where: str) -> str:
    return ("SELECT threshold, tn, fp, fn, tp, accuracy, precision_pos, recall_pos, f1_pos, weighted_f1 FROM (" + _rates_sql(
        f"""(SELECT g.threshold,
        COUNT(*) FILTER (WHERE c.label = 0.0 AND NOT (c.sc >= g.threshold)) AS tn,
        COUNT(*) FILTER (WHERE c.label = 0.0 AND c.sc >= g.threshold) AS fp,
        COUNT(*) FILTER (WHERE c.label = 1.0 AND NOT (c.sc >= g.threshold)) AS fn,
        COUNT(*) FILTER (WHERE c.label = 1.0 AND c.sc >= g.threshold) AS tp
      FROM (SELECT CAST(i AS DOUBLE) * CAST(0.05 AS DOUBLE) AS threshold FROM range(1, 20) t(i)) g,
           (SELECT label, {_SCORE_SQL} AS sc FROM cens WHERE {where}) c
      GROUP BY g.threshold) cm""") + ") s")


@register("ml_threshold_sweep", sql=S.with_fact(_sweep_sql("split = 'valid'"), *_HIST_SPLIT))
def _ml_threshold_sweep(spark, sf_dir):
    valid = return_score(_labeled(spark, sf_dir).where(F.col("split") == "valid"))
    return threshold_sweep(valid)


@register("join_cross_grid", sql=S.with_fact(
    "SELECT threshold, tp + fp AS n_predicted_positive FROM (" + _sweep_sql("split = 'valid'") + ") x",
    *_HIST_SPLIT))
def _join_cross_grid(spark, sf_dir):
    valid = return_score(_labeled(spark, sf_dir).where(F.col("split") == "valid"))
    return threshold_sweep(valid).select("threshold", (F.col("tp") + F.col("fp")).alias("n_predicted_positive"))


@register("ml_threshold_apply", sql=S.with_fact(
    "SELECT * FROM (" + _rates_sql(_cm_sql(f"CASE WHEN ({_SCORE_SQL}) >= b.threshold THEN 1.0 ELSE 0.0 END",
                                            "split = 'test'").replace(
        "FROM cens WHERE", "FROM cens, (SELECT threshold FROM (" + _sweep_sql("split = 'valid'")
        + ") s ORDER BY f1_pos DESC, precision_pos DESC, threshold LIMIT 1) b WHERE")) + ") z", *_HIST_SPLIT))
def _ml_threshold_apply(spark, sf_dir):
    lab = return_score(_labeled(spark, sf_dir))
    best = best_threshold(threshold_sweep(lab.where(F.col("split") == "valid"))).select("threshold")  # one row
    test = lab.where(F.col("split") == "test").crossJoin(F.broadcast(best)) \
        .withColumn("prediction", N.flag(F.col("return_score") >= F.col("threshold")))
    return confusion_metrics(test)


_MAJORITY_SQL = "(SELECT label FROM cens WHERE split = 'train' GROUP BY label ORDER BY COUNT(*) DESC, label LIMIT 1)"
_REPORT = "model, split, tn, fp, fn, tp, accuracy, precision_pos, recall_pos, f1_pos, weighted_f1"


@register("ml_compare", sql=S.with_fact(
    f"SELECT {_REPORT} FROM rules UNION ALL SELECT 'best rule: ' || model, {_REPORT[7:]} FROM rules "
    f"WHERE model = {_BEST_RULE_SQL} UNION ALL SELECT 'majority' AS {_REPORT} FROM ("
    + _rates_sql(_cm_sql(_MAJORITY_SQL, "split IN ('valid', 'test')", "split")) + ") m", *_HIST_SPLIT,
    f"rules AS (SELECT * FROM {_ALL_RULES_SQL} t)"))
def _ml_compare(spark, sf_dir):
    """All rules, the rule that validation chooses and the majority class, on validation and test.

    The trained classifiers are in ``ml_compare_models``, with the same columns.
    """
    labeled = _labeled(spark, sf_dir)
    rules = rules_report(labeled)
    best = rules.where("selected").withColumn("model", F.concat(F.lit("best rule: "), "model"))
    mode = labeled.where(F.col("split") == "train").groupBy("label").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "label").limit(1).select(F.col("label").alias("prediction"))  # one row
    majority = confusion_metrics(labeled.where(F.col("split").isin("valid", "test")).crossJoin(F.broadcast(mode)),
                                 by=["split"]).withColumn("model", F.lit("majority"))
    columns = _REPORT.split(", ")
    return rules.select(columns).unionByName(best.select(columns)).unionByName(majority.select(columns))
