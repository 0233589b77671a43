"""The driver contract and the survey's operator inventory."""

import re

import __spark_entry__ as E

# survey section 2 ids (every row of the inventory tables)
SURVEY_IDS = """
src_csv_fast src_csv_quoted src_view src_parquet snk_parquet_overwrite snk_parquet_append src_kafka snk_kafka
src_range src_empty_fallback snk_collect snk_report_csv model_save_load
proj_select_alias proj_star_plus filter_and_or filter_not_null filter_in filter_between filter_equal_value
case_searched case_simple null_coalesce null_fill null_drop null_typed_literal blank_or_null cast_types
coerce_types clean_rename clean_positive_sales clean_drop_columns
join_left_equi join_stream_static join_cross_scalar join_cross_grid join_positional
agg_global agg_group_one agg_group_multi agg_group_expr agg_count_distinct agg_multi_distinct agg_first
agg_minmax_date agg_conditional_count agg_ratio agg_share_of_total agg_of_agg agg_having agg_distinct agg_mode
agg_value_counts agg_pivot agg_null_counts agg_corr agg_corr_matrix agg_stddev agg_describe agg_quantile
agg_histogram
win_lag_part win_lag_global win_lead_part win_running_sum win_row_number win_dense_rank win_ntile
win_top1_per_key win_prior_rows win_random_index
sort_multi sort_custom_order topk_global topk_subquery topk_per_group sample_fraction sample_keep_outliers
split_random split_time set_union_all set_union_df
fn_round fn_arith_guarded fn_log_exp fn_abs_floor_greatest fn_nullif fn_trim fn_concat_ws fn_date_format
fn_to_date fn_date_parts fn_week_iso fn_week_sunday fn_datediff_add fn_now fn_from_json fn_to_json
fn_vector_to_array fn_rand fn_flags
q01_market_yoy q02_subcat_extremes q03_month_mom q04_pareto q05_shipmode_by_value q06_customer_loyalty
q07_top_products q08_discount_impact q09_loss_in_top_decile q10_segment_category eda_market eda_category
eda_segment eda_monthly eda_discount_bucket eda_profit_sign
dq_schema dq_missing dq_duplicates dq_profile dq_range dq_time dq_structure dq_verdict dq_key_unique
dq_order_id_dupes dq_target_leak dq_horizon
fe_winsorize_fit fe_winsorize fe_winsorize_fixed fe_customer_history fe_ratios fe_market_category
fe_log_target fe_customer_snapshot fe_order_rollup fe_main_category fe_order_history fe_repurchase_label
fe_censor_horizon fe_label_dist fe_class_weight fe_realtime
st_parse_orders st_enrich st_score st_risk_tier st_foreach_batch_dual st_checkpoint st_kpi st_risk_counts
st_latest_n st_profit_trend st_latency
ml_index ml_onehot ml_interaction ml_assemble ml_impute ml_scale ml_pipeline ml_linreg ml_rf_reg ml_gbt_reg
ml_cv ml_logreg ml_rf_cls ml_majority ml_rules ml_eval_reg ml_eval_cls ml_compare ml_error_buckets
ml_error_by_segment ml_metric_by_slice ml_threshold_sweep ml_threshold_apply ml_ablation ml_importance
ml_importance_group ml_perm_importance ml_residuals ml_worst_k ml_interval ml_risk_dist
perf_cache perf_unpersist perf_lineage_cut
""".split()

# results that a trained model decides: the driver checks rows only
ROWS_ONLY = set("""
fn_vector_to_array st_score
ml_pipeline ml_linreg ml_rf_reg ml_gbt_reg ml_cv ml_logreg ml_rf_cls ml_ablation
ml_importance ml_importance_group ml_perm_importance
""".split())


def test_every_survey_id_is_registered():
    missing = [i for i in SURVEY_IDS if i not in E.queries()]
    assert not missing, missing


def test_oracle_for_every_sql_expressible_id():
    sqls = E.oracle_sql()
    missing = [i for i in SURVEY_IDS if i not in ROWS_ONLY and i not in sqls]
    assert not missing, missing


def test_oracle_keys_are_registered_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_names_are_plain_ids():
    for name in E.queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]+", name), name


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["market", "order_year", "total_sales", "sales_growth_pct", "total_profit",
                          "profit_growth_pct"]
