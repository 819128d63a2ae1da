"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the driver's tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewise.operators.common import CATALOG_ROLES as R
from pricewise.operators.common import join_small
from pricewise.plans import value_plan as vp

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- minimum slice ---------------------------------------------------------

@register("scenario_topn")
def q_scenario_topn(spark: SparkSession, src: str) -> DataFrame:
    return vp.value_recommendations(spark, src, "part")


@register("scenario_topn_orders")
def q_scenario_topn_orders(spark: SparkSession, src: str) -> DataFrame:
    return vp.value_recommendations(spark, src, "orders")


@register("recommendation_validation")
def q_reco_validation(spark: SparkSession, src: str) -> DataFrame:
    return vp.value_validation(spark, src, "part")


@register("recommendation_validation_orders")
def q_reco_validation_orders(spark: SparkSession, src: str) -> DataFrame:
    return vp.value_validation(spark, src, "orders")


# --- cleaning (scalar functions) -------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from pricewise.functions import clean as C  # noqa: E402
from pricewise.operators import positions as PO  # noqa: E402
from pricewise.operators import profile as P  # noqa: E402
from pricewise.sources.catalog import catalog, messy_price_text  # noqa: E402
from pricewise.sources.tables import read_table  # noqa: E402

PROFILE_TABLES = ["customer", "part", "events", "documents"]


@register("normalize_missing")
def q_normalize_missing(spark, src):
    return C.normalize_missing(messy_price_text(spark, src))


@register("normalize_missing_documents")
def q_normalize_missing_docs(spark, src):
    return C.normalize_missing(read_table(spark, src, "documents").select("doc_id", "text", "lang", "source"))


@register("clean_mojibake")
def q_clean_mojibake(spark, src):
    return messy_price_text(spark, src).select("item_id", C.clean_mojibake("misc_price").alias("cleaned"))


@register("clean_mojibake_documents")
def q_clean_mojibake_docs(spark, src):
    return read_table(spark, src, "documents").select("doc_id", C.clean_mojibake("text").alias("cleaned"))


@register("parse_price_eur")
def q_parse_price(spark, src):
    return messy_price_text(spark, src).select("item_id", C.parse_price_eur("misc_price").alias("price_eur"))


@register("parse_price_eur_documents")
def q_parse_price_docs(spark, src):
    return read_table(spark, src, "documents").select("doc_id", C.parse_price_eur("text").alias("price_eur"))


@register("price_tier")
def q_price_tier(spark, src):
    parsed = messy_price_text(spark, src).select("item_id", C.parse_price_eur("misc_price").alias("price_eur"))
    return parsed.select("item_id", "price_eur", C.price_tier("price_eur").alias("price_tier"))


@register("to_numeric_lenient")
def q_to_numeric(spark, src):
    cust = read_table(spark, src, "customer")
    return cust.select("c_custkey", *[C.to_numeric_lenient(F.col(c).cast("string")).alias(c + "_num")
                                      for c in ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]])


@register("clip_min")
def q_clip_min(spark, src):
    li = read_table(spark, src, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     C.clip_min(F.col("l_extendedprice") * F.col("l_discount"), 1.0).alias("discount_amount"))


@register("log_target")
def q_log_target(spark, src):
    cat = catalog(spark, src, "part")
    return cat.select("item_id", C.log_target("price_eur", "log_price_eur").alias("log_price"),
                      C.inverse_log_target(C.log_target("price_eur", "log_price_eur"), "log_price_eur").alias("price_back"),
                      C.log_target("price_eur", "price_eur").alias("price_same"))


@register("ppr_ratio")
def q_ppr_ratio(spark, src):
    return catalog(spark, src, "orders").select("item_id", C.ppr_ratio().alias("performance_to_price_ratio"))


# --- profiling ---------------------------------------------------------------

def _profile_input(spark, src, table):
    return C.normalize_missing(read_table(spark, src, table))


for _t in PROFILE_TABLES:
    def _mk(t):
        def q(spark, src):
            return P.column_profile(_profile_input(spark, src, t), with_dtype=False)
        return q
    register(f"column_profile_{_t}")(_mk(_t))


@register("profile_extremes")
def q_profile_extremes(spark, src):
    return P.profile_extremes(P.column_profile(_profile_input(spark, src, "events"), with_dtype=False))


@register("duplicate_group_sizes")
def q_dup_groups(spark, src):
    return P.duplicate_group_sizes(catalog(spark, src, "part"), ["oem", "model"])


@register("duplicate_group_sizes_model")
def q_dup_groups_model(spark, src):
    return P.duplicate_group_sizes(catalog(spark, src, "part"), ["model"])


@register("top_k_values")
def q_top_k(spark, src):
    return P.top_k_values(_profile_input(spark, src, "events"), None, 15)


@register("top_k_values_documents")
def q_top_k_documents(spark, src):
    return P.top_k_values(_profile_input(spark, src, "documents"), None, 15)


@register("scenario_topn_many")
def q_scenario_topn_many(spark, src):
    """One request per customer: the balance and more as budget, a third of them with a segment or brand."""
    vf = vp.value_frame(spark, src, "orders")
    requests = read_table(spark, src, "customer").select(
        F.col("c_custkey").cast("int").alias("scenario"), F.lit("customer").alias("scenario_label"),
        (F.abs("c_acctbal") * 40 + 1000).alias("budget_eur"),
        F.when(F.col("c_custkey") % 3 == 0, F.element_at(F.array(F.lit("Entry"), F.lit("Mid-range"), F.lit("Flagship")), (F.col("c_nationkey") % 3 + 1).cast("int"))).alias("segment"),
        F.when(F.col("c_custkey") % 5 == 0, "3-MEDIUM").alias("brand"), F.when(F.col("c_custkey") % 2 == 0, 3).cast("int").alias("top_n"))
    return RE.scenario_topn(vf, requests, R).select("scenario", "recommendation_rank", "item_id")


@register("top_k_values_part")
def q_top_k_part(spark, src):
    return P.top_k_values(_profile_input(spark, src, "part"), None, 15)


@register("numeric_like")
def q_numeric_like(spark, src):
    return P.numeric_like(_profile_input(spark, src, "customer"))


@register("histogram")
def q_histogram(spark, src):
    return P.histogram(read_table(spark, src, "customer"), "c_acctbal", P.COLUMN_BINS)


@register("histogram_price")
def q_histogram_price(spark, src):
    parsed = messy_price_text(spark, src).select(C.parse_price_eur("misc_price").alias("price_eur"))
    return P.histogram(parsed, "price_eur", P.PRICE_BINS)


@register("tier_counts")
def q_tier_counts(spark, src):
    parsed = messy_price_text(spark, src).select(C.parse_price_eur("misc_price").alias("price_eur"))
    return P.tier_counts(parsed, "price_eur")


@register("tier_counts_documents")
def q_tier_counts_docs(spark, src):
    parsed = read_table(spark, src, "documents").select(C.parse_price_eur("text").alias("price_eur"))
    return P.tier_counts(parsed, "price_eur")


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("input_summary")
def q_input_summary(spark, src):
    return P.input_summary({t: read_table(spark, src, t) for t in ALL_TABLES})


@register("sorted_index_curve")
def q_sorted_curve(spark, src):
    return P.sorted_index_curve(catalog(spark, src, "orders"), "price_eur", 101)


@register("column_profile_report")
def q_profile_report(spark, src):
    return P.column_profile(_profile_input(spark, src, "part"), with_dtype=True)


# --- reports, joins, windows, transforms --------------------------------------

from pricewise.operators import features as FE  # noqa: E402
from pricewise.operators import folds as FO  # noqa: E402
from pricewise.operators import metrics as ME  # noqa: E402
from pricewise.operators import outliers as OU  # noqa: E402
from pricewise.operators import recommend as RE  # noqa: E402
from pricewise.operators import reports as RP  # noqa: E402
from pricewise.operators import segments as SG  # noqa: E402
from pricewise.plans import harness as HA  # noqa: E402
from pricewise.plans import price_plan as PP  # noqa: E402
from pricewise.sources import tables as TB  # noqa: E402


@register("read_table")
def q_read_table(spark, src):
    return TB.read_table(spark, src, "part")


@register("brand_summary")
def q_brand_summary(spark, src):
    return RP.brand_summary(PP.readable(spark, src, "part"), R)


@register("segment_summary")
def q_segment_summary(spark, src):
    return RP.segment_summary(vp.value_frame(spark, src, "part"), R)


@register("rename_relabel")
def q_rename_relabel(spark, src):
    s = RP.segment_summary(vp.value_frame(spark, src, "part"), R)
    order = F.create_map(*[x for k, v in SG.SEGMENT_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return s.select(F.col("segment").alias("segment_name"), order[F.col("segment")].alias("segment_order"),
                    F.col("count").alias("value"))


def _given_clusters(spark, src):
    seg = vp.segmented_catalog(spark, src, "part")
    return seg.withColumn("cluster", FO.fold_of("item_id", 3))


@register("cluster_order")
def q_cluster_order(spark, src):
    return SG.cluster_order(_given_clusters(spark, src), "cluster", "price_eur", "spec_score_0_100")


@register("label_map_join")
def q_label_map_join(spark, src):
    return SG.assign_segment_labels(_given_clusters(spark, src), "cluster", R).select("item_id", "cluster", "segment")


@register("outlier_method_counts")
def q_outlier_counts(spark, src):
    return OU.outlier_method_counts(_with_isolation(spark, src, "part"))


@register("outlier_method_counts_orders")
def q_outlier_counts_orders(spark, src):
    return OU.outlier_method_counts(_with_isolation(spark, src, "orders"))


@register("outlier_validation")
def q_outlier_validation(spark, src):
    return OU.outlier_validation(vp.value_frame(spark, src, "part"), R)


@register("outlier_by_segment")
def q_outlier_by_segment(spark, src):
    return OU.outlier_by_segment(vp.value_frame(spark, src, "orders"), R)


@register("recommendation_lift")
def q_reco_lift(spark, src):
    recs = vp.value_recommendations(spark, src, "part")
    return RE.recommendation_lift(recs, catalog(spark, src, "part"), R)


@register("numeric_reference")
def q_numeric_reference(spark, src):
    rd = PP.readable(spark, src, "part")
    return RP.numeric_reference(rd, [FE.NUM_PREFIX + c for c in ["is_premium_brand"] + PP.NUMERIC_COLS])


@register("distinct_brands")
def q_distinct_brands(spark, src):
    return RP.distinct_brands(catalog(spark, src, "part"))


@register("feature_medians")
def q_feature_medians(spark, src):
    rd = PP.readable(spark, src, "orders")
    return FE.column_medians(rd, ["is_premium_brand"] + PP.NUMERIC_COLS)


@register("feature_importance_correlation")
def q_importance_corr(spark, src):
    return PP.importance_by_correlation(spark, src, "part")


@register("topn_features_per_model")
def q_topn_features(spark, src):
    return RP.topn_features_per_model(PP.importance_by_correlation(spark, src, "part"), 15)


@register("consensus_factors")
def q_consensus(spark, src):
    return RP.consensus_factors(PP.importance_by_correlation(spark, src, "part"), 15)


@register("brand_importance_share")
def q_brand_share(spark, src):
    return RP.brand_importance_share(PP.importance_by_correlation(spark, src, "part"))


@register("top_price_drivers")
def q_top_drivers(spark, src):
    return RP.top_price_drivers(PP.importance_by_correlation(spark, src, "part"), 20)


@register("prefix_flag")
def q_prefix_flag(spark, src):
    imp = PP.importance_by_correlation(spark, src, "part")
    return imp.select("model", "feature", RP.prefix_flag("feature").alias("driver_type"))


@register("kfold_assign")
def q_kfold(spark, src):
    return FO.kfold_assign(catalog(spark, src, "orders").select("item_id"), "item_id")


@register("holdout_split")
def q_holdout(spark, src):
    train, test = FO.holdout_split(catalog(spark, src, "orders").select("item_id", "price_eur"), "item_id")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@register("baseline_median")
def q_baseline_median(spark, src):
    enc = PP.encoded_with_folds(spark, src, "part")
    return FO.baseline_median(enc, TB.TARGET_COL)


def _harness_predictions(spark, src):
    return HA.oof_baseline_predictions(PP.encoded_with_folds(spark, src, "part"), "num__avg_quantity")


@register("oof_predict_ols")
def q_oof_ols(spark, src):
    return _harness_predictions(spark, src)


@register("regression_metrics")
def q_regression_metrics(spark, src):
    return ME.regression_metrics(_harness_predictions(spark, src))


@register("cv_mean_metrics")
def q_cv_means(spark, src):
    return ME.cv_mean_metrics(ME.regression_metrics(_harness_predictions(spark, src)))


@register("model_leaderboard")
def q_leaderboard(spark, src):
    return ME.best_model(ME.cv_mean_metrics(ME.regression_metrics(_harness_predictions(spark, src))))


@register("leakage_guard")
def q_leakage(spark, src):
    return TB.leakage_report(catalog(spark, src, "part"))


@register("drop_target")
def q_drop_target(spark, src):
    enc = PP.encoded(spark, src, "part")
    return TB.load_price_features(TB.drop_leakage(enc.join(catalog(spark, src, "part").select(
        F.col("item_id").alias("row_id"), "value_score", "price_tier"), "row_id")))


@register("load_price_features")
def q_load_price_features(spark, src):
    return TB.load_price_features(PP.encoded(spark, src, "part"))


@register("budget_filter")
def q_budget_filter(spark, src):
    seg = vp.segmented_catalog(spark, src, "part")
    return seg.filter((F.col("price_eur") <= 950.0) & (F.col("segment") == "Mid-range") & (F.col("brand_group") == "Brand#7"))


@register("non_null_key_filter")
def q_non_null(spark, src):
    return catalog(spark, src, "orders").dropna(subset=["brand_group", "spec_score_0_100"]).select("item_id", "brand_group")


def _with_isolation(spark, src, kind):
    """Value frame whose isolation rule has a deterministic flag (every third item)
    in place of the forest's, so that all three rules can be checked in SQL."""
    vf = vp.value_frame(spark, src, kind).withColumn("_iso", F.col("item_id") % 3 == 0)
    return OU.outlier_predicates(vf, R, "_iso").drop("_iso")


def _flags(spark, src, kind="part"):
    return _with_isolation(spark, src, kind).select(
        "item_id", "segment", "market_underpriced_outlier", "zscore_value_outlier",
        "isolation_value_outlier", "is_value_outlier")


@register("outlier_predicates")
def q_outlier_predicates(spark, src):
    return _flags(spark, src, "orders")


@register("flag_union")
def q_flag_union(spark, src):
    f = _flags(spark, src, "orders")
    return f.select("item_id", F.col("is_value_outlier").alias("flag_union"))


@register("flag_intersection")
def q_flag_intersection(spark, src):
    f = _flags(spark, src, "orders")
    return f.select("item_id", (F.col("zscore_value_outlier") & F.col("isolation_value_outlier")).alias("flag_intersection"))


@register("segment_baselines")
def q_segment_baselines(spark, src):
    return SG.segment_baselines(vp.segmented_catalog(spark, src, "orders"), R).select(
        "item_id", "segment", "segment_mean_value_score", "segment_median_price_eur",
        "segment_median_performance_to_price_ratio")


@register("segment_lifts")
def q_segment_lifts(spark, src):
    return SG.segment_lifts(SG.segment_baselines(vp.segmented_catalog(spark, src, "orders"), R), R).select(
        "item_id", "value_score_lift_vs_segment", "price_discount_vs_segment_median")


@register("segment_zscore")
def q_segment_zscore(spark, src):
    return SG.segment_zscore(vp.segmented_catalog(spark, src, "orders"),
                             {"value_score": "value_z_in_segment", "avg_discount": "discount_z_in_segment"}).select(
        "item_id", "value_z_in_segment", "discount_z_in_segment")


@register("topn_brands_per_segment")
def q_topn_brands(spark, src):
    return SG.topn_brands_per_segment(vp.segmented_catalog(spark, src, "part"), 3, R)


@register("market_price_features")
def q_market_features(spark, src):
    return vp.value_frame(spark, src, "part").select(
        "item_id", "expected_market_price_eur", "market_price_gap_eur", "market_price_discount_ratio")


@register("high_value_filter")
def q_high_value(spark, src):
    return OU.high_value_filter(catalog(spark, src, "orders"), "value_score").select("item_id", "high_value")


@register("value_outliers")
def q_value_outliers(spark, src):
    return vp.value_frame(spark, src, "part").drop("fold", "market_pred")


@register("rank_value_outliers")
def q_rank_outliers(spark, src):
    return OU.rank_value_outliers(vp.value_frame(spark, src, "orders"), R).select(
        "item_id", "performance_to_price_ratio", "market_price_discount_ratio", "value_score")


@register("recommend_topn")
def q_recommend_topn(spark, src):
    return RE.recommend_topn(vp.value_frame(spark, src, "part"), 960.0, 10, None, None, R)


@register("recommendation_rank")
def q_reco_rank(spark, src):
    return RE.recommend_topn(vp.value_frame(spark, src, "orders"), 200000.0, 10, "Mid-range", "3-MEDIUM", R).select(
        "recommendation_rank", "item_id")


@register("outlier_flag_join")
def q_outlier_flag_join(spark, src):
    vf = vp.value_frame(spark, src, "orders")
    saved = vf.filter(F.col("is_value_outlier")).select("item_id")
    return OU.flag_from_outlier_table(vf.select("item_id", "price_eur"), saved, "item_id", "is_value_outlier")


@register("recommend_for_user")
def q_recommend_for_user(spark, src):
    vf = vp.value_frame(spark, src, "part")
    saved = vf.filter(F.col("is_value_outlier")).select("item_id")
    return RE.recommend_for_user(vf.drop("is_value_outlier"), saved, vp.scenario_table(spark, "part"), R)


@register("scenario_join")
def q_scenario_join(spark, src):
    return RE.candidate_counts(vp.segmented_catalog(spark, src, "orders"), vp.scenario_table(spark, "orders"), R)


@register("anchor_cross_join")
def q_anchor(spark, src):
    cat = catalog(spark, src, "orders")
    overall = cat.agg(F.avg("value_score").alias("overall_mean_value_score"))
    return cat.crossJoin(F.broadcast(overall)).select(
        "item_id", F.try_divide(F.col("value_score"), F.col("overall_mean_value_score")).alias("value_vs_overall"))


@register("group_stat_join")
def q_group_stat(spark, src):
    cat = catalog(spark, src, "orders")
    return SG.segment_zscore(cat.withColumnRenamed("brand_group", "segment"), {"price_eur": "price_z_in_brand"}, bounded=False).select(
        "item_id", "price_z_in_brand")


@register("positional_align")
def q_positional_align(spark, src):
    rd = PP.readable(spark, src, "part").select(F.col("item_id").alias("row_id"), "brand_group")
    enc = PP.encoded(spark, src, "part").select("row_id", "target_price_eur")
    return rd.join(enc, "row_id", "inner")


@register("sorted_index_positions")
def q_sorted_positions(spark, src):
    return PO.sorted_positions(catalog(spark, src, "orders"), "price_eur", "item_id")


@register("positional_align_by_place")
def q_align_by_place(spark, src):
    cheap = catalog(spark, src, "orders").select(F.col("item_id").alias("by_price"), F.col("price_eur"))
    spec = catalog(spark, src, "orders").select(F.col("item_id").alias("by_spec"), F.col("spec_score_0_100"))
    return PO.align_by_position(cheap, spec, ["price_eur", "by_price"], ["spec_score_0_100", "by_spec"])


@register("contiguous_folds")
def q_contiguous_folds(spark, src):
    return PO.contiguous_folds(catalog(spark, src, "orders").select("item_id"), ["item_id"])


@register("median_impute")
def q_median_impute(spark, src):
    rd = PP.readable(spark, src, "orders")
    return FE.median_impute(rd, PP.NUMERIC_COLS).select("item_id", *PP.NUMERIC_COLS)


@register("standardize")
def q_standardize(spark, src):
    rd = PP.readable(spark, src, "orders")
    return FE.standardize(rd, PP.NUMERIC_COLS, prefix="z_").select("item_id", *["z_" + c for c in PP.NUMERIC_COLS])


@register("one_hot")
def q_one_hot(spark, src):
    cat = catalog(spark, src, "part").select("item_id", "brand_group", "item_type")
    # vocabulary with an "Other" bucket: one brand is left out on purpose
    brands = [b for b in FE.vocabulary(cat, "brand_group") if b != "Brand#9"] + ["Other"]
    return FE.one_hot(cat, "brand_group", brands, "cat__brand_group_").drop("brand_group", "item_type")


@register("union_all")
def q_union_all(spark, src):
    return PP.importance_by_correlation(spark, src, "part")


# --- models, clustering, isolation, guide (model-based: rows-only checks) -----

from pricewise.operators import cluster as CL  # noqa: E402
from pricewise.operators import gram as GR  # noqa: E402
from pricewise.operators import guide as GD  # noqa: E402
from pricewise.operators import isolation as ISO  # noqa: E402
from pricewise.operators import models as M  # noqa: E402
from pricewise.plans import model_plan as MP  # noqa: E402


@register("fit_linear")
def q_fit_linear(spark, src):
    return MP.holdout_fit_predictions(spark, src, M.LINEAR)


@register("fold_gram")
def q_fold_gram(spark, src):
    enc = MP.encoded(spark, src)
    feats = FE.feature_columns(enc)
    modes = {m: C.log_target("target_price_eur", m) for m in C.TARGET_MODES}
    return GR.fold_gram(enc, feats, modes, F.col("fold")).select("fold", "i", "j", "total")


@register("fit_ridge")
def q_fit_ridge(spark, src):
    return MP.holdout_fit_predictions(spark, src, M.RIDGE)


@register("fit_random_forest")
def q_fit_rf(spark, src):
    return MP.holdout_fit_predictions(spark, src, M.RANDOM_FOREST)  # full parameters


@register("fit_boosted_trees")
def q_fit_gbt(spark, src):
    return MP.holdout_fit_predictions(spark, src, M.BOOSTED)


@register("compare_models")
def q_compare(spark, src):
    return M.compare_models(MP.encoded(spark, src))[1].drop("fit_seconds")


@register("cross_validate")
def q_cross_validate(spark, src):
    return M.cross_validate(MP.encoded(spark, src))[1]


@register("oof_predict")
def q_oof_predict(spark, src):
    return M.oof_predict(MP.encoded(spark, src), MP.SMOKE_RF, "log_price_eur")


@register("stacking_ensemble")
def q_stacking(spark, src):
    return M.stacking_ensemble(MP.encoded(spark, src), M.ENSEMBLE_BASES)[1]


@register("weighted_blend_models")
def q_blend_models(spark, src):
    return M.weighted_blend(MP.encoded(spark, src), M.ENSEMBLE_BASES)[0]


@register("holdout_predictions")
def q_holdout_preds(spark, src):
    enc = MP.encoded(spark, src)
    bases = M.fit_bases(enc, M.ENSEMBLE_BASES)
    return M.holdout_predictions(enc, M.stack_of(bases)[1], M.blend_of(bases)[1])


@register("feature_importance")
def q_feature_importance(spark, src):
    return M.feature_importance(MP.encoded(spark, src))


@register("adjusted_brand_premium")
def q_adjusted_premium(spark, src):
    rd = PP.readable(spark, src, "part").select(F.col("item_id").alias("row_id"), "brand_group")
    return RP.adjusted_brand_summary(M.adjusted_brand_premium(MP.encoded(spark, src), rd))


@register("adjusted_brand_summary")
def q_adjusted_summary(spark, src):
    vf = vp.value_frame(spark, src, "part")
    return RP.adjusted_brand_summary(vf.select("brand_group", F.col("price_eur").alias("actual_price_eur"),
                                               F.col("expected_market_price_eur").alias("spec_only_pred_price_eur")))


@register("kmeans_segments")
def q_kmeans(spark, src):
    return MP.segmented_by_kmeans(spark, src).select("item_id", "cluster", "segment")


@register("k_sweep")
def q_k_sweep(spark, src):
    return CL.k_sweep(catalog(spark, src, "part"), R.segment_features, range(2, 9), n_init=CL.N_INIT)


@register("silhouette")
def q_silhouette(spark, src):
    pred, _, _ = CL.kmeans_segments(catalog(spark, src, "part"), R.segment_features, 3)
    found = CL.silhouette_estimate(pred, [f"z_{c}" for c in R.segment_features])
    return spark.createDataFrame([found], "silhouette double, standard_error double, anchors int")


@register("hierarchical_compare")
def q_hier(spark, src):
    return CL.hierarchical_compare(catalog(spark, src, "part"), R.segment_features, 3)


@register("pca_2d")
def q_pca(spark, src):
    return CL.pca_2d(catalog(spark, src, "part"), R.segment_features)


@register("isolation_outliers")
def q_isolation(spark, src):
    cols = ["value_score", "performance_to_price_ratio", "market_price_discount_ratio", "spec_score_0_100",
            "price_eur", "item_age"]
    z = CL.scaled_features(vp.value_frame(spark, src, "orders").withColumnRenamed("item_id", "row_id"), cols, prefix="iso_")
    return ISO.isolation_outliers(z, [f"iso_{c}" for c in cols])


@register("value_outliers_full")
def q_value_outliers_full(spark, src):
    return MP.full_value_outliers(spark, src, "part").select(
        "item_id", "segment", "market_underpriced_outlier", "zscore_value_outlier", "isolation_raw_outlier",
        "isolation_value_outlier", "is_value_outlier")


@register("price_guide")
def q_price_guide(spark, src):
    return MP.price_guide(spark, src)


# --- S-checked pieces of the guide and the clustering ---------------------------

@register("price_guidance_label")
def q_guidance(spark, src):
    vf = vp.value_frame(spark, src, "orders")
    gap = F.col("price_eur") - F.col("expected_market_price_eur")
    return vf.select("item_id", gap.alias("price_gap_eur"),
                     GD.price_guidance_label(gap, F.col("expected_market_price_eur")).alias("guidance"))


def _brand_tables(spark, src):
    bsum = RP.brand_summary(PP.readable(spark, src, "part"), R)
    vf = vp.value_frame(spark, src, "part")
    adj = RP.adjusted_brand_summary(vf.select("brand_group", F.col("price_eur").alias("actual_price_eur"),
                                              F.col("expected_market_price_eur").alias("spec_only_pred_price_eur")))
    return bsum, adj


@register("brand_note")
def q_brand_note(spark, src):
    req = MP.guide_requests(spark, src).select("request_id", "brand")
    bsum, adj = _brand_tables(spark, src)
    return GD.brand_note(req, bsum, adj).select("request_id", "brand", "brand_premium_note")


@register("unit_flags")
def q_unit_flags(spark, src):
    req = MP.guide_requests(spark, src)
    return C.unit_flags(req, 2026).select("request_id", "has_5g", "has_4g_or_more", "resolution_total_px",
                                          "aspect_ratio", "phone_age")


@register("default_feature_row")
def q_default_row(spark, src):
    req = MP.guide_requests(spark, src).select("request_id", "size", "avg_quantity")
    med = FE.column_medians(catalog(spark, src, "part"), ["size", "avg_quantity"])
    return (req.crossJoin(F.broadcast(med.select(F.col("size").alias("_ms"), F.col("avg_quantity").alias("_mq"))))
            .select("request_id", F.coalesce("size", "_ms").alias("size"), F.coalesce("avg_quantity", "_mq").alias("avg_quantity")))


@register("reference_lookup")
def q_reference_lookup(spark, src):
    req = MP.guide_requests(spark, src).select("request_id", "brand", "size")
    rd = PP.readable(spark, src, "part")
    bsum = RP.brand_summary(rd, R).select(F.col("brand_group").alias("_b"), "avg_is_premium_brand")
    ref = RP.numeric_reference(rd, ["num__size"]).select("mean", "std")
    out = join_small(req, bsum, F.col("brand") == F.col("_b"), "left").crossJoin(F.broadcast(ref))  # ref: one row
    return out.select("request_id", "brand", F.col("avg_is_premium_brand").alias("is_premium_brand"),
                      ((F.col("size") - F.col("mean")) / F.col("std")).alias("num__size"))


@register("phone_key")
def q_phone_key(spark, src):
    return catalog(spark, src, "part").select("item_id", F.concat(F.col("oem").cast("string"), F.lit("||"),
                                                                  F.col("model").cast("string")).alias("phone_key"))


DB_COLS = ["price_eur", "spec_score_0_100", "avg_quantity"]


def _given_cluster_features(spark, src):
    cat = catalog(spark, src, "part").withColumn("cluster", FO.fold_of("item_id", 3))
    return CL.scaled_features(cat, DB_COLS)


@register("davies_bouldin")
def q_davies_bouldin(spark, src):
    return CL.davies_bouldin(_given_cluster_features(spark, src), [f"z_{c}" for c in DB_COLS])


@register("assign_nearest")
def q_assign_nearest(spark, src):
    z = _given_cluster_features(spark, src)
    zc = [f"z_{c}" for c in DB_COLS]
    cents = CL.cluster_centroids(z, zc)
    return CL.assign_nearest(z.drop("cluster"), zc, cents).select("item_id", "cluster")


@register("weighted_blend")
def q_weighted_blend(spark, src):
    preds = _harness_predictions(spark, src).filter(F.col("target_mode") == "price_eur")
    w = M.blend_weights(preds)
    return M.blend_predict(preds, w).crossJoin(F.broadcast(w.agg(F.count(F.lit(1)).alias("n_models"))))


# --- sources and sinks (round trips through the shared scratch folder) ---------

import uuid  # noqa: E402

from pricewise.session import scratch_path  # noqa: E402
from pricewise.sources import sinks as SK  # noqa: E402


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("write_csv")
def q_write_csv(spark, src):
    """Documents with outer spaces added to every text, written and read back."""
    docs = TB.read_table(spark, src, "documents").select("doc_id", "lang", F.concat(F.lit("  "), F.col("text"), F.lit(" ")).alias("text"))
    return TB.read_csv(spark, SK.write_csv(docs, _scratch(spark, "documents_csv")), schema=docs.schema)


@register("write_json")
def q_write_json(spark, src):
    preds = _harness_predictions(spark, src).filter(F.col("target_mode") == "price_eur")
    path = SK.write_json(SK.blend_weights_json(M.blend_weights(preds)), _scratch(spark, "blend_weights_json"))
    return SK.read_json(spark, path)


@register("write_model")
def q_write_model(spark, src):
    enc = MP.encoded(spark, src)
    feats = FE.feature_columns(enc)
    m = M.fit(M.RIDGE, enc.filter(F.col("fold") != 0), feats, "log_price_eur")
    path = SK.write_model(m, _scratch(spark, "model_package"),
                          {"target_mode": "log_price_eur", "model_name": "Ridge", "feature_names": feats})
    loaded, meta = SK.load_model(path)
    return M.predict(loaded, enc.filter(F.col("fold") == 0), meta["target_mode"])


@register("read_csv_fallback")
def q_read_csv_fallback(spark, src):
    docs = TB.read_table(spark, src, "documents").select("doc_id", "lang", "source", "text")
    path = _scratch(spark, "documents_latin1_csv")
    docs.write.mode("overwrite").option("header", "true").option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    return TB.read_csv_fallback(spark, path).withColumn("doc_id", F.col("doc_id").cast("long"))


# --- remaining inventory keys ----------------------------------------------------

register("load_model")(q_write_model)        # save, load back, score: one round trip
register("inverse_log_target")(q_log_target)  # log1p then expm1 back to EUR
register("column_profile")(QUERIES["column_profile_part"])


@register("select_features")
def q_select_features(spark, src):
    enc = PP.encoded(spark, src, "part")
    return enc.select("row_id", *[F.col(f"`{c}`") for c in enc.columns if c.startswith(FE.NUM_PREFIX)])


@register("format_reason")
def q_format_reason(spark, src):
    vf = vp.value_frame(spark, src, "orders")
    return vf.select("item_id", C.format_reason("performance_to_price_ratio", "value_score", "spec_score_0_100",
                                                "market_price_discount_ratio", "avg_quantity", "size")
                     .alias("recommendation_reason"))


def _summary_inputs(spark, src):
    best = ME.best_model(ME.cv_mean_metrics(ME.regression_metrics(_harness_predictions(spark, src))))
    drivers = RP.top_price_drivers(PP.importance_by_correlation(spark, src, "part"), 20)
    vf = vp.value_frame(spark, src, "part")
    return best, drivers, vf


@register("modeling_summary")
def q_modeling_summary(spark, src):
    best, drivers, vf = _summary_inputs(spark, src)
    return RP.modeling_summary(best, drivers, vf, vf, R)


@register("quality_checks")
def q_quality_checks(spark, src):
    folds = ME.regression_metrics(_harness_predictions(spark, src))
    vf = vp.value_frame(spark, src, "part")
    recs = RE.scenario_topn(vf, vp.scenario_table(spark, "part"), R)
    val = RE.recommendation_validation(recs, vp.scenario_table(spark, "part"), R)
    gap = F.col("price_eur") - F.col("expected_market_price_eur")
    guides = vf.select("item_id", GD.price_guidance_label(gap, F.col("expected_market_price_eur")).alias("guidance"))
    return RP.quality_checks(val, ME.cv_mean_metrics(folds), folds, vf, guides, R)
