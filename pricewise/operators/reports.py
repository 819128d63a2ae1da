"""Group reports: brand, segment, importance and run summaries.

All are grouped aggregates over at most a few columns; groups with a NULL key
are dropped, as pandas ``groupby`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.clean import fixed_text
from pricewise.operators.common import Roles, join_small
from pricewise.operators.features import BRAND_PREFIX, NUM_PREFIX
from pricewise.operators.quantiles import exact_median
from pricewise.operators.segments import SEGMENT_ORDER
from pricewise.sources.tables import quote

TOP_FEATURES = 15
TOP_DRIVERS = 20


def brand_summary(df: DataFrame, roles: Roles = Roles(), premium_col: str = "is_premium_brand") -> DataFrame:
    """By brand: rows, mean and median price, mean premium flag; dearest first."""
    keyed = df.filter(F.col(roles.brand).isNotNull())
    med = exact_median(keyed, roles.price, [roles.brand], "median_price_eur")
    return (keyed.groupBy(roles.brand)
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg(roles.price).alias("avg_price_eur"),
                 F.avg(premium_col).alias("avg_is_premium_brand"))
            .join(med, roles.brand, "left")
            .select(roles.brand, "count", "avg_price_eur", "median_price_eur", "avg_is_premium_brand")
            .orderBy(F.col("avg_price_eur").desc_nulls_last(), roles.brand))


def adjusted_brand_summary(df: DataFrame, brand: str = "brand_group", actual: str = "actual_price_eur",
                           pred: str = "spec_only_pred_price_eur") -> DataFrame:
    """By brand: rows, mean actual, mean spec-only prediction, mean and median
    residual (actual - prediction), and residual over prediction."""
    resid = F.col(actual) - F.col(pred)
    keyed = df.filter(F.col(brand).isNotNull()).withColumn("_r", resid)
    med = exact_median(keyed, "_r", [brand], "median_adjusted_brand_premium_eur")
    return (keyed.groupBy(brand)
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg(actual).alias("avg_actual_price_eur"),
                 F.avg(pred).alias("avg_spec_only_pred_price_eur"),
                 F.avg("_r").alias("avg_adjusted_brand_premium_eur"))
            .join(med, brand, "left")
            .withColumn("premium_ratio_vs_pred", F.try_divide(F.col("avg_adjusted_brand_premium_eur"),
                                                              F.col("avg_spec_only_pred_price_eur")))
            .orderBy(F.col("avg_adjusted_brand_premium_eur").desc_nulls_last(), brand))


def segment_summary(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """By segment: rows, mean and median price, and the mean of each summary
    feature; Entry, Mid-range, Flagship order."""
    seg = roles.segment
    order = F.create_map(*[x for k, v in SEGMENT_ORDER.items() for x in (F.lit(k), F.lit(v))])
    keyed = df.filter(F.col(seg).isNotNull())
    med = exact_median(keyed, roles.price, [seg], "median_price_eur")
    aggs = [F.count(F.lit(1)).alias("count"), F.avg(roles.price).alias("avg_price_eur")]
    aggs += [F.avg(quote(c)).alias(f"avg_{c}") for c in roles.summary_means]
    out = keyed.groupBy(seg).agg(*aggs).join(med, seg, "left")
    out = out.select(seg, "count", "avg_price_eur", "median_price_eur", *[f"avg_{c}" for c in roles.summary_means])
    return out.withColumn("_o", order[F.col(seg)]).orderBy(F.col("_o").asc_nulls_last(), seg).drop("_o")


def numeric_reference(readable: DataFrame, encoded_cols, cols=None) -> DataFrame:
    """Per numeric column that has a ``num__`` twin: mean, population std
    (0 -> 1.0) and median, NULLs skipped. One unpivot, one grouped aggregate."""
    cols = cols or [f.name for f in readable.schema.fields
                    if f.dataType.typeName() in ("double", "float", "integer", "long", "short")]
    cols = [c for c in cols if NUM_PREFIX + c in set(encoded_cols)]
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("raw_feature"),
                               F.col(quote(c)).cast("double").alias("v")) for i, c in enumerate(cols)])
    longv = readable.select(F.inline(pairs))
    sd = F.stddev_pop("v")
    med = exact_median(longv, "v", ["pos", "raw_feature"], "median")
    return (longv.groupBy("pos", "raw_feature")
            .agg(F.avg("v").alias("mean"), sd.alias("_sd"))
            .join(med, ["pos", "raw_feature"], "left")
            .select("pos", "raw_feature", F.concat(F.lit(NUM_PREFIX), F.col("raw_feature")).alias("model_feature"),
                    "mean", F.when(F.col("_sd").isNull() | (F.col("_sd") == 0), 1.0).otherwise(F.col("_sd")).alias("std"),
                    "median")
            .orderBy("pos").drop("pos"))


def distinct_brands(df: DataFrame, brand: str = "brand_group") -> DataFrame:
    return df.select(brand).filter(F.col(brand).isNotNull()).distinct().orderBy(brand)


# --- importance-based reports ------------------------------------------------

def univariate_importance(df: DataFrame, features, label: str, model_name: str) -> DataFrame:
    """Model-free importance: |Pearson correlation| of each feature with the
    label (0 for a constant feature). Long table (model, feature, importance)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"),
                               F.col(quote(c)).cast("double").alias("x")) for i, c in enumerate(features)])
    longv = df.select(F.col(label).cast("double").alias("y"), F.inline(pairs))
    return (longv.groupBy("pos", "feature").agg(F.corr("x", "y").alias("_c"))
            .select(F.lit(model_name).alias("model"), "feature",
                    F.coalesce(F.abs("_c"), F.lit(0.0)).alias("importance")))


def topn_features_per_model(imp: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Top n importances of each model with rank 1..n (ties: feature name)."""
    w = Window.partitionBy("model").orderBy(F.col("importance").desc_nulls_last(), F.col("feature"))
    return imp.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def consensus_factors(imp: DataFrame, n: int = TOP_FEATURES, min_models: int = 2) -> DataFrame:
    """Over each model's top n: mean rank and number of models; keep features
    named by at least ``min_models``; order by mean rank, then name."""
    top = topn_features_per_model(imp, n)
    return (top.groupBy("feature").agg(F.avg("rank").alias("avg_rank"),
                                       F.count_distinct("model").alias("model_count"))
            .filter(F.col("model_count") >= min_models)
            .orderBy("avg_rank", "feature"))


def brand_importance_share(imp: DataFrame, prefix: str = BRAND_PREFIX) -> DataFrame:
    """Per model: summed importance of the brand columns, total, ratio (NULL if 0)."""
    return (imp.groupBy("model")
            .agg(F.coalesce(F.sum(F.when(F.col("feature").startswith(prefix), F.col("importance"))),
                            F.lit(0.0)).alias("brand_importance_sum"),
                 F.sum("importance").alias("total_importance"))
            .withColumn("brand_importance_ratio",
                        F.when(F.col("total_importance") == 0, F.lit(None).cast("double"))
                         .otherwise(F.col("brand_importance_sum") / F.col("total_importance"))))


def prefix_flag(col: str = "feature", prefix: str = BRAND_PREFIX):
    return F.when(F.col(col).startswith(prefix), F.lit("brand")).otherwise(F.lit("hardware_or_spec"))


def top_price_drivers(imp: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """Top n drivers over all models. Importances are first normalised to sum
    to 1 within each model (raw scales differ by orders of magnitude between
    model families), then ranked; ties by model and feature."""
    tot = imp.groupBy("model").agg(F.sum("importance").alias("_t"))
    norm = (join_small(imp, tot, "model", "left", bounded=False)
            .withColumn("share", F.try_divide(F.col("importance"), F.col("_t"))).drop("_t"))
    return (norm.orderBy(F.col("share").desc_nulls_last(), "model", "feature").limit(n)
            .withColumn("driver_type", prefix_flag("feature")))


def top_factors_text(drivers: DataFrame, k: int = 5) -> DataFrame:
    """The first k driver names joined by ", " (one row)."""
    w = Window.orderBy(F.col("share").desc_nulls_last(), "model", "feature")
    top = drivers.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "feature"))),
                                            lambda s: s["feature"]), ", ").alias("top_price_factors"))


# --- run summaries -----------------------------------------------------------

def modeling_summary(best: DataFrame, drivers: DataFrame, segmented: DataFrame, flagged: DataFrame,
                     roles: Roles = Roles()) -> DataFrame:
    """Six key/value rows: best model, its MAE and R2, top 5 drivers, segment
    names, number of value outliers."""
    b = best.select(
        F.concat(F.col("model"), F.lit(" ("), F.col("target_mode"), F.lit(")")).alias("best"),
        fixed_text("MAE", 2).alias("mae"),
        fixed_text("R2", 4).alias("r2"))
    top5 = top_factors_text(drivers, 5)
    segs = (segmented.select(roles.segment).filter(F.col(roles.segment).isNotNull()).distinct()
            .agg(F.array_join(F.array_sort(F.collect_list(roles.segment)), ", ").alias("segments")))
    nout = flagged.agg(F.count_if("is_value_outlier").cast("string").alias("outliers"))
    row = b.crossJoin(top5).crossJoin(segs).crossJoin(nout)
    items = [("best_regression_model", "best"), ("holdout_mae_eur", "mae"), ("holdout_r2", "r2"),
             ("top_price_features", "top_price_factors"), ("market_segments", "segments"),
             ("value_outlier_count", "outliers")]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("pos"), F.lit(k).alias("item"), F.col(c).alias("value"))
        for i, (k, c) in enumerate(items)])))


def quality_checks(validation: DataFrame, cv_means: DataFrame, cv_folds: DataFrame, flagged: DataFrame,
                   guides: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Named PASS/FAIL rules with evidence, one row per rule, from the reports.

    ``cv_folds`` holds the metrics of every fold and model, ``guides`` the price guides
    (column guidance). A rule without data fails. The rule on the project's own content
    folder is replaced by one on the rows read."""
    flag = F.col("is_value_outlier")
    ppr, gap, share = "performance_to_price_ratio", "market_price_gap_eur", "market_price_discount_ratio"
    v = validation.agg(F.bool_and("all_within_budget").alias("budget_ok"),
                       F.bool_and("is_performance_to_price_ratio_descending").alias("ppr_ok"), F.sum("row_count").alias("rows"))
    m = cv_means.agg(F.min("MASE").alias("mase"))
    k = cv_folds.agg(F.count_distinct("fold").alias("folds"), F.count(F.lit(1)).alias("fold_rows"))
    f = flagged.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(roles.segment).alias("nseg"),
        F.avg(F.when(flag, F.col(roles.price))).alias("price_out"), F.avg(F.when(~flag, F.col(roles.price))).alias("price_in"),
        F.avg(F.when(flag, F.col(ppr))).alias("ppr_out"), F.avg(F.when(~flag, F.col(ppr))).alias("ppr_in"),
        F.avg(F.when(flag, F.col(gap))).alias("gap_out"), F.avg(F.when(flag, F.col(share))).alias("share_out"))
    g = guides.agg(F.count("guidance").alias("guides"))
    row = v.crossJoin(m).crossJoin(k).crossJoin(f).crossJoin(g)  # one row each

    def rule(i, name, ok, *evidence):
        text = F.concat(*(F.lit(e) if isinstance(e, str) else e for e in evidence))
        return F.struct(F.lit(i).alias("pos"), F.lit(name).alias("check"),
                        F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"), text.alias("evidence"))

    def number(c):
        return F.col(c).cast("string")

    # The names of the rules.
    return row.select(F.inline(F.array(
        rule(1, "input_rows_read", F.col("n") > 0, "rows=", number("n")),
        # better than the median baseline by more than float noise (the baseline itself scores MASE = 1)
        rule(2, "regression_model_beats_median_baseline", F.col("mase") < 1 - 1e-9, "MASE=", fixed_text("mase", 3)),
        rule(3, "five_fold_cv_available", F.col("folds") == 5, "folds=", number("folds"), ", rows=", number("fold_rows")),
        rule(4, "three_market_segments_created", F.col("nseg") == 3, "segments=", number("nseg")),
        rule(5, "value_outliers_are_cheaper_than_non_outliers", F.col("price_out") < F.col("price_in"),
             "outlier=", fixed_text("price_out", 2), ", non_outlier=", fixed_text("price_in", 2)),
        rule(6, "value_outliers_have_higher_ppr", F.col("ppr_out") > F.col("ppr_in"),
             "outlier=", fixed_text("ppr_out", 3), ", non_outlier=", fixed_text("ppr_in", 3)),
        rule(7, "value_outliers_are_under_expected_market_price", (F.col("gap_out") > 0) & (F.col("share_out") > 0),
             "avg_gap=", fixed_text("gap_out", 2), ", avg_discount=", fixed_text(F.col("share_out") * 100, 1), "%"),
        rule(8, "recommendations_respect_budget", F.col("budget_ok"), "rows=", number("rows")),
        rule(9, "recommendations_sorted_by_ppr", F.col("ppr_ok"), "rows=", number("rows")),
        rule(10, "business_price_guides_created", F.col("guides") > 0, "guides=", number("guides")),
    )))
