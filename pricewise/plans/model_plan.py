"""Model-based jobs bound to the test catalogue (rows-only checks).

Registered queries fit with the library's parameters, those of the reference, but for
``oof_predict`` and the market model of ``value_outliers_full``, which take ``SMOKE_RF``.
``SMOKE_MODELS`` keeps each family of ``DEFAULT_MODELS`` with fewer trees, for trial runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators import cluster as CL
from pricewise.operators import guide as GD
from pricewise.operators import isolation as ISO
from pricewise.operators import models as M
from pricewise.operators import reports as RP
from pricewise.operators.common import CATALOG_ROLES as R
from pricewise.operators.features import BRAND_PREFIX, NUM_PREFIX, column_medians, feature_columns
from pricewise.operators.folds import kfold_assign
from pricewise.operators.outliers import value_outliers
from pricewise.operators.segments import assign_segment_labels, percentile_segments
from pricewise.plans import price_plan as PP
from pricewise.session import cut_lineage
from pricewise.sources.catalog import DEFAULT_AS_OF_YEAR, catalog

SMOKE_RF = M.scaled(M.RANDOM_FOREST, numTrees=20, maxDepth=8)
SMOKE_GBT = M.scaled(M.BOOSTED, rounds=20)
SMOKE_MODELS = [M.LINEAR, M.RIDGE, SMOKE_RF, SMOKE_GBT]

def encoded(spark: SparkSession, src: str) -> DataFrame:
    return PP.encoded_with_folds(spark, src, "part")  # already a materialised table


def holdout_fit_predictions(spark, src, spec) -> DataFrame:
    enc = encoded(spark, src)
    feats = feature_columns(enc)
    m = M.fit(spec, enc.filter(F.col("fold") != 0), feats, "log_price_eur")
    return M.predict(m, enc.filter(F.col("fold") == 0), "log_price_eur", keep=("row_id", "target_price_eur"))


def segmented_by_kmeans(spark, src, n_init: int = CL.N_INIT) -> DataFrame:
    cat = catalog(spark, src, "part")
    pred, _, _ = CL.kmeans_segments(cat, R.segment_features, 3, n_init)
    return assign_segment_labels(pred.drop("features"), "cluster", R)


def market_oof(spark, src, kind: str = "part", spec=SMOKE_RF) -> DataFrame:
    """Segmented catalogue with an out-of-fold random-forest expected price."""
    seg = kfold_assign(percentile_segments(catalog(spark, src, kind), "price_eur"), "item_id")
    feats = R.market_features
    from pricewise.operators.features import median_impute
    data = median_impute(seg, feats).withColumnRenamed("item_id", "row_id").withColumn("target", F.col("price_eur"))
    oof = M.oof_predict(data, spec, "price_eur", features=feats, target="target")
    # five fitted pipelines sit in this plan: write the result once
    return cut_lineage(seg.join(oof.select(F.col("row_id").alias("item_id"), F.col("yhat").alias("market_pred")),
                                "item_id", "left"), "market_oof")


def full_value_outliers(spark, src, kind: str = "part") -> DataFrame:
    """Whole flag pipeline: RF market model (OOF) + isolation forest + z-scores."""
    base = market_oof(spark, src, kind)
    tmp = value_outliers(base, "market_pred", R, iso_col=None)
    iso_cols = ["value_score", "performance_to_price_ratio", "market_price_discount_ratio", "spec_score_0_100",
                "price_eur", "item_age"]
    z = CL.scaled_features(tmp.withColumnRenamed("item_id", "row_id"), iso_cols, prefix="iso_")
    # the scaled table ends a long plan; write it to the shared checkpoint folder
    z = cut_lineage(z.select("row_id", *[f"iso_{c}" for c in iso_cols]))
    flags = ISO.isolation_outliers(z, [f"iso_{c}" for c in iso_cols])
    joined = cut_lineage(base.join(flags.select(F.col("row_id").alias("item_id"), "isolation_raw_outlier"),
                                   "item_id", "left"), "value_isolation")
    return cut_lineage(value_outliers(joined, "market_pred", R, iso_col="isolation_raw_outlier"), "value_full")


def guide_requests(spark: SparkSession, src: str, as_of_year: int = DEFAULT_AS_OF_YEAR) -> DataFrame:
    """Planned-product requests derived from the catalogues: one per part brand
    (known brands) and one per order priority (brands the model never saw);
    some fields left empty on purpose."""
    def per_brand(kind):
        cat = catalog(spark, src, kind)
        g = cat.groupBy("brand_group").agg(
            F.min("item_id").alias("request_id"), F.max("price_eur").alias("budget"),
            F.avg("size").alias("size"), F.avg("avg_quantity").alias("avg_quantity"),
            F.min("size").alias("w"), F.max("size").alias("h"), F.max("item_age").alias("age"))
        return g.select(
            (F.col("request_id") * 10 + (1 if kind == "orders" else 0)).alias("request_id"),
            F.col("brand_group").alias("brand"),
            F.when(F.col("request_id") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("budget")).alias("budget_price_eur"),
            F.when(F.col("request_id") % 2 == 0, F.lit(None).cast("double")).otherwise(F.col("size")).alias("size"),
            F.col("avg_quantity"),
            F.floor(F.col("size") / 10).cast("double").alias("network_generation"),
            F.col("w").cast("double").alias("resolution_width_px"),
            F.col("h").cast("double").alias("resolution_height_px"),
            (F.lit(float(as_of_year)) - F.col("age")).alias("launch_year"))
    return per_brand("part").unionByName(per_brand("orders"))


def price_guide(spark: SparkSession, src: str, specs=tuple(M.DEFAULT_MODELS)) -> DataFrame:
    """Fair-price guide of the requests by the winner of the leaderboard, fitted on all rows."""
    enc = encoded(spark, src)
    feats = feature_columns(enc)
    _, mets, models = M.compare_models(enc, specs, refit=True)
    target_mode, model = M.winner(mets, models, enc, specs)
    rd = PP.readable(spark, src, "part")
    ref = RP.numeric_reference(rd, [NUM_PREFIX + c for c in ["is_premium_brand"] + PP.NUMERIC_COLS])
    meds = column_medians(enc, feats)
    bsum = RP.brand_summary(rd, R)
    imp = M.feature_importance(enc, models=models)
    drivers = RP.top_factors_text(RP.top_price_drivers(imp, 20), 5)
    adj = RP.adjusted_brand_summary(M.adjusted_brand_premium(enc, rd.select(F.col("item_id").alias("row_id"), "brand_group")))
    brands = [f[len(BRAND_PREFIX):] for f in feats if f.startswith(BRAND_PREFIX)]
    return GD.price_guide(guide_requests(spark, src), model, target_mode, ref, meds, feats, brands, bsum, adj,
                          drivers, DEFAULT_AS_OF_YEAR)

