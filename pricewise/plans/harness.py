"""Exact model-free predictors for the evaluation harness.

Two predictors whose fits are aggregates, so the harness (folds, clipping,
inverse transform, metrics) can be checked against plain SQL: the training
median (per fold) and one-feature least squares (per fold). Both are
out-of-fold: fold k is predicted by a fit on the other folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.clean import TARGET_MODES, inverse_log_target, log_target
from pricewise.operators.folds import N_FOLDS, baseline_medians, ols_oof_predict
from pricewise.sources.tables import TARGET_COL


def oof_baseline_predictions(enc: DataFrame, x_col: str, target: str = TARGET_COL, k: int = N_FOLDS) -> DataFrame:
    """Long table (row_id, fold, model, target_mode, y, yhat, baseline)."""
    t = enc.select("row_id", "fold", F.col(target).alias("y"), F.col(x_col).alias("x"), *(log_target(target, m).alias(f"yt_{m}") for m in TARGET_MODES))
    # the medians of both target modes and the baseline in one run
    med = baseline_medians(t, {"baseline": "y", **{f"med_{m}": f"yt_{m}" for m in TARGET_MODES}}, k).withColumnRenamed("k", "fold")
    frames = []
    for mode in TARGET_MODES:
        m = (t.join(F.broadcast(med), "fold", "left")
             .select("row_id", "fold", F.lit("median_baseline").alias("model"), F.lit(mode).alias("target_mode"),
                     "y", inverse_log_target(f"med_{mode}", mode).alias("yhat")))
        o = (ols_oof_predict(t, "x", f"yt_{mode}", k, out="p_t")
             .select("row_id", "fold", F.lit("ols_one_feature").alias("model"), F.lit(mode).alias("target_mode"),
                     "y", inverse_log_target("p_t", mode).alias("yhat")))
        frames += [m, o]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.join(F.broadcast(med.select("fold", "baseline")), "fold", "left")
