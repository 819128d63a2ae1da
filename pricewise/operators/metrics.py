"""Regression metrics over a long prediction table, all groups in one job.

Predictions are rows (row_id, fold, model, target_mode, y, yhat[, baseline]).
Every metric is a sum, so one grouped aggregate (partial aggregation before
the shuffle) computes MAE, RMSE, sMAPE, MASE and R2 for every (model, mode,
fold) at once, however many rows each group holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.clean import clip_min

GROUP = ["target_mode", "model", "fold"]


def regression_metrics(pred: DataFrame, group=GROUP, y: str = "y", yhat: str = "yhat",
                       baseline: str = "baseline") -> DataFrame:
    """MAE, RMSE, sMAPE (x100; 0 where |y|+|yhat| = 0), MASE against the
    baseline prediction (NULL when the baseline MAE is 0) and R2. Predictions
    are clipped at 1 first, as the reference does."""
    p = clip_min(yhat, 1.0)
    yy = F.col(y)
    err = F.abs(yy - p)
    denom = F.abs(yy) + F.abs(p)
    sm = F.when(denom == 0, F.lit(0.0)).otherwise(F.lit(2.0) * err / denom)
    agg = pred.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        (F.avg(sm) * F.lit(100.0)).alias("sMAPE"),
        F.avg(F.abs(yy - F.col(baseline))).alias("_base_mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(yy) * F.count(F.lit(1))).alias("_sst"))
    return agg.select(
        *group, "n", "MAE", "RMSE", "sMAPE",
        F.when(F.col("_base_mae") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("MAE") / F.col("_base_mae")).alias("MASE"),
        F.when(F.col("_sst") == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("R2"))


def cv_mean_metrics(fold_metrics: DataFrame, group=("target_mode", "model")) -> DataFrame:
    """Mean of the fold metrics per (target mode, model)."""
    return (fold_metrics.groupBy(*group)
            .agg(*[F.avg(m).alias(m) for m in ["MAE", "RMSE", "sMAPE", "MASE", "R2"]]))


def model_leaderboard(metrics: DataFrame) -> DataFrame:
    """Sorted by MAE then RMSE; the first row is the chosen model."""
    return metrics.orderBy(F.col("MAE").asc_nulls_last(), F.col("RMSE").asc_nulls_last(),
                           F.col("model"), F.col("target_mode"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The winning row as a one-row DataFrame (``min_by`` - no global sort)."""
    key = F.struct(F.col("MAE"), F.col("RMSE"), F.col("model"), F.col("target_mode"))
    cols = [c for c in metrics.columns]
    return metrics.agg(F.min_by(F.struct(*cols), key).alias("b")).select("b.*")
