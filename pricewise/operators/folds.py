"""Deterministic fold assignment and fold-wise baselines.

A fold is a hash of the row id, so it needs no shuffle, no global row order
and no driver state, and the same value comes out of any SQL engine that has
``md5``: first 8 hex digits of md5(id) as an integer, modulo k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_FOLDS = 5
HOLDOUT_FOLD = 0


def fold_of(id_col: str, k: int = N_FOLDS) -> Column:
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(k)).cast("int")


def kfold_assign(df: DataFrame, id_col: str = "row_id", k: int = N_FOLDS, out: str = "fold") -> DataFrame:
    return df.withColumn(out, fold_of(id_col, k))


def holdout_split(df: DataFrame, id_col: str = "row_id", k: int = N_FOLDS,
                  test_fold: int = HOLDOUT_FOLD) -> tuple[DataFrame, DataFrame]:
    """80/20 split (k=5): fold ``test_fold`` is the holdout."""
    f = fold_of(id_col, k)
    return df.filter(f != test_fold), df.filter(f == test_fold)


def fold_ids(spark, k: int = N_FOLDS) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("k"))


def baseline_medians(df: DataFrame, columns: dict, k: int = N_FOLDS, fold_col: str = "fold") -> DataFrame:
    """(k, one column per entry of ``columns``): for each fold the median of every column over
    the training rows (fold != k); ``columns`` maps output names to input columns.

    Rows are counted by (column, fold, value) once; only these counts are dealt to the folds
    that train on them, and one quantile run serves all columns and folds."""
    names = list(columns)
    values = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(columns[n]).cast("double").alias("_y")) for i, n in enumerate(names)])
    counts = df.select(F.col(fold_col).alias("_f"), F.inline(values)).groupBy("_f", "_c", "_y").agg(F.count(F.lit(1)).alias("_n"))
    train = counts.join(F.broadcast(fold_ids(df.sparkSession, k)), F.col("_f") != F.col("k")).groupBy("k", "_c", "_y").agg(F.sum("_n").alias("_n"))
    from pricewise.operators.quantiles import exact_quantiles
    found = exact_quantiles(train, "_y", [0.5], ["k", "_c"], weight="_n")
    return found.groupBy("k").agg(*[F.first(F.when(F.col("_c") == i, F.col("value")), ignorenulls=True).alias(n) for i, n in enumerate(names)])


def baseline_median(df: DataFrame, y_col: str, k: int = N_FOLDS, fold_col: str = "fold") -> DataFrame:
    """Per fold k: median of y over the training rows (fold != k). One row per fold."""
    return baseline_medians(df, {"baseline": y_col}, k, fold_col)


def ols_oof_predict(df: DataFrame, x_col: str, y_col: str, k: int = N_FOLDS,
                    fold_col: str = "fold", out: str = "oof_pred") -> DataFrame:
    """Out-of-fold one-feature least squares: the fit for fold k uses every
    other fold. Sufficient statistics are additive, so one grouped aggregate
    gives per-fold sums and the training sums are total minus fold; the k-row
    coefficient table is broadcast back. No row is ever copied."""
    valid = F.col(x_col).isNotNull() & F.col(y_col).isNotNull()
    x, y = F.col(x_col).cast("double"), F.col(y_col).cast("double")
    per_fold = (df.groupBy(fold_col).agg(
        F.count(F.when(valid, 1)).cast("double").alias("n"),
        F.sum(F.when(valid, x)).alias("sx"), F.sum(F.when(valid, y)).alias("sy"),
        F.sum(F.when(valid, x * x)).alias("sxx"), F.sum(F.when(valid, x * y)).alias("sxy")))
    ks = fold_ids(df.sparkSession, k)
    train = (ks.join(per_fold, F.col(fold_col) != F.col("k"), "left")
             .groupBy("k").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ["n", "sx", "sy", "sxx", "sxy"]]))
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
                         F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    coef = train.select(F.col("k").alias(fold_col), slope.alias("_slope"),
                        F.col("sy").alias("_sy"), F.col("sx").alias("_sx"), F.col("n").alias("_n"))
    coef = coef.withColumn("_icpt", F.try_divide(F.col("_sy") - F.col("_slope") * F.col("_sx"), F.col("_n")))
    return (df.join(F.broadcast(coef.select(fold_col, "_slope", "_icpt")), fold_col, "left")
            .withColumn(out, F.col("_icpt") + F.col("_slope") * x)
            .drop("_slope", "_icpt"))
