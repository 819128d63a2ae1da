"""Value-for-money outlier rules and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.clean import clip_min, ppr_ratio
from pricewise.operators.common import Roles, desc_last, join_small
from pricewise.operators.quantiles import quantile_row
from pricewise.operators.segments import segment_baselines, segment_lifts, segment_zscore

# Fixed value: one-sided 95 % normal threshold used by both z-score rules.
Z_THRESHOLD = 1.645
HIGH_VALUE_QUANTILE = 0.75


def market_price_features(df: DataFrame, expected_col: str, roles: Roles = Roles()) -> DataFrame:
    """Expected price (clipped at 1), gap = expected - price, discount = gap / expected."""
    return (df.withColumn("expected_market_price_eur", clip_min(expected_col, 1.0))
              .withColumn("market_price_gap_eur", F.col("expected_market_price_eur") - F.col(roles.price))
              .withColumn("market_price_discount_ratio",
                          F.try_divide(F.col("market_price_gap_eur"), F.col("expected_market_price_eur"))))


def high_value_threshold(df: DataFrame, value_col: str = "value_score", q: float = HIGH_VALUE_QUANTILE,
                         approx: bool = False) -> DataFrame:
    if approx:
        return df.agg(F.percentile_approx(value_col, q, 1_000_000).cast("double").alias("_value_q"))
    return quantile_row(df, value_col, [q], "_qs").select(F.col("_qs")[0].alias("_value_q"))


def high_value_filter(df: DataFrame, value_col: str = "value_score", q: float = HIGH_VALUE_QUANTILE,
                      out: str = "high_value") -> DataFrame:
    """Flag rows whose value score is at least the q-quantile (linear interpolation)."""
    thr = high_value_threshold(df, value_col, q)
    return (df.crossJoin(F.broadcast(thr))
              .withColumn(out, F.coalesce(F.col(value_col) >= F.col("_value_q"), F.lit(False)))
              .drop("_value_q"))


def outlier_predicates(df: DataFrame, roles: Roles = Roles(), iso_col: str | None = None) -> DataFrame:
    """The three rules and their union. NaN/NULL comparisons count as False,
    as they do in pandas."""
    z = Z_THRESHOLD
    out = df.withColumn("market_underpriced_outlier", F.coalesce(
        (F.col("market_price_gap_eur") > 0) & (F.col("market_underpricing_z_in_segment") > z)
        & (F.col("performance_to_price_ratio") >= F.col("segment_median_performance_to_price_ratio")),
        F.lit(False)))
    out = out.withColumn("zscore_value_outlier", F.coalesce(F.col("value_z_in_segment") > z, F.lit(False)))
    if iso_col is None:
        out = (out.withColumn("isolation_raw_outlier", F.lit(False))
                  .withColumn("isolation_value_outlier", F.lit(False)))
    else:
        out = high_value_filter(out, roles.value, out="_high_value")
        out = (out.withColumn("isolation_raw_outlier", F.coalesce(F.col(iso_col), F.lit(False)))
                  .withColumn("isolation_value_outlier", F.col("isolation_raw_outlier") & F.col("_high_value"))
                  .drop("_high_value"))
    return out.withColumn("is_value_outlier", F.col("zscore_value_outlier") | F.col("isolation_value_outlier")
                          | F.col("market_underpriced_outlier"))


def value_outliers(df: DataFrame, expected_col: str, roles: Roles = Roles(), iso_col: str | None = None,
                   approx: bool = False) -> DataFrame:
    """Whole flag pipeline on a segmented catalogue. ``expected_col`` holds an
    out-of-fold expected price; ``iso_col`` an isolation-forest flag (or None)."""
    out = df.withColumn("performance_to_price_ratio", ppr_ratio(roles.spec, roles.price))
    out = segment_baselines(out, roles, approx=approx)
    out = segment_lifts(out, roles)
    out = market_price_features(out, expected_col, roles)
    out = segment_zscore(out, {"market_price_discount_ratio": "market_underpricing_z_in_segment",
                               roles.value: "value_z_in_segment"}, roles.segment)
    return outlier_predicates(out, roles, iso_col)


def outlier_method_counts(df: DataFrame) -> DataFrame:
    """Rows flagged per method. "Intersection" is z-score AND isolation, as the
    reference counts it; the three-way intersection is added as its own row."""
    z, iso, mkt = F.col("zscore_value_outlier"), F.col("isolation_value_outlier"), F.col("market_underpriced_outlier")
    counts = df.agg(
        F.count_if(z).alias("c1"), F.count_if(iso).alias("c2"), F.count_if(mkt).alias("c3"),
        F.count_if(z & iso).alias("c4"), F.count_if(z & iso & mkt).alias("c5"),
        F.count_if(F.col("is_value_outlier")).alias("c6"))
    names = ["Z-score within segment", "IsolationForest + high value_score",
             "Market expected-price underpricing Z-score", "Intersection", "Intersection(all three)", "Union(final)"]
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("method_order"), F.lit(n).alias("method"), F.col(f"c{i + 1}").alias("count"))
        for i, n in enumerate(names)])))


def outlier_validation(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return (df.groupBy("is_value_outlier").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(roles.price).alias("avg_price_eur"),
        F.avg(roles.value).alias("avg_value_score"),
        F.avg("performance_to_price_ratio").alias("avg_performance_to_price_ratio"),
        F.avg("value_score_lift_vs_segment").alias("avg_value_lift_vs_segment"),
        F.avg("price_discount_vs_segment_median").alias("avg_price_discount_vs_segment_median"),
        F.avg("expected_market_price_eur").alias("avg_expected_market_price_eur"),
        F.avg("market_price_gap_eur").alias("avg_market_price_gap_eur"),
        F.avg("market_price_discount_ratio").alias("avg_market_price_discount_ratio")))


def outlier_by_segment(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return (df.filter(F.col(roles.segment).isNotNull()).groupBy(roles.segment)
            .agg(F.count_if("is_value_outlier").alias("sum"), F.count(F.lit(1)).alias("count"))
            .withColumn("outlier_ratio", F.col("sum") / F.col("count")))


def rank_value_outliers(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Flagged rows, best deal first (PPR, market discount, value score; id last)."""
    return (df.filter(F.col("is_value_outlier"))
            .orderBy(desc_last("performance_to_price_ratio"), desc_last("market_price_discount_ratio"),
                     desc_last(roles.value), F.col(roles.item_id).asc()))


def flag_from_outlier_table(df: DataFrame, outliers: DataFrame, key: str = "item_id",
                            out: str = "is_value_outlier") -> DataFrame:
    """Mark rows whose key occurs in ``outliers`` (existence; never duplicates
    rows). The outlier table may be large, so no broadcast is forced."""
    keys = outliers.select(key).distinct().withColumn("_hit", F.lit(True))
    return (df.drop(out).join(keys, key, "left")
              .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))
