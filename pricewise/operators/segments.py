"""Segment labelling and per-segment statistics.

Segments are few (three), so a window partitioned by segment would put a
third of the table in each of three tasks. Instead every per-segment
statistic is a grouped aggregate (partial aggregation before the shuffle,
tiny result) broadcast back: one small exchange, no skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.clean import ppr_ratio
from pricewise.operators.common import Roles, join_small
from pricewise.operators.quantiles import column_medians_exact, quantile_row

# Segment names, ordered from cheapest to dearest.
SEGMENT_LABELS = ["Entry", "Mid-range", "Flagship"]
SEGMENT_ORDER = {"Entry": 0, "Mid-range": 1, "Flagship": 2}


def percentile_segments(df: DataFrame, price_col: str = "price_eur", out: str = "segment",
                        labels=SEGMENT_LABELS, approx: bool = False) -> DataFrame:
    """Cut the price at the 1/3 and 2/3 percentiles (linear interpolation):
    <= p33 Entry, <= p67 Mid-range, above Flagship; NULL price -> NULL.
    ``approx=True`` uses ``percentile_approx`` for unbounded distinct prices."""
    n = len(labels)
    qs = [i / n for i in range(1, n)]
    if approx:
        cut_row = df.agg(F.percentile_approx(price_col, qs, 1_000_000).alias("_cuts"))
    else:
        cut_row = quantile_row(df, price_col, qs, "_cuts")
    out_df = df.crossJoin(F.broadcast(cut_row))
    expr = F.when(F.col(price_col).isNull(), F.lit(None).cast("string"))
    for i, label in enumerate(labels[:-1]):
        expr = expr.when(F.col(price_col) <= F.col("_cuts")[i], label)
    expr = expr.otherwise(labels[-1])
    return out_df.withColumn(out, expr).drop("_cuts")


def label_map(labels=SEGMENT_LABELS, key: str = "rank", out: str = "segment"):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(i + 1, l) for i, l in enumerate(labels)], f"{key} int, {out} string")


def cluster_order(df: DataFrame, cluster_col: str = "cluster", price_col: str = "price_eur",
                  spec_col: str = "spec_score_0_100", labels=SEGMENT_LABELS) -> DataFrame:
    """Per cluster: mean price and mean spec; ranked by both ascending and named
    Entry / Mid-range / Flagship. k rows."""
    stats = (df.filter(F.col(cluster_col).isNotNull()).groupBy(cluster_col)
             .agg(F.avg(price_col).alias("avg_price_eur"), F.avg(spec_col).alias("avg_spec_score_0_100")))
    w = Window.orderBy(F.col("avg_price_eur").asc_nulls_last(), F.col("avg_spec_score_0_100").asc_nulls_last(),
                       F.col(cluster_col))
    ranked = stats.withColumn("rank", F.row_number().over(w))  # k rows: a single task is fine
    names = F.array(*[F.lit(l) for l in labels])
    return ranked.withColumn("segment", F.when(F.col("rank") <= len(labels), names[F.col("rank") - 1]))


def assign_segment_labels(df: DataFrame, cluster_col: str = "cluster", roles: Roles = Roles(),
                          labels=SEGMENT_LABELS) -> DataFrame:
    order = cluster_order(df, cluster_col, roles.price, roles.spec, labels).select(cluster_col, "segment")
    return join_small(df.drop("segment"), order, cluster_col, "left", bounded=True)


def segment_baselines(df: DataFrame, roles: Roles = Roles(), approx: bool = False) -> DataFrame:
    """Adds segment mean value score, segment median price and segment median PPR
    to every row (NULL for rows without a segment)."""
    seg = roles.segment
    if "performance_to_price_ratio" not in df.columns:
        df = df.withColumn("performance_to_price_ratio", ppr_ratio(roles.spec, roles.price))
    keyed = df.filter(F.col(seg).isNotNull())
    means = keyed.groupBy(seg).agg(F.avg(roles.value).alias("segment_mean_value_score"))
    if approx:
        meds = keyed.groupBy(seg).agg(
            F.percentile_approx(roles.price, 0.5, 100000).cast("double").alias("segment_median_price_eur"),
            F.percentile_approx("performance_to_price_ratio", 0.5, 100000).cast("double")
             .alias("segment_median_performance_to_price_ratio"))
    else:
        meds = column_medians_exact(keyed, [roles.price, "performance_to_price_ratio"], [seg]).select(
            seg, F.col(roles.price).alias("segment_median_price_eur"),
            F.col("performance_to_price_ratio").alias("segment_median_performance_to_price_ratio"))
    stats = means.join(meds, seg, "left")
    return join_small(df, stats, seg, "left", bounded=True)


def segment_lifts(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return (df.withColumn("value_score_lift_vs_segment",
                          F.try_divide(F.col(roles.value), F.col("segment_mean_value_score")))
              .withColumn("price_discount_vs_segment_median",
                          F.try_divide(F.col("segment_median_price_eur") - F.col(roles.price),
                                       F.col("segment_median_price_eur"))))


def segment_zscore(df: DataFrame, cols: dict, segment_col: str = "segment", bounded: bool = True) -> DataFrame:
    """``cols`` maps input column -> output column. z = (x - mean) / std_pop within
    the segment; a constant segment (std 0) and NULL segments give NULL. ``bounded`` says
    that there are few segments; groups of any number are joined after a size check."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"_m{i}"), F.stddev_pop(c).alias(f"_s{i}")]
    stats = df.filter(F.col(segment_col).isNotNull()).groupBy(segment_col).agg(*aggs)
    out = join_small(df, stats, segment_col, "left", bounded=bounded)
    for i, (c, name) in enumerate(cols.items()):
        out = out.withColumn(name, F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_s{i}")))
    return out.drop(*[f"_{p}{i}" for i in range(len(cols)) for p in "ms"])


def topn_brands_per_segment(df: DataFrame, n: int = 3, roles: Roles = Roles()) -> DataFrame:
    """Per segment, the ``n`` brands with most rows (ties: brand name)."""
    counts = (df.filter(F.col(roles.segment).isNotNull() & F.col(roles.brand).isNotNull())
              .groupBy(roles.segment, roles.brand).agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy(roles.segment).orderBy(F.col("count").desc(), F.col(roles.brand).asc())
    return (counts.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= n).drop("_rank"))
