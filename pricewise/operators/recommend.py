"""Budget recommendations: single request, batched scenarios, and their checks.

A batch of requests is a scenario table (budget, optional segment / brand, rows wanted).
All requests are answered from one price-prefix index (see prefixindex): no request is
paired with the items it may get, so neither the number of requests nor a scenario that
matches a third of the catalogue is a limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.clean import format_reason, ppr_ratio
from pricewise.operators.common import Roles, asc_last, desc_last, join_small
from pricewise.operators.prefixindex import DEFAULT_TOP_N, ROWS_PER_RANGE, candidate_counts, prefix_topn  # noqa: F401

# The four preset scenarios (budget in EUR, segment or None).
PRESET_SCENARIOS = [
    (1, "student", 200.0, None),
    (2, "office_worker", 400.0, "Mid-range"),
    (3, "premium_user", 800.0, "Flagship"),
    (4, "entry_second_phone", 150.0, "Entry"),
]

SCENARIO_SCHEMA = "scenario int, scenario_label string, budget_eur double, segment string, brand string, top_n int"


def scenarios_frame(spark, rows) -> DataFrame:
    """Rows of (scenario, label, budget, segment[, brand[, top_n]])."""
    full = []
    for r in rows:
        r = list(r) + [None] * (6 - len(r))
        if r[5] is None:
            r[5] = DEFAULT_TOP_N
        full.append(tuple(r))
    return spark.createDataFrame(full, SCENARIO_SCHEMA)


def _sort_keys(roles: Roles):
    return [desc_last("performance_to_price_ratio"), desc_last(roles.value),
            desc_last("is_value_outlier"), desc_last(roles.spec), asc_last(roles.price),
            F.col(roles.item_id).asc()]


def reco_columns(roles: Roles = Roles()) -> list[str]:
    return (["recommendation_rank", roles.oem, roles.model, roles.brand, roles.price, "budget_utilization",
             roles.tier, roles.segment, roles.spec, roles.value, "performance_to_price_ratio",
             "market_price_discount_ratio", "expected_market_price_eur", "market_underpriced_outlier",
             "is_value_outlier"] + list(roles.display_specs) + ["recommendation_reason"])


def _reason(roles: Roles, df: DataFrame):
    disc = "market_price_discount_ratio" if "market_price_discount_ratio" in df.columns else None
    return format_reason("performance_to_price_ratio", roles.value, roles.spec, disc, roles.ram, roles.camera)


def recommend_topn(df: DataFrame, budget: float, top_n: int = DEFAULT_TOP_N, segment: str | None = None,
                   brand: str | None = None, roles: Roles = Roles(), keep_id: bool = True) -> DataFrame:
    """Top-N by PPR under one budget: filter, rank, keep N (``TakeOrderedAndProject``),
    then format the reason for the kept rows only."""
    cand = df.filter(F.col(roles.price) <= F.lit(float(budget)))
    if segment:
        cand = cand.filter(F.col(roles.segment) == segment)
    if brand:
        cand = cand.filter(F.col(roles.brand) == brand)
    cand = (cand.withColumn("performance_to_price_ratio", ppr_ratio(roles.spec, roles.price))
                .withColumn("budget_utilization", F.col(roles.price) / F.lit(float(budget))))
    for c in ["market_price_discount_ratio", "expected_market_price_eur"]:
        if c not in cand.columns:
            cand = cand.withColumn(c, F.lit(None).cast("double"))
    for c in ["market_underpriced_outlier", "is_value_outlier"]:
        if c not in cand.columns:
            cand = cand.withColumn(c, F.lit(False))
    w = Window.orderBy(*_sort_keys(roles))
    top = cand.orderBy(*_sort_keys(roles)).limit(int(top_n))
    # row_number over an already limited (N-row) input: a single small task.
    ranked = top.withColumn("recommendation_rank", F.row_number().over(w))
    ranked = ranked.withColumn("recommendation_reason", _reason(roles, ranked))
    cols = reco_columns(roles) + ([roles.item_id] if keep_id else [])
    return ranked.select(*cols)


def scenario_join(catalog: DataFrame, scenarios: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Every (scenario, item) pair with price <= budget and matching optional segment /
    brand: the listing itself, as long as all pairs. Counts and best items come from
    ``candidate_counts`` and ``scenario_topn`` without it."""
    s = scenarios.withColumnRenamed("segment", "_want_segment").withColumnRenamed("brand", "_want_brand")
    cond = ((F.col(roles.price) <= F.col("budget_eur"))
            & (F.col("_want_segment").isNull() | (F.col(roles.segment) == F.col("_want_segment")))
            & (F.col("_want_brand").isNull() | (F.col(roles.brand) == F.col("_want_brand"))))
    return join_small(catalog, s, cond, "inner")


def scenario_topn(catalog: DataFrame, scenarios: DataFrame, roles: Roles = Roles(), keep_id: bool = True,
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Top-N per scenario for a whole batch of requests, from a price-prefix index. A
    request without ``top_n`` gets DEFAULT_TOP_N rows; two requests under one scenario
    number are refused."""
    cand = catalog
    for c in ["market_price_discount_ratio", "expected_market_price_eur"]:
        if c not in cand.columns:
            cand = cand.withColumn(c, F.lit(None).cast("double"))
    for c in ["market_underpriced_outlier", "is_value_outlier"]:
        if c not in cand.columns:
            cand = cand.withColumn(c, F.lit(False))
    cand = cand.withColumn("performance_to_price_ratio", ppr_ratio(roles.spec, roles.price))
    order = [("performance_to_price_ratio", True), (roles.value, True), ("is_value_outlier", True),
             (roles.spec, True), (roles.price, False), (roles.item_id, False)]
    picked = prefix_topn(cand, scenarios, order, roles, rows_per_range)
    wanted = scenarios.select("scenario", "scenario_label", "budget_eur")
    ranked = (cand.join(picked, roles.item_id).join(wanted, "scenario")
              .withColumn("budget_utilization", F.col(roles.price) / F.col("budget_eur")))
    ranked = ranked.withColumn("recommendation_reason", _reason(roles, ranked))
    cols = ["scenario", "scenario_label", "budget_eur"] + reco_columns(roles) + ([roles.item_id] if keep_id else [])
    return ranked.select(*cols)


def recommendation_validation(recs: DataFrame, scenarios: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Per scenario: rows, max price, all within budget, value score and PPR
    non-increasing along the rank (ties allowed), top value and PPR. A scenario
    without rows reports 0 rows, True checks and NULL values."""
    w = Window.partitionBy("scenario").orderBy("recommendation_rank")
    steps = (recs.select("scenario", "recommendation_rank", roles.price, roles.value, "performance_to_price_ratio")
             .withColumn("_pv", F.lag(roles.value).over(w))
             .withColumn("_pp", F.lag("performance_to_price_ratio").over(w)))
    first = F.col("recommendation_rank") == 1
    per = steps.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(roles.price).alias("max_price_eur"),
        F.bool_and(F.when(first, F.lit(True)).otherwise(F.coalesce(F.col("_pv") >= F.col(roles.value), F.lit(False)))).alias("is_value_score_descending"),
        F.bool_and(F.when(first, F.lit(True)).otherwise(F.coalesce(F.col("_pp") >= F.col("performance_to_price_ratio"), F.lit(False)))).alias("is_performance_to_price_ratio_descending"),
        F.max_by(roles.value, F.when(first, 1).otherwise(0)).alias("top_value_score"),
        F.max_by("performance_to_price_ratio", F.when(first, 1).otherwise(0)).alias("top_performance_to_price_ratio"),
    )
    s = scenarios.select("scenario", "scenario_label", "budget_eur")
    out = s.join(per, "scenario", "left")
    return out.select(
        "scenario", "scenario_label", "budget_eur",
        F.coalesce(F.col("row_count"), F.lit(0)).alias("row_count"),
        "max_price_eur",
        F.coalesce(F.col("max_price_eur") <= F.col("budget_eur"), F.lit(True)).alias("all_within_budget"),
        F.coalesce(F.col("is_value_score_descending"), F.lit(True)).alias("is_value_score_descending"),
        F.coalesce(F.col("is_performance_to_price_ratio_descending"), F.lit(True)).alias("is_performance_to_price_ratio_descending"),
        "top_value_score", "top_performance_to_price_ratio")


def recommendation_lift(recs: DataFrame, catalog: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Mean value score and PPR of each scenario's picks over the catalogue means."""
    per = (recs.groupBy("scenario", "scenario_label")
           .agg(F.avg(roles.value).alias("recommendation_mean_value_score"),
                F.avg("performance_to_price_ratio").alias("recommendation_mean_performance_to_price_ratio")))
    overall = (catalog.withColumn("_ppr", ppr_ratio(roles.spec, roles.price))
               .agg(F.avg(roles.value).alias("overall_mean_value_score"),
                    F.avg("_ppr").alias("overall_mean_performance_to_price_ratio")))
    return (per.crossJoin(F.broadcast(overall))
            .withColumn("lift_vs_overall", F.try_divide(F.col("recommendation_mean_value_score"),
                                                        F.col("overall_mean_value_score")))
            .withColumn("ppr_lift_vs_overall", F.try_divide(F.col("recommendation_mean_performance_to_price_ratio"),
                                                            F.col("overall_mean_performance_to_price_ratio"))))


def recommend_for_user(segmented: DataFrame, outliers: DataFrame, scenarios: DataFrame,
                       roles: Roles = Roles()) -> DataFrame:
    """Serving-side recommendations on a saved segmented catalogue: the value
    flag comes from the saved outlier table (existence join on the item id)."""
    from pricewise.operators.outliers import flag_from_outlier_table
    flagged = flag_from_outlier_table(segmented, outliers, roles.item_id)
    return scenario_topn(flagged, scenarios, roles)
