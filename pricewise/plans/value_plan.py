"""Minimum slice: "top value items for each budget scenario", end to end.

catalogue -> percentile segments -> fold column -> out-of-fold expected price
(one-feature least squares) -> per-segment baselines, lifts and z-scores ->
outlier flags -> batched scenario top-N -> per-scenario validation.
Everything is relational, so each step has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewise.operators.common import CATALOG_ROLES, Roles
from pricewise.operators.folds import kfold_assign, ols_oof_predict
from pricewise.operators.outliers import value_outliers
from pricewise.operators.recommend import recommendation_validation, scenario_topn, scenarios_frame
from pricewise.operators.segments import percentile_segments
from pricewise.session import cut_lineage
from pricewise.sources.catalog import catalog_table

# Scenario presets for the two test catalogues. Part prices run
# 900-1000, order totals 1,000-500,000, so the reference's budgets are
# rescaled; the last row of each is a deliberately empty request.
PART_SCENARIOS = [
    (1, "student", 960.0, None),
    (2, "office_worker", 950.0, "Mid-range"),
    (3, "premium_user", 990.0, "Flagship"),
    (4, "entry_second_phone", 920.0, "Entry"),
    (5, "no_match", 950.0, "Flagship"),
]
ORDER_SCENARIOS = [
    (1, "student", 100000.0, None),
    (2, "office_worker", 200000.0, "Mid-range"),
    (3, "premium_user", 450000.0, "Flagship"),
    (4, "entry_second_phone", 60000.0, "Entry"),
    (5, "no_match", 50000.0, "Flagship"),
    (6, "long_list", 200000.0, None, None, 25),
]
SCENARIOS = {"part": PART_SCENARIOS, "orders": ORDER_SCENARIOS}


def segmented_catalog(spark: SparkSession, source: str, kind: str = "part", approx: bool = False) -> DataFrame:
    return percentile_segments(catalog_table(spark, source, kind), "price_eur", approx=approx)


def value_frame(spark: SparkSession, source: str, kind: str = "part", roles: Roles = CATALOG_ROLES,
                approx: bool = False) -> DataFrame:
    """Segmented catalogue with every value column and outlier flag."""
    seg = kfold_assign(segmented_catalog(spark, source, kind, approx), roles.item_id)
    pred = ols_oof_predict(seg, roles.spec, roles.price, out="market_pred")
    # the flagged frame feeds several reports and the recommendations: write it once
    return cut_lineage(value_outliers(pred, "market_pred", roles, iso_col=None, approx=approx))


def scenario_table(spark: SparkSession, kind: str = "part") -> DataFrame:
    return scenarios_frame(spark, SCENARIOS[kind])


def value_recommendations(spark: SparkSession, source: str, kind: str = "part",
                          roles: Roles = CATALOG_ROLES) -> DataFrame:
    return scenario_topn(value_frame(spark, source, kind, roles), scenario_table(spark, kind), roles)


def value_validation(spark: SparkSession, source: str, kind: str = "part", roles: Roles = CATALOG_ROLES) -> DataFrame:
    recs = value_recommendations(spark, source, kind, roles=roles)
    return recommendation_validation(recs, scenario_table(spark, kind), roles)
