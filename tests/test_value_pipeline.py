"""Segments, outlier rules and recommendations on hand-made rows."""

from pyspark.sql import functions as F

from pricewise.operators import outliers as OU
from pricewise.operators import recommend as RE
from pricewise.operators import segments as SG
from pricewise.operators.common import Roles

ROLES = Roles(display_specs=[], ram="spec_score_0_100", camera="spec_score_0_100")
SCHEMA = "item_id long, oem string, model string, brand_group string, price_eur double, spec_score_0_100 double, " \
         "value_score double, price_tier string, segment string"


def _cat(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("value_score", F.lit(100.0) * F.col("spec_score_0_100") / F.col("price_eur"))


def test_zscore_constant_and_null_segment(spark):
    rows = [(1, "o", "m", "b", 100.0, 50.0, None, None, "Entry"), (2, "o", "m", "b", 100.0, 50.0, None, None, "Entry"),
            (3, "o", "m", "b", 100.0, 10.0, None, None, "Flagship"), (4, "o", "m", "b", 200.0, 90.0, None, None, "Flagship"),
            (5, "o", "m", "b", 200.0, 90.0, None, None, None)]
    out = {r["item_id"]: r["z"] for r in SG.segment_zscore(_cat(spark, rows), {"value_score": "z"}).collect()}
    assert out[1] is None and out[2] is None and out[5] is None
    assert abs(out[3] + 1.0) < 1e-12 and abs(out[4] - 1.0) < 1e-12


def test_percentile_segments_and_baselines(spark):
    rows = [(i, "o", "m", "b", float(p), 50.0, None, None, None) for i, p in enumerate([10, 20, 30, 40, 50, 60])]
    seg = SG.percentile_segments(_cat(spark, rows).drop("segment"))
    out = {r["item_id"]: r["segment"] for r in seg.collect()}
    assert [out[i] for i in range(6)] == ["Entry", "Entry", "Mid-range", "Mid-range", "Flagship", "Flagship"]
    base = {r["item_id"]: r for r in SG.segment_baselines(seg, ROLES).collect()}
    assert base[0]["segment_median_price_eur"] == 15.0


def test_recommend_budget_inclusive_ties_and_empty(spark):
    rows = [(1, "o", "a", "b", 100.0, 50.0, None, None, "Entry"), (2, "o", "b", "b", 100.0, 50.0, None, None, "Entry"),
            (3, "o", "c", "b", 101.0, 90.0, None, None, "Entry"), (4, "o", "d", "b", 50.0, 10.0, None, None, "Flagship")]
    cat = _cat(spark, rows)
    top = RE.recommend_topn(cat, 100.0, 10, roles=ROLES).collect()
    assert [r["item_id"] for r in top] == [1, 2, 4]  # 101 is over budget; tie broken by id
    assert [r["recommendation_rank"] for r in top] == [1, 2, 3]
    assert RE.recommend_topn(cat, 10.0, 10, roles=ROLES).count() == 0
    sc = RE.scenarios_frame(spark, [(1, "any", 100.0, None), (2, "none", 10.0, "Entry"), (3, "flag", 60.0, "Flagship", None, 1)])
    recs = RE.scenario_topn(cat, sc, ROLES)
    assert {r["scenario"]: r["n"] for r in recs.groupBy("scenario").agg(F.count("*").alias("n")).collect()} == {1: 3, 3: 1}
    val = {r["scenario"]: r for r in RE.recommendation_validation(recs, sc, ROLES).collect()}
    assert val[2]["row_count"] == 0 and val[2]["all_within_budget"] and val[2]["top_value_score"] is None
    assert val[1]["is_performance_to_price_ratio_descending"] and val[1]["all_within_budget"]


def test_plans_use_partial_topk(spark):
    rows = [(i, "o", "m", "b", float(i), 50.0, None, None, "Entry") for i in range(1, 50)]
    cat = _cat(spark, rows)
    sc = RE.scenarios_frame(spark, [(1, "any", 30.0, None)])
    plan = RE.scenario_topn(cat, sc, ROLES)._jdf.queryExecution().executedPlan().toString()
    # bounded lists before the shuffle, and no request meets every item
    assert "WindowGroupLimit" in plan and "NestedLoopJoin" not in plan and "Cartesian" not in plan
    plan1 = RE.recommend_topn(cat, 30.0, 5, roles=ROLES)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan1


def test_outlier_flags_nan_safe(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "market_price_gap_eur double, market_underpricing_z_in_segment double, "
                               "performance_to_price_ratio double, segment_median_performance_to_price_ratio double, "
                               "value_z_in_segment double")
    r = OU.outlier_predicates(df).first()
    assert r["market_underpriced_outlier"] is False and r["is_value_outlier"] is False


def test_flag_join_never_duplicates(spark):
    cat = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    saved = spark.createDataFrame([(1,), (1,), (3,)], "item_id long")
    out = {r[0]: r[1] for r in OU.flag_from_outlier_table(cat, saved).collect()}
    assert out == {1: True, 2: False, 3: True}
