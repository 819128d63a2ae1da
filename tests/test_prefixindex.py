"""The price-prefix index against the list of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from pricewise.operators import prefixindex as PI
from pricewise.operators import recommend as RE
from pricewise.operators.common import CATALOG_ROLES as R

ITEMS = "item_id long, price_eur double, segment string, brand_group string, score double"
ORDER = [("score", True), ("price_eur", False), ("item_id", False)]


def _data(seed, n, requests, prices=40):
    rng = random.Random(seed)
    items = [(i, rng.choice([None, *(float(p) for p in range(1, prices))]), rng.choice(["Entry", "Mid-range", None]), rng.choice(["x", "y", "z", None]),
              rng.choice([None, *(float(s) for s in range(6))])) for i in range(n)]
    asked = [(j, f"r{j}", rng.choice([None, 0.5, float(rng.randint(1, prices + 5)), rng.uniform(0, prices)]), rng.choice([None, "Entry", "Mid-range", "Flagship"]),
              rng.choice([None, None, "x", "q"]), rng.choice([None, 0, 1, 3, 12])) for j in range(requests)]
    return items, asked


def brute(items, asked):
    best = sorted((i for i in items if i[1] is not None), key=lambda i: (i[4] is None, -(i[4] or 0), i[1], i[0]))
    out, counts = {}, {}
    for s, _, budget, seg, brand, n in asked:
        ok = [i for i in best if budget is not None and i[1] <= budget and (seg is None or i[2] == seg) and (brand is None or i[3] == brand)]
        for rank, i in enumerate(ok[:10 if n is None else n], 1):
            out[s, rank] = i[0]
        if ok:
            counts[s] = (len(ok), min(i[1] for i in ok), max(i[1] for i in ok))
    return out, counts


@pytest.mark.parametrize("seed,n,rows_per_range", [(1, 300, 20), (2, 900, 7), (3, 300, 1 << 16), (4, 0, 10)])
def test_equals_all_pairs(spark, seed, n, rows_per_range):
    items, asked = _data(seed, n, 60)
    df = spark.createDataFrame(items, ITEMS).repartition(4)
    req = spark.createDataFrame(asked, RE.SCENARIO_SCHEMA)
    want, counts = brute(items, asked)
    got = {(r.scenario, r.recommendation_rank): r.item_id for r in PI.prefix_topn(df, req, ORDER, R, rows_per_range).collect()}
    assert got == want
    assert {r.scenario: (r.candidates, r.min_price, r.max_price) for r in PI.candidate_counts(df, req, R, rows_per_range).collect()} == counts


def test_blocks_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(PI, "BLOCK", 3)
    items, asked = _data(5, 600, 50, prices=200)
    got = PI.prefix_topn(spark.createDataFrame(items, ITEMS), spark.createDataFrame(asked, RE.SCENARIO_SCHEMA), ORDER, R, 15)
    assert {(r.scenario, r.recommendation_rank): r.item_id for r in got.collect()} == brute(items, asked)[0]


def test_one_price_of_most_items(spark):
    items = [(i, 5.0, "Entry", "x", float(i % 7)) for i in range(500)] + [(1000 + i, float(i), "Entry", "x", 9.0) for i in range(20)]
    asked = [(1, "a", 5.0, None, None, 4), (2, "b", 4.9, "Entry", None, 30), (3, "c", 100.0, "Entry", "x", None)]
    got = PI.prefix_topn(spark.createDataFrame(items, ITEMS), spark.createDataFrame(asked, RE.SCENARIO_SCHEMA), ORDER, R, 50)
    assert {(r.scenario, r.recommendation_rank): r.item_id for r in got.collect()} == brute(items, asked)[0]


def test_many_requests(spark):
    """100,001 requests, as many as would no longer be broadcast; none meets every item."""
    items, _ = _data(7, 400, 0, prices=300)
    df = spark.createDataFrame(items, ITEMS)
    req = spark.range(100_001).select(F.col("id").cast("int").alias("scenario"), F.lit("r").alias("scenario_label"), (F.col("id") % 307).cast("double").alias("budget_eur"),
                                      F.when(F.col("id") % 3 == 0, "Entry").alias("segment"), F.lit(None).cast("string").alias("brand"), F.lit(2).alias("top_n"))
    picked = PI.prefix_topn(df, req, ORDER, R, 50)
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    got = {(r.budget, r.seg, r.recommendation_rank): r.item_id for r in
           picked.join(req, "scenario").select(F.col("budget_eur").alias("budget"), F.col("segment").alias("seg"), "recommendation_rank", "item_id").distinct().collect()}
    asked = [(j, "r", float(b), seg, None, 2) for j, (b, seg) in enumerate((b, seg) for b in range(307) for seg in (None, "Entry"))]
    want = {(asked[s][2], asked[s][3], rank): i for (s, rank), i in brute(items, asked)[0].items()}
    assert got == want


def test_requests_without_top_n_and_repeated_numbers(spark):
    items = [(i, float(i), "Entry", "x", 1.0) for i in range(1, 40)]
    req = spark.createDataFrame([(1, "a", 30.0, None, None, None), (1, "b", 20.0, None, None, 5)], RE.SCENARIO_SCHEMA)
    df = spark.createDataFrame(items, ITEMS)
    assert PI.prefix_topn(df, req.limit(1), ORDER, R).count() == RE.DEFAULT_TOP_N
    with pytest.raises(ValueError, match="one request"):
        PI.prefix_topn(df, req, ORDER, R)
