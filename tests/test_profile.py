"""Profiling operators on small hand-made frames."""

from pricewise.operators import profile as P


def test_column_profile_counts(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, "x"), (None, 2.0, "y"), ("b", 2.0, "y")],
                               "oem string, `battery_stand.by` double, model string")
    prof = {r["column"]: r for r in P.column_profile(df).collect()}
    assert prof["oem"]["missing"] == 1 and prof["oem"]["unique"] == 2
    assert abs(prof["oem"]["unique_ratio_non_missing"] - 2 / 3) < 1e-12
    assert prof["battery_stand.by"]["missing"] == 1 and prof["battery_stand.by"]["unique"] == 2
    assert prof["model"]["missing_ratio"] == 0.25
    assert prof["oem"]["dtype"] == "string"
    approx = {r["column"]: r for r in P.column_profile(df, approx=True).collect()}
    assert approx["oem"]["unique"] == 2


def test_all_missing_column_ratio_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    r = P.column_profile(df).first()
    assert r["missing"] == 2 and r["unique"] == 0 and r["unique_ratio_non_missing"] == 0.0


def test_duplicate_group_sizes(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", "y"), ("B", None), ("B", "z")], "oem string, model string")
    out = {r[0]: r[1] for r in P.duplicate_group_sizes(df, ["oem", "model"]).collect()}
    assert out == {1: 2, 2: 1}


def test_top_k_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    out = [(r["value"], r["count"], r["rank"]) for r in P.top_k_values(df, ["v"], 2).orderBy("rank").collect()]
    assert out == [("c", 2, 1), ("a", 1, 2)]


def test_histogram_constant_and_edges(spark):
    import numpy as np
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    h = P.histogram(df, "x", 4).collect()
    assert sum(r["count"] for r in h) == 2 and h[0]["bin_left"] == 4.5 and h[-1]["bin_right"] == 5.5
    vals = [0.0, 0.1, 0.2, 0.30000000000000004, 0.7, 1.0, 2.9, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in P.histogram(df, "x", 30).collect()]
    exp, _ = np.histogram(np.array(vals), bins=30)
    assert got == exp.tolist()


def test_numeric_like_threshold(spark):
    rows = [(str(i),) for i in range(60)] + [("x",)] * 10
    df = spark.createDataFrame(rows, "c string")
    r = P.numeric_like(df).first()
    assert r["numeric_count"] == 60 and r["threshold"] == 50 and r["is_numeric_like"]


def test_tier_counts_all_tiers(spark):
    df = spark.createDataFrame([(100.0,), (900.0,), (None,)], "p double")
    out = [(r["tier"], r["count"]) for r in P.tier_counts(df, "p").collect()]
    assert out == [("budget", 1), ("mid_range", 0), ("premium", 0), ("flagship", 1)]
