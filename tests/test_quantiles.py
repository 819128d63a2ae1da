"""Exact distributed quantiles equal Spark's exact percentile, over any
number of ranges and with heavy ties."""

import pytest
from pyspark.sql import functions as F

from pricewise.operators.quantiles import column_medians_exact, exact_quantiles

QS = [0.0, 1 / 3, 0.5, 2 / 3, 0.95, 1.0]


@pytest.mark.parametrize("col", ["x", "y"])
@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_matches_percentile(spark, col, groups, ranges):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), (F.rand(7) * 1000).alias("x"),
                                   F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.round(F.rand(3) * 50)).alias("y"))
    got = {(tuple(r[g] for g in groups), r["qi"]): r["value"]
           for r in exact_quantiles(df, col, QS, groups, ranges=ranges).collect()}
    exp = df.groupBy(*groups).agg(F.percentile(col, F.array(*[F.lit(q) for q in QS])).alias("p")).collect()
    for r in exp:
        key = tuple(r[g] for g in groups)
        for i, v in enumerate(r["p"]):
            assert abs(got[(key, i)] - v) <= 1e-9 * max(1.0, abs(v)), (key, QS[i], got[(key, i)], v)


def test_nulls_nan_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None), (None, 7.0)],
                               "g string, x double")
    out = {r["g"]: r["x"] for r in column_medians_exact(df, ["x"], ["g"]).collect()}
    assert out["a"] == 2.0 and out.get("b") is None and None not in out


def test_weights_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 9.0, 1), ("b", 2.0, 2), ("b", 4.0, 2)], "g string, x double, n long")
    got = {r.g: r.value for r in exact_quantiles(df, "x", [0.5], ["g"], weight="n").collect()}
    assert got == {"a": 1.0, "b": 3.0}
    assert [(r.qi, r.value) for r in exact_quantiles(df.limit(0), "x", [0.25, 0.5]).orderBy("qi").collect()] == [(0, None), (1, None)]
    assert exact_quantiles(df.limit(0), "x", [0.5], ["g"]).collect() == []


def test_no_nested_loop_join(spark):
    """The joins are by keys, or with one row; nothing pairs rows with quantiles."""
    plans = []
    import pricewise.operators.quantiles as Q
    real = Q.cut_lineage
    try:
        Q.cut_lineage = lambda d, name="t": (plans.append(d._jdf.queryExecution().executedPlan().toString()), real(d, name))[1]
        exact_quantiles(spark.range(1000).selectExpr("id % 7 as g", "cast(id as double) as x"), "x", [0.1 * i for i in range(11)], ["g"])
    finally:
        Q.cut_lineage = real
    assert plans and not any("NestedLoop" in p or "Cartesian" in p for p in plans)


def test_fold_medians(spark):
    from pricewise.operators.folds import baseline_median
    df = spark.range(500).selectExpr("cast(id % 5 as int) as fold", "cast(id * id % 101 as double) as y")
    got = {r.k: r.baseline for r in baseline_median(df, "y").collect()}
    for k in range(5):
        assert got[k] == df.where(F.col("fold") != k).agg(F.percentile("y", 0.5)).first()[0]
