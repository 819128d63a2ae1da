"""What the findings of round 3 named."""

import pickle

import numpy as np
from pyspark.rdd import RDD
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from pricewise.functions import clean as C
from pricewise.operators import boosting as B
from pricewise.operators import cluster as CL
from pricewise.operators import isolation as ISO
from pricewise.operators import lloyd as L


def test_sums_sent_to_the_driver_do_not_grow_with_tasks(spark, monkeypatch):
    """One sum a fit and pass arrives, whatever the partitions, and a feature of two values
    costs its own bins only."""
    df = spark.range(0, 4000, 1, 8).select(F.col("id").alias("row_id"), (F.col("id") % 97).cast("double").alias("a"),
                                           *((F.col("id") % k == 0).cast("double").alias(f"b{k}") for k in range(2, 12)),
                                           F.sqrt(F.col("id") * 37 % 1000).alias("y"))
    features = ["a", *(f"b{k}" for k in range(2, 12))]
    p = B.Boost(rounds=2, rate=0.3, leaves=6, min_rows=5)
    cuts = B.quantile_cuts(df, features)
    plain = RDD.collect
    sent = []
    monkeypatch.setattr(RDD, "collect", lambda self: sent.append(plain(self)) or sent[-1])

    def size(table):
        sent.clear()
        B.fit_many(table, features, {"y": F.col("y")}, [B.Run(p, "y", None), B.Run(p, "y", 0)], F.lit(1), cuts=cuts)
        return sum(len(pickle.dumps(s)) for s in sent)

    one = size(df.coalesce(1))
    monkeypatch.setattr(B, "TASK_BYTES", 100)
    many = size(df)
    assert 0 < many < 1.2 * one
    assert max(len(v[0]) for s in sent for _, v in s) <= 6 * sum(len(c) + 1 for c in cuts)


def test_strip_reads_the_ends_only(spark):
    """As Python's strip, without a pattern that tries every place of a text."""
    space = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
    texts = ["", " ", space, f"{space}a{space}b{space}", "a\r\n", "\u0085x\u2028\n", "\u200bx\u200b", "x", None, *(f"{c}x {c}y{c}" for c in space)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", C.py_strip("t").alias("s"))
    assert {r.i: r.s for r in out.collect()} == {i: t if t is None else t.strip() for i, t in enumerate(texts)}
    plan = C.normalize_missing(df)._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower()


def test_isolation_flags_rows_by_chunks_with_the_native_scores(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(500, 2)))] + [(500, None, 1.0), (501, float("nan"), float("inf")), (None, -0.0, 0.0)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double")
    forest = ISO.grow_trees(ISO.sample_for_trees(df.where("row_id < 500"), ["a", "b"], 500, 20, 64), ["a", "b"], 64).toPandas()
    monkeypatch.setattr(ISO, "CHUNK", 100)
    want = sorted(map(tuple, ISO.score_rows(df, ["a", "b"], forest, 64).collect()), key=str)
    got = sorted(map(tuple, ISO.score_rows(df, ["a", "b"], forest, 64, native=False).collect()), key=str)
    assert got == want and len(got) == 503

    def refused(*_):
        raise AssertionError("scored row by row")
    monkeypatch.setattr(ISO, "packed_forest", refused)
    out = ISO.isolation_outliers(df.where("row_id < 500"), ["a", "b"], 20, 64)
    assert out.count() == 500


def test_nearest_centre_and_many_centres(spark, monkeypatch):
    """A centre at a time gives the same as the table of all distances, ties to the first, and
    Ward's rows meet their many micro-clusters in numpy, strange rows included."""
    rng = np.random.default_rng(4)
    x, c = np.asfortranarray(rng.integers(0, 4, (500, 3)).astype(float)), rng.integers(0, 4, (20, 3)).astype(float)
    place, least = L._nearest(x, c)
    far = L._squares(x, c)
    assert (place == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()

    rows = [(i, *map(float, v)) for i, v in enumerate(x)] + [(500, None, 1.0, 2.0), (501, float("nan"), 3.0, 3.0), (502, float("inf"), 3.0, 3.0)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double")
    cents = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(c)], "cluster int, center array<double>")
    want = {r.i: r.m for r in CL.assign_nearest(df, ["a", "b", "c"], cents, "m").collect()}
    assert {r.i: r.m for r in CL._assign_many(df, ["a", "b", "c"], c, "m").collect()} == want

    def refused(*_):
        raise AssertionError("many centres compared row by row")
    monkeypatch.setattr(CL, "assign_nearest", refused)
    out = CL.ward_segments(df.where("i < 500"), ["a", "b", "c"], 3, micro=16)
    assert out.count() == 500 and out.select("cluster").distinct().count() == 3


def test_silhouette_in_small_pieces(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(int(g), float(v + 3 * g)) for g, v in zip(rng.integers(0, 3, 300), rng.normal(size=300))], "cluster int, a double")
    want = CL.silhouette_estimate(df, ["a"], anchors=40)
    monkeypatch.setattr(CL, "CACHED", 500)
    got = CL.silhouette_estimate(df, ["a"], anchors=40)
    assert np.allclose(got, want, rtol=1e-12)


def test_modeling_summary_is_of_all_folds(spark):
    found = {r.item: r.value for r in E.queries()["modeling_summary"](spark, SF_SMALL).collect()}
    best = E.queries()["model_leaderboard"](spark, SF_SMALL).first()
    assert found["best_regression_model"] == f"{best.model} ({best.target_mode})"
    assert abs(float(found["holdout_mae_eur"]) - best.MAE) < 0.006 and abs(float(found["holdout_r2"]) - best.R2) < 0.00006
