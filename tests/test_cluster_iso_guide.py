"""Clustering, isolation forest and guide rules."""

import numpy as np
from pyspark.sql import functions as F

from pricewise.operators import cluster as CL
from pricewise.operators import guide as GD
from pricewise.operators import isolation as ISO
from pricewise.operators.features import one_hot


def _blobs(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    pts = np.vstack([rng.normal(c, 0.3, size=(n // 3, 2)) for c in ([0, 0], [5, 5], [0, 8])])
    return spark.createDataFrame([(i, float(a), float(b), i % 3) for i, (a, b) in enumerate(pts)],
                                 "item_id long, a double, b double, given int")


def test_davies_bouldin_matches_numpy(spark):
    df = _blobs(spark)
    pdf = df.toPandas()
    X, lab = pdf[["a", "b"]].to_numpy(), pdf["given"].to_numpy()
    ks = sorted(set(lab))
    cent = np.array([X[lab == k].mean(0) for k in ks])
    s = np.array([np.linalg.norm(X[lab == k] - cent[i], axis=1).mean() for i, k in enumerate(ks)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(cent[i] - cent[j]) for j in range(3) if j != i) for i in range(3)])
    got = CL.davies_bouldin(df, ["a", "b"], "given").first()[0]
    assert abs(got - db) < 1e-9


def test_assign_nearest_brute_force(spark):
    df = _blobs(spark)
    cents = spark.createDataFrame([(0, [0.0, 0.0]), (1, [5.0, 5.0]), (2, [0.0, 8.0])], "cluster int, center array<double>")
    got = {r[0]: r[1] for r in CL.assign_nearest(df, ["a", "b"], cents).select("item_id", "cluster").collect()}
    pdf = df.toPandas()
    C = np.array([[0, 0], [5, 5], [0, 8]])
    exp = np.argmin(((pdf[["a", "b"]].to_numpy()[:, None, :] - C[None]) ** 2).sum(-1), axis=1)
    assert all(got[i] == e for i, e in zip(pdf.item_id, exp))


def test_kmeans_finds_blobs(spark):
    df = _blobs(spark)
    pred, model, cost = CL.kmeans_segments(df, ["a", "b"], 3, 3)
    assert pred.select("cluster").distinct().count() == 3 and cost > 0


def test_isolation_flags_share_and_obvious_outlier(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(0, 1, size=(2000, 2))
    pts[0] = [15.0, -15.0]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "row_id long, a double, b double")
    out = ISO.isolation_outliers(df, ["a", "b"], n_trees=50)
    share = out.agg(F.avg(F.col("isolation_raw_outlier").cast("double"))).first()[0]
    assert abs(share - 0.05) < 0.01
    assert out.filter("row_id = 0").first()["isolation_raw_outlier"]


def test_guidance_label_edges(spark):
    rows = [(None, 100.0), (30.0, 100.0), (30.01, 100.0), (-80.0, 1000.0), (-80.01, 1000.0)]
    df = spark.createDataFrame(rows, "gap double, pred double")
    out = [r[0] for r in df.select(GD.price_guidance_label(F.col("gap"), F.col("pred"))).collect()]
    assert out == [GD.NO_PRICE, GD.NEAR, GD.ABOVE, GD.NEAR, GD.BELOW]


def test_one_hot_unknown_goes_to_other(spark):
    df = spark.createDataFrame([("A",), ("Zed",), (None,)], "brand string")
    out = one_hot(df, "brand", ["A", "Other"], "cat__brand_group_").collect()
    assert [(r["cat__brand_group_A"], r["cat__brand_group_Other"]) for r in out] == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


def test_brand_note_fallbacks(spark):
    req = spark.createDataFrame([(1, "A"), (2, "Q"), (3, None)], "request_id int, brand string")
    bs = spark.createDataFrame([("A", 512.25, 3)], "brand_group string, avg_price_eur double, count long")
    adj = spark.createDataFrame([("A", -20.05)], "brand_group string, avg_adjusted_brand_premium_eur double")
    out = {r[0]: r[1] for r in GD.brand_note(req, bs, adj).select("request_id", "brand_premium_note").collect()}
    assert out[1] == f"avg_price={512.25:.1f} EUR, count=3; adjusted_premium={-20.05:.1f} EUR"
    assert out[2] == "brand premium row unavailable" and out[3] == "no brand specified"
