"""Sums of products by fold and the fits solved from them."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.operators import gram as GR
from pricewise.operators import models as M
from pricewise.plans import price_plan as PP
from pricewise.sources import sinks as SK

FEATS = ["a", "b", "one", "two", "three"]


def _table(spark, n=400, seed=2):
    """Indicators add up to one and b follows from them: two missing ranks."""
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 3, n)
    a = rng.normal(5, 2, n)
    b = np.array([1.0, 0.0, 1.0])[kind]
    y = 300 + 20 * a + np.array([5.0, 50.0, 90.0])[kind] + rng.normal(0, 1, n)
    rows = [(i, float(a[i]), float(b[i]), *(float(kind[i] == j) for j in range(3)), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, one double, two double, three double, target_price_eur double")


def _lstsq(x, y, alpha=0.0):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.lstsq(xc, yc, rcond=1e-10)[0] if not alpha else np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def test_sums_equal_numpy_and_partitioning_does_not_matter(spark):
    df = _table(spark).withColumn("fold", (F.col("row_id") % 3).cast("int"))
    pdf = df.toPandas()
    full = np.column_stack([np.ones(len(pdf)), pdf[FEATS], pdf.target_price_eur])
    for parts in (1, 7):
        got = GR.collect_grams(df.repartition(parts), FEATS, {"y": F.col("target_price_eur")}, F.col("fold"))
        assert list(got) == [0, 1, 2]
        for k, g in got.items():
            x = full[pdf.fold == k]
            assert np.allclose(g.m, x.T @ x, rtol=1e-12) and g.n == len(x)


def test_rank_deficient_fit_is_the_one_of_least_norm(spark):
    df = _table(spark)
    pdf = df.toPandas()
    for mode, y in (("price_eur", pdf.target_price_eur), ("log_price_eur", np.log1p(pdf.target_price_eur))):
        w, c = _lstsq(pdf[FEATS].to_numpy(), y.to_numpy())
        m = M.fit(M.LINEAR, df, FEATS, mode)
        assert np.allclose(m.coefficients.toArray(), w, rtol=1e-6, atol=1e-8) and np.isclose(m.intercept, c)


def test_out_of_fold_fits_equal_single_fits(spark):
    df = _table(spark).withColumn("fold", (F.col("row_id") % 5).cast("int"))
    pairs = [(s, m) for s in (M.LINEAR, M.RIDGE) for m in ("price_eur", "log_price_eur")]
    got = {(r.model, r.target_mode, r.row_id): r.yhat for r in M.linear_oof_predict(df, pairs, features=FEATS).collect()}
    pdf = df.toPandas()
    assert len(got) == 4 * len(pdf)
    for spec, mode in pairs:
        y = pdf.target_price_eur.to_numpy() if mode == "price_eur" else np.log1p(pdf.target_price_eur.to_numpy())
        for k in range(5):
            inside = (pdf.fold == k).to_numpy()
            w, c = _lstsq(pdf[FEATS].to_numpy()[~inside], y[~inside], 1.0 if spec is M.RIDGE else 0.0)
            p = pdf[FEATS].to_numpy()[inside] @ w + c
            want = p if mode == "price_eur" else np.expm1(p)
            assert np.allclose([got[spec.name, mode, i] for i in pdf.row_id[inside]], want, rtol=1e-8)


def test_rows_that_are_not_whole_are_left_out(spark):
    df = _table(spark, 50)
    bad = spark.createDataFrame([(900, None, 0.0, 1.0, 0.0, 0.0, 5.0), (901, float("nan"), 0.0, 1.0, 0.0, 0.0, 5.0), (902, 1.0, 0.0, 1.0, 0.0, 0.0, None)], df.schema)
    a, b = M.fit(M.RIDGE, df, FEATS), M.fit(M.RIDGE, df.unionByName(bad), FEATS)
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray())


def test_linear_package_round_trip(spark, tmp_path):
    df = _table(spark, 80)
    m = M.fit(M.RIDGE, df, FEATS, "log_price_eur")
    back, meta = SK.load_model(SK.write_model(m, str(tmp_path / "package"), {"target_mode": "log_price_eur"}))
    assert meta == {"target_mode": "log_price_eur", "kind": "linear"}
    a = {r.row_id: r.yhat for r in M.predict(m, df, "log_price_eur").collect()}
    assert a == {r.row_id: r.yhat for r in M.predict(back, df, "log_price_eur").collect()} and len(a) == 80


def test_tree_package_round_trip(spark, tmp_path):
    df = _table(spark, 80)
    m = M.fit(M.scaled(M.RANDOM_FOREST, numTrees=3, maxDepth=3), df, FEATS)
    back, meta = SK.load_model(SK.write_model(m, str(tmp_path / "package"), {"model_name": "forest"}))
    assert meta["kind"] == "pipeline"
    a = {r.row_id: r.yhat for r in M.predict(m, df, "price_eur").collect()}
    assert a == {r.row_id: r.yhat for r in M.predict(back, df, "price_eur").collect()}


def test_linear_half_of_the_cross_validation_reads_the_table_twice(spark):
    """One scan for all sums, one that predicts with all folds, modes and models."""
    enc = PP.encoded_with_folds(spark, SF_SMALL, "part")
    pairs = [(s, m) for s in (M.LINEAR, M.RIDGE) for m in ("price_eur", "log_price_eur")]
    plan = M.linear_oof_predict(enc, pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
