"""Deep forests: nodes split by distributed sums and subtrees grown in tasks are one forest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import forest as FO
from pricewise.operators import models as M
from pricewise.sources import sinks as SK

FEATS = ["a", "b", "c"]
SMALL = FO.Forest(trees=4, depth=12, min_rows=2)


def rows(spark, n=1200):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n), rng.integers(0, 9, n)]).astype(float)
    y = np.exp(4 + 0.6 * np.tanh(2 * x[:, 0]) + 0.5 * x[:, 1] + rng.normal(scale=0.05, size=n))
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    data[5:8] = [(None, None, 1.0, float("nan"), 60.0)] * 3
    return spark.createDataFrame(data, "row_id long, a double, b double, c double, target_price_eur double")


def predictions(model, df):
    return sorted(((r.row_id if r.row_id is not None else -1, r.pred_t) for r in model.transform(df).collect()))


@pytest.fixture(scope="module")
def df(spark):
    return rows(spark).cache()


def test_fit_does_not_depend_on_the_sessions_partitions(spark, df):
    spec = M.scaled(M.RANDOM_FOREST, numTrees=3, maxDepth=16)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(predictions(M.fit(spec, df.repartition(int(n)), FEATS), df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) == df.count() and found[0] == found[1]


@pytest.mark.parametrize("most", [1, 60, 400])
def test_distributed_sums_give_the_trees_grown_in_tasks(df, monkeypatch, most):
    y = F.col("target_price_eur")
    whole = FO.fit_forest(df, FEATS, y, SMALL)
    assert not any(t.splits for t in whole.tops)
    monkeypatch.setattr(FO, "SMALL_ROWS", most)
    monkeypatch.setattr(FO, "BLOCK_ROWS", 100)
    cut = FO.fit_forest(df, FEATS, y, SMALL)
    assert all(t.splits for t in cut.tops)
    assert predictions(cut, df) == predictions(whole, df)
    assert np.allclose(cut.featureImportances.toArray(), whole.featureImportances.toArray())


def test_one_tree_is_the_greedy_one(spark):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 7, (90, 2)).astype(float), rng.integers(0, 50, 90).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "row_id long, a double, b double, y double")
    p = FO.Forest(trees=1, depth=5, min_rows=3)
    model = FO.fit_forest(df, ["a", "b"], F.col("y"), p)
    key = np.array([r.h for r in df.orderBy("row_id").select(F.xxhash64("row_id", "a", "b", "y").alias("h")).collect()], np.int64).view(np.uint64)
    w = FO.bag(key, np.ones(90, np.int64), 0, p.seed, 1.0)
    assert 60 <= w.sum() <= 120 and w.max() > 1

    def best(at, depth):
        out = {}
        gains = []
        for f in (0, 1):
            for v in sorted(set(x[at, f])):
                l, r = at[x[at, f] <= v], at[x[at, f] > v]
                if min(w[l].sum(), w[r].sum()) >= p.min_rows:
                    gains.append((sum((w[s] @ y[s]) ** 2 / w[s].sum() for s in (l, r)) - (w[at] @ y[at]) ** 2 / w[at].sum(), f, v))
        top = max((g for g, _, _ in gains), default=0)
        if depth == p.depth or top < 1e-9:
            return lambda row: w[at] @ y[at] / w[at].sum()
        _, f, v = next(g for g in gains if g[0] > top - 1e-9)
        # between the values of the whole column
        some = sorted(set(x[:, f]))
        cut = v + (some[some.index(v) + 1] - v) / 2
        left, right = best(at[x[at, f] <= v], depth + 1), best(at[x[at, f] > v], depth + 1)
        return lambda row: left(row) if row[f] <= cut else right(row)

    walk = best(np.flatnonzero(w), 0)
    got = dict(predictions(model, df))
    assert np.allclose([got[i] for i in range(90)], [walk(r) for r in x], atol=1e-6)


def test_copies_are_drawn_as_often_as_rows():
    key = np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for copies in (1, 3, 700):
        w = FO.bag(key, np.full(4000, copies, np.int64), 2, 42, 1.0)
        assert abs(w.mean() / copies - 1) < 0.06 and abs(w.var() / copies - 1) < 0.12
    assert abs(FO.bag(key, np.full(4000, 2, np.int64), 2, 42, 0.25).mean() - 0.5) < 0.05


def test_deep_forest_predicts_and_is_kept(spark, df, tmp_path):
    model = M.fit(M.scaled(M.RANDOM_FOREST, numTrees=40, maxDepth=12), df, FEATS, "log_price_eur")
    assert isinstance(model, FO.ForestModel)
    out = M.predict(model, df, "log_price_eur", keep=("row_id", "target_price_eur")).where("row_id is not null").toPandas()
    assert np.corrcoef(out.yhat, out.target_price_eur)[0, 1] > 0.9
    assert np.argmin(model.featureImportances.toArray()) == 2 and abs(sum(model.featureImportances.toArray()) - 1) < 1e-9
    back, meta = SK.load_model(SK.write_model(model, str(tmp_path / "package"), {"model_name": "forest"}))
    assert meta["model_name"] == "forest" and predictions(back, df) == predictions(model, df)


def test_targets_without_a_number_and_no_rows_are_refused(df):
    with pytest.raises(ValueError, match="null"):
        FO.fit_forest(df, FEATS, F.when(F.col("b") == 1, F.col("target_price_eur")), SMALL)
    with pytest.raises(ValueError, match="no row"):
        FO.fit_forest(df.where("b > 5"), FEATS, F.col("target_price_eur"), SMALL)
    flat = FO.fit_forest(df, FEATS, F.lit(7.0), SMALL)
    assert {v for _, v in predictions(flat, df)} == {7.0}
