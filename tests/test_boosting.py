"""Boosted trees on histograms against a plain implementation that grows a leaf at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import boosting as B


def _plain_leafwise(x, y, cuts, p, start):
    """Predictions of every row: one split after the other on the whole arrays."""
    bins = np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)])
    margin = np.full(len(y), start)
    for _ in range(p.rounds):
        g = margin - y
        leaves = [np.arange(len(y))]

        def best(rows):
            found = (0.0, None)
            s = g[rows].sum() ** 2 / (len(rows) + p.l2)
            for f in range(x.shape[1]):
                for b in range(len(cuts[f])):
                    go = bins[rows, f] > b
                    nr = int(go.sum())
                    nl = len(rows) - nr
                    if min(nl, nr) < p.min_rows:
                        continue
                    gain = g[rows[~go]].sum() ** 2 / (nl + p.l2) + g[rows[go]].sum() ** 2 / (nr + p.l2) - s
                    if gain > found[0] + 1e-9:
                        found = (gain, (f, b))
            return found

        options = [best(leaves[0])]
        while len(leaves) < p.leaves:
            i = int(np.argmax([o[0] for o in options]))
            if options[i][1] is None:
                break
            f, b = options[i][1]
            rows = leaves.pop(i)
            options.pop(i)
            go = bins[rows, f] > b
            for part in (rows[~go], rows[go]):
                leaves.append(part)
                options.append(best(part))
        for rows in leaves:
            margin[rows] -= p.rate * g[rows].sum() / (len(rows) + p.l2)
    return margin


def _plain_symmetric(x, y, cuts, p, start):
    bins = np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)])
    margin = np.full(len(y), start)
    for _ in range(p.rounds):
        g = margin - y
        leaf = np.zeros(len(y), int)

        def score(of):
            return sum(g[of == v].sum() ** 2 / ((of == v).sum() + p.l2) for v in np.unique(of))

        for _ in range(p.depth):
            now, found = score(leaf), (0.0, None)
            for f in range(x.shape[1]):
                for b in range(len(cuts[f])):
                    go = bins[:, f] > b
                    if go.all() or not go.any():
                        continue
                    gain = score(leaf * 2 + go) - now
                    if gain > found[0] + 1e-9:
                        found = (gain, (f, b))
            if found[1] is None:
                break
            leaf = leaf * 2 + (bins[:, found[1][0]] > found[1][1])
        for v in np.unique(leaf):
            rows = leaf == v
            margin[rows] -= p.rate * g[rows].sum() / (rows.sum() + p.l2)
    return margin


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 240
    x = np.round(rng.normal(size=(n, 3)), 2)
    x[:, 2] = rng.integers(0, 3, n)
    y = np.where(x[:, 0] > 0.2, 3.0 * x[:, 1], -x[:, 2]) + rng.normal(scale=0.1, size=n)
    rows = [(i, *map(float, x[i]), float(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, `a.1` double, b double, c double, y double, fold int"), x, y


FEATURES = ["a.1", "b", "c"]


def _predictions(df, model, parts=3):
    got = B.score(df.repartition(parts), {"pred": {None: model}}).orderBy("row_id").collect()
    return np.array([r.pred for r in got])


def test_leafwise_equals_one_leaf_at_a_time(spark, table):
    df, x, y = table
    p = B.Boost(rounds=6, rate=0.3, leaves=9, min_rows=8)
    cuts = B.quantile_cuts(df, FEATURES, 12)
    model, = B.fit_many(df, FEATURES, {"y": F.col("y")}, [B.Run(p, "y")], cuts=cuts)
    assert all((t.left == np.arange(len(t.left))).sum() == 9 for t in model.trees)
    assert np.allclose(_predictions(df, model), _plain_leafwise(x, y, cuts, p, y.mean()), rtol=0, atol=1e-7)


def test_symmetric_equals_plain_and_is_scored_natively(spark, table):
    df, x, y = table
    p = B.Boost(rounds=5, rate=0.3, shape="symmetric", depth=3, l2=3.0)
    cuts = B.quantile_cuts(df, FEATURES, 10)
    model, = B.fit_many(df, FEATURES, {"y": F.col("y")}, [B.Run(p, "y")], cuts=cuts)
    assert np.allclose(_predictions(df, model), _plain_symmetric(x, y, cuts, p, y.mean()), rtol=0, atol=1e-7)
    plan = model.transform(df)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "PythonUDF" not in plan


def test_fits_together_equal_single_fits_on_any_partitioning(spark, table):
    df, _, _ = table
    p = B.Boost(rounds=4, rate=0.2, leaves=7, min_rows=5, rows=0.8, columns=0.7)
    q = B.Boost(rounds=7, rate=0.2, shape="symmetric", depth=2, l2=1.0)
    targets = {"y": F.col("y"), "z": F.col("y") * F.col("y")}
    runs = [B.Run(p, "y", 0), B.Run(p, "z", 1), B.Run(q, "y", 2), B.Run(p, "y", None)]
    cuts = B.quantile_cuts(df, FEATURES, 16)
    together = B.fit_many(df.repartition(7), FEATURES, targets, runs, F.col("fold"), cuts=cuts)
    for r, m in zip(runs, together):
        alone, = B.fit_many(df.coalesce(1), FEATURES, targets, [r], F.col("fold"), cuts=cuts)
        assert len(alone.trees) == len(m.trees) > 2 and alone.start == m.start
        for s, t in zip(alone.trees, m.trees):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and (s.value == t.value).all()


def test_two_step_sums_and_checkpoints_change_nothing(spark, table, monkeypatch):
    df, _, _ = table
    p = B.Boost(rounds=5, rate=0.3, leaves=6, min_rows=5)
    cuts = B.quantile_cuts(df, FEATURES, 16)
    plain, = B.fit_many(df, FEATURES, {"y": F.col("y")}, [B.Run(p, "y")], cuts=cuts)
    monkeypatch.setattr(B, "DIRECT_PARTITIONS", 1)
    monkeypatch.setattr(B, "TASK_BYTES", 100)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
    other, = B.fit_many(df.repartition(5), FEATURES, {"y": F.col("y")}, [B.Run(p, "y")], cuts=cuts)
    for s, t in zip(plain.trees, other.trees):
        assert (s.feature == t.feature).all() and (s.value == t.value).all()


def test_left_out_fold_is_not_seen(spark, table):
    df, _, _ = table
    p = B.Boost(rounds=3, rate=0.5, leaves=5, min_rows=5)
    cuts = B.quantile_cuts(df, FEATURES, 16)
    wild = df.withColumn("y", F.when(F.col("fold") == 1, F.lit(1e6)).otherwise(F.col("y")))
    a, = B.fit_many(df, FEATURES, {"y": F.col("y")}, [B.Run(p, "y", 1)], F.col("fold"), cuts=cuts)
    b, = B.fit_many(wild, FEATURES, {"y": F.col("y")}, [B.Run(p, "y", 1)], F.col("fold"), cuts=cuts)
    assert all((s.value == t.value).all() for s, t in zip(a.trees, b.trees))


def test_strange_rows(spark):
    """Nulls and not-a-numbers in features go right, in targets are left out; constant
    columns, equal targets and empty tables give a constant."""
    nan = float("nan")
    rows = [(i, None if i % 5 == 0 else float(i), 1.0, nan if i % 7 == 0 else (50.0 if i % 5 == 0 else 1.0)) for i in range(100)]
    df = spark.createDataFrame(rows, "row_id long, a double, k double, y double")
    for shape in ("leafwise", "symmetric"):
        q = B.Boost(rounds=8, rate=0.9, leaves=3, min_rows=2, shape=shape, depth=2)
        m, = B.fit_many(df, ["a", "k"], {"y": F.col("y")}, [B.Run(q, "y")])
        got = {r.row_id: r.pred_t for r in m.transform(df).collect()}
        assert abs(got[5] - 50.0) < 0.5 and abs(got[6] - 1.0) < 0.5 and abs(got[0] - 50.0) < 0.5
        assert m.featureImportances[0] > 0.99
        flat, = B.fit_many(df, ["a", "k"], {"y": F.lit(4.0)}, [B.Run(q, "y")])
        assert {r.pred_t for r in flat.transform(df).collect()} == {4.0}
        none, = B.fit_many(df.where("false"), ["a", "k"], {"y": F.col("y")}, [B.Run(q, "y")])
        assert all(np.isnan(r.pred_t) for r in none.transform(df).collect())
        assert m.transform(df.where("false")).count() == 0
