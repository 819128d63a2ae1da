"""Silhouette by anchors, Ward on micro-clusters, native forest scores, bounded categories."""

import numpy as np
import pytest

from conftest import SF_SMALL
from pricewise.operators import cluster as CL
from pricewise.operators import isolation as ISO
from pricewise.operators.common import CATALOG_ROLES as R
from pricewise.operators.features import vocabulary
from pricewise.sources.catalog import catalog


def brute_silhouette(x, g):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        same = (g == g[i]).sum()
        if same == 1:
            s.append(0.0)
            continue
        a = d[i, g == g[i]].sum() / (same - 1)
        b = min(d[i, g == k].mean() for k in set(g.tolist()) - {g[i]})
        s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(s))


def _frame(spark, x, g):
    return spark.createDataFrame([(int(k), *map(float, p)) for p, k in zip(x, g)], "cluster int, " + ", ".join(f"c{i} double" for i in range(x.shape[1])))


def test_silhouette_is_exact_with_all_rows_as_anchors(spark):
    rng = np.random.default_rng(2)
    x, g = rng.normal(size=(120, 3)), rng.integers(0, 3, 120)
    x[5] = x[6]
    g[7] = 9  # alone in its cluster
    value, error, n = CL.silhouette_estimate(_frame(spark, x, g).repartition(3), ["c0", "c1", "c2"])
    assert np.isclose(value, brute_silhouette(x, g)) and error == 0 and n == 120


def test_silhouette_of_the_catalogue_is_within_two_errors(spark):
    pred, _, _ = CL.kmeans_segments(catalog(spark, SF_SMALL, "part"), R.segment_features, 3, 2)
    z = [f"z_{c}" for c in R.segment_features]
    pdf = pred.select("cluster", *z).toPandas()
    value, error, n = CL.silhouette_estimate(pred, z, anchors=30)
    assert n == 90 and 0 < error and abs(value - brute_silhouette(pdf[z].to_numpy(), pdf.cluster.to_numpy())) < 2 * error
    none = CL.silhouette_estimate(pred.where("cluster = 0"), z)
    assert np.isnan(none[0])


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                na, nb = len(groups[a]), len(groups[b])
                cost = na * nb / (na + nb) * ((x[groups[a]].mean(0) - x[groups[b]].mean(0)) ** 2).sum()
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, a, b)
        groups[best[1]] += groups.pop(best[2])
    label = np.zeros(len(x), int)
    for k, g in enumerate(groups):
        label[g] = k
    return label


def _same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_ward_equals_plain_ward_on_single_rows(spark):
    rng = np.random.default_rng(8)
    for k in (1, 3, 5):
        x = rng.normal(size=(45, 2)) + rng.integers(0, 3, 45)[:, None] * 4
        out = CL.ward_segments(_frame(spark, x, np.arange(45)).withColumnRenamed("cluster", "i").repartition(3), ["c0", "c1"], k).orderBy("i").toPandas()
        assert _same_partition(out.cluster.tolist(), plain_ward(x, k).tolist())


def test_ward_on_micro_clusters_finds_groups(spark):
    rng = np.random.default_rng(9)
    g = rng.integers(0, 3, 900)
    x = rng.normal(0, 0.4, size=(900, 2)) + np.array([[0, 0], [6, 0], [0, 7]])[g]
    out = CL.ward_segments(_frame(spark, x, g).withColumnRenamed("cluster", "g"), ["c0", "c1"], 3, micro=40).toPandas()
    assert _same_partition(out.cluster.tolist(), out.g.tolist()) and len(out) == 900


def test_forest_scores_are_native_and_equal_a_walk(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    rows = [(i, *map(float, p)) for i, p in enumerate(x)] + [(300, None, 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double")
    forest = ISO.grow_trees(ISO.sample_for_trees(df.where("row_id < 300"), ["a", "b", "c"], 300, 20, 64), ["a", "b", "c"], 64).toPandas()
    scored = ISO.score_rows(df, ["a", "b", "c"], forest, 64)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got = {r.row_id: r.isolation_score for r in scored.collect()}
    for i, *p in rows:
        ways = []
        for _, t in forest.groupby("tree_id"):
            t = t.set_index("node")
            n = 0
            while t.feature[n] >= 0:
                v = p[t.feature[n]]
                n = int(t.left_child[n] if v is not None and v < t.threshold[n] else t.right_child[n])
            ways.append(t.depth[n] + ISO.c_factor(t["size"][n]))
        assert np.isclose(got[i], 2 ** (-np.mean(ways) / ISO.c_factor(64)), rtol=1e-12)


def test_too_many_categories_are_refused(spark):
    df = spark.createDataFrame([(str(i),) for i in range(12)] + [(None,)], "b string")
    assert vocabulary(df, "b", 12) == sorted(str(i) for i in range(12))
    with pytest.raises(ValueError, match="more than 11"):
        vocabulary(df, "b", 11)


def test_pca_is_that_of_the_scaled_columns(spark):
    cat = catalog(spark, SF_SMALL, "part")
    got = CL.pca_2d(cat, R.segment_features).orderBy("item_id").toPandas()
    z = CL.scaled_features(cat, R.segment_features).orderBy("item_id").toPandas()[[f"z_{c}" for c in R.segment_features]].to_numpy()
    value, vector = np.linalg.eigh(np.cov(z.T))
    want = z @ vector[:, ::-1][:, :2]
    for j, name in enumerate(["PC1", "PC2"]):
        assert np.isclose(abs(np.corrcoef(got[name], want[:, j])[0, 1]), 1, atol=1e-6)
        assert np.isclose(got[name].std(), np.sqrt(value[::-1][j]), rtol=1e-6)
