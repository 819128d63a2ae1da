"""Findings of round 4: nothing that grows is broadcast, forests score in groups."""

import inspect
from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.llm import decontaminate as D
from pricewise.operators import forest as FO
from pricewise.operators import models as M

ITEM = "If a train travels 120 km in 2 hours and Alice boards it at Paris, then how far does Alice get in 2 more hours at the same speed as before?"


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [j for j in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin", "SortMergeJoin") if j in plan]


def texts(spark):
    docs = spark.createDataFrame([(i, f"{i} " + ITEM.replace("120", str(i % 7 + 100))) for i in range(300)], "doc_id long, text string")
    return docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string")


def test_occurrences_are_not_broadcast_by_the_size_of_their_file(spark):
    """300 documents repeat one item, so the file of their hits is tiny."""
    found = D.matches(*texts(spark))
    assert joins(found) == ["SortMergeJoin"]
    assert found.count() == 300


def test_the_pipelines_stage_does_not_broadcast_occurrences(spark, monkeypatch):
    """the same join within the pipeline's fourth stage."""
    import corpus_pipeline as CP
    docs, bench = texts(spark)
    seen, cut = {}, D.cut_lineage
    monkeypatch.setattr(D, "cut_lineage", lambda df, name: (seen.update({name: joins(df)}), cut(df, name))[1])
    monkeypatch.setattr(CP, "table", lambda *_: bench)
    clean = docs.limit(1).select(F.lit(1000).cast("long").alias("doc_id"), F.lit("nothing of the kind").alias("text"))
    assert [r.doc_id for r in CP.decontamination(spark, docs.unionByName(clean), "").collect()] == [1000]
    assert seen["contaminated"] == ["SortMergeJoin"]


def test_a_forest_scores_without_broadcasts_and_in_groups_of_any_size(spark, monkeypatch):
    """neither the table, nor its rows by tree, nor the subtrees reach the driver."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 2))
    df = spark.createDataFrame([(i, float(a), float(b), float(3 * a + b)) for i, (a, b) in enumerate(x)], "row_id long, a double, b double, y double")
    model = FO.fit_forest(df, ["a", "b"], F.col("y"), FO.Forest(trees=3, depth=6))
    whole = model.transform(df)
    assert joins(whole) == ["SortMergeJoin"]
    want = sorted(map(tuple, whole.collect()))
    assert len(want) == 500
    monkeypatch.setattr(FO, "SCORE_ROWS", 60)
    monkeypatch.setattr(FO, "BLOCK_ROWS", 25)
    assert sorted(map(tuple, model.transform(df.repartition(3)).collect())) == want


def test_boosting_in_one_task_equals_passes(spark, monkeypatch):
    """F5 to F14: full numbers of rounds need fits without a job for each pass."""
    from pricewise.operators import boosting as B
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)).round(1)
    rows = [(i, *map(float, r), None if i % 50 == 0 else float(r[0] * r[1] + r[2]), i % 4) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, fold int").repartition(3)
    runs = [B.Run(B.Boost(rounds=6, rate=0.3, leaves=9, min_rows=5, rows=0.8, columns=0.7), "y", 1), B.Run(B.Boost(rounds=5, shape="symmetric", depth=4, l2=3.0), "z"),
            B.Run(B.Boost(rounds=4, leaves=5, min_rows=300), "y")]
    targets = {"y": F.col("y"), "z": F.col("y") * 2 + 1}
    here = B.fit_many(df, ["a", "b", "c"], targets, runs, F.col("fold"), bins=16)
    monkeypatch.setattr(B, "LOCAL_BYTES", 0)
    monkeypatch.setattr(B, "TASK_BYTES", 100)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
    passes = B.fit_many(df, ["a", "b", "c"], targets, runs, F.col("fold"), bins=16)
    assert [len(m.trees) for m in here] == [6, 5, 1]
    for m, n in zip(here, passes):
        assert m.start == n.start and len(m.trees) == len(n.trees)
        for s, t in zip(m.trees, n.trees):
            assert s.depth == t.depth and all((getattr(s, k) == getattr(t, k)).all() for k in ("feature", "bin", "cut", "left", "right", "value", "gain"))


#: (query, function of models that it calls, parameter, value).
FULL = [
    ("adjusted_brand_premium", "adjusted_brand_premium", "spec", M.BOOSTED),
    ("compare_models", "compare_models", "specs", M.DEFAULT_MODELS),
    ("cross_validate", "cross_validate", "specs", M.DEFAULT_MODELS),
    ("feature_importance", "feature_importance", "specs", (M.RF_IMPORTANCE, M.BOOSTED)),
    ("fit_boosted_trees", "fit", "spec", M.BOOSTED),
    ("holdout_predictions", "fit_bases", "specs", M.ENSEMBLE_BASES),
    ("stacking_ensemble", "stacking_ensemble", "specs", M.ENSEMBLE_BASES),
    ("weighted_blend_models", "weighted_blend", "specs", M.ENSEMBLE_BASES),
    ("price_guide", "compare_models", "specs", M.DEFAULT_MODELS),
]


class Seen(Exception):
    pass


@pytest.mark.parametrize("query, function, parameter, want", FULL, ids=[f[0] for f in FULL])
def test_registered_queries_fit_with_all_parameters(spark, monkeypatch, query, function, parameter, want):
    """F5 to F10, F12 to F14: no fewer rounds, trees or levels than the library's."""
    from pricewise.plans import model_plan as MP
    from pricewise.plans import price_plan as PP
    from pricewise.plans import queries as Q
    signature = inspect.signature(getattr(M, function))

    def seen(*given, **named):
        bound = signature.bind(*given, **named)
        bound.apply_defaults()
        raise Seen(bound.arguments[parameter])

    monkeypatch.setattr(MP, "encoded", lambda *_: MagicMock())
    monkeypatch.setattr(PP, "readable", lambda *_: MagicMock())
    monkeypatch.setattr(M, function, seen)
    with pytest.raises(Seen) as caught:
        Q.QUERIES[query](spark, "")
    got = caught.value.args[0]
    assert got == want or list(got) == list(want)


def test_price_guide_explains_with_all_parameters(spark, monkeypatch):
    """the guide's importances and premiums come from full models too."""
    from pricewise.plans import model_plan as MP
    called = []
    importance, premium = inspect.signature(M.feature_importance), inspect.signature(M.adjusted_brand_premium)

    def note(signature, *given, **named):
        bound = signature.bind(*given, **named)
        bound.apply_defaults()
        called.append(bound.arguments.get("specs", bound.arguments.get("spec")))
        return MagicMock()

    for name in ("RP", "GD", "PP"):
        monkeypatch.setattr(MP, name, MagicMock())
    for name in ("encoded", "column_medians", "guide_requests"):
        monkeypatch.setattr(MP, name, lambda *_: MagicMock())
    monkeypatch.setattr(M, "compare_models", lambda enc, specs, **_: (called.append(list(specs)), None, {}))
    monkeypatch.setattr(M, "winner", lambda *_: ("price_eur", None))
    monkeypatch.setattr(M, "feature_importance", lambda *a, **k: note(importance, *a, **k))
    monkeypatch.setattr(M, "adjusted_brand_premium", lambda *a, **k: note(premium, *a, **k))
    MP.price_guide(spark, "")
    assert called == [M.DEFAULT_MODELS, (M.RF_IMPORTANCE, M.BOOSTED), M.BOOSTED]


def plain_silhouette(x, g):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        mean = {k: far[i, g == k].sum() / max((g == k).sum() - (k == g[i]), 1) for k in set(g)}
        a, b = mean.pop(g[i]), min(mean.values())
        out.append((b - a) / max(a, b) if (g == g[i]).sum() > 1 and max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouettes_are_of_all_rows(spark, monkeypatch):
    """more rows in a cluster than the 512 anchors of the estimate, copies among them."""
    from pricewise.operators import cluster as CL
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(c, 1.0, size=(700, 2)) for c in (0.0, 3.0)] + [np.full((30, 2), 9.5)])
    g, h = (x[:, 0] > 1.4).astype(int), rng.integers(0, 3, len(x))
    h[5] = 7  # alone
    rows = [(float(a), float(b), int(i), int(j), 4, None if k < 100 else int(i)) for k, ((a, b), i, j) in enumerate(zip(x, g, h))]
    df = spark.createDataFrame(rows, "a double, b double, g int, h int, one int, some int").repartition(3)
    want = [plain_silhouette(x, g), plain_silhouette(x, h), plain_silhouette(x[100:], g[100:])]
    assert np.isclose(CL.silhouette(df, ["a", "b"], "g"), want[0], rtol=0, atol=1e-9)
    monkeypatch.setattr(CL, "LEFT_ROWS", 100)
    monkeypatch.setattr(CL, "RIGHT_ROWS", 70)
    got = CL.silhouettes(df, ["a", "b"], ["g", "h", "some", "one"])
    assert np.allclose(got[:3], want, rtol=0, atol=1e-9) and np.isnan(got[3])
    assert np.isnan(CL.silhouette(df.limit(0), ["a", "b"], "g"))
    same = spark.createDataFrame([(0.1, 0.3, i % 2) for i in range(50)], "a double, b double, g int")
    assert CL.silhouette(same, ["a", "b"], "g") == 0.0
