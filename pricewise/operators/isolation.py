"""Isolation forest as a Spark job.

1. Sampling: each row joins tree t when hash(row_id, t) falls under a
   threshold sized for about ``1.25 * sample_size`` rows per tree. The
   (row, tree) pairs are generated by a filtered array, so only sampled pairs
   ever exist - the table is never copied once per tree.
2. Growing: ``groupBy(tree_id).applyInPandas`` keeps the ``sample_size``
   rows with the smallest hash and grows one isolation tree per group
   (bounded: sample_size rows each).
3. Scoring: the forest (trees x at most 2*sample_size nodes - a size set by
   parameters, not by the data) is broadcast as node arrays; chunks of rows
   walk down each tree together by numpy.
4. Flag: score above its exact (1 - contamination) quantile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.session import cut_lineage
from pricewise.sources.tables import quote

N_TREES = 100
SAMPLE_SIZE = 256
CONTAMINATION = 0.05
SEED = 42
#: Rows that walk down a tree together.
CHUNK = 4096

TREE_SCHEMA = ("tree_id int, node int, feature int, threshold double, left_child int, right_child int, "
               "size long, depth int")


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Arrays describing one tree, nodes in creation order."""
    feat, thr, left, right, size, depth = [], [], [], [], [], []
    stack = [(np.arange(len(x)), 0, -1, False)]
    while stack:
        idx, d, parent, is_right = stack.pop()
        node = len(feat)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1)
        size.append(len(idx)); depth.append(d)
        if d >= max_depth or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            continue
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[node], thr[node] = f, t
        go_left = sub[:, f] < t
        stack.append((idx[~go_left], d + 1, node, True))
        stack.append((idx[go_left], d + 1, node, False))
    return feat, thr, left, right, size, depth


def grow_trees(sample: DataFrame, cols, sample_size: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """One tree per ``tree_id`` group of the sampled rows."""
    max_depth = int(math.ceil(math.log2(max(sample_size, 2))))
    cols = list(cols)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values(["_h", "row_id"]).head(sample_size)
        x = pdf[cols].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 1000003 + tid)
        feat, thr, left, right, size, depth = _grow(x, rng, max_depth)
        return pd.DataFrame({"tree_id": tid, "node": np.arange(len(feat), dtype=np.int32), "feature": feat,
                             "threshold": thr, "left_child": left, "right_child": right,
                             "size": np.asarray(size, dtype=np.int64), "depth": depth})

    return sample.groupBy("tree_id").applyInPandas(grow, TREE_SCHEMA)


def sample_for_trees(df: DataFrame, cols, n: int, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                     seed: int = SEED) -> DataFrame:
    """(tree_id, row_id, _h, features) for the rows each tree may sample."""
    frac = min(1.0, 1.25 * sample_size / max(n, 1))
    cut = int(frac * (2 ** 62))
    h = lambda t: F.pmod(F.xxhash64(F.col("row_id"), t, F.lit(seed)), F.lit(2 ** 62))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: h(t) < F.lit(cut))
    return (df.select("row_id", *cols, F.explode(trees).alias("tree_id"))
            .withColumn("_h", h(F.col("tree_id"))))


def packed_forest(spark, forest: pd.DataFrame) -> DataFrame:
    """One row: the trees as arrays of nodes. ``path`` is a node's depth plus the expected
    rest of the way for the rows it holds, which counts where a walk ends."""
    trees = []
    for _, g in forest.sort_values(["tree_id", "node"]).groupby("tree_id"):
        path = [float(d + c_factor(n)) for d, n in zip(g["depth"], g["size"])]
        trees.append((g["feature"].tolist(), g["threshold"].tolist(), g["left_child"].tolist(), g["right_child"].tolist(), path, int(g["depth"].max())))
    return spark.createDataFrame([(trees,)], "forest array<struct<feature: array<int>, threshold: array<double>, left: array<int>, right: array<int>, path: array<double>, depth: int>>")


def forest_arrays(forest: pd.DataFrame) -> list[tuple]:
    """The trees as (feature, threshold, children, path, depth). ``children`` holds a node's
    right child at 2 * node and the left one after it, a leaf being its own child; ``path`` is
    a node's depth plus the expected rest of the way for the rows it holds, which counts where
    a walk ends."""
    trees = []
    for _, g in forest.sort_values(["tree_id", "node"]).groupby("tree_id"):
        feature, own = g["feature"].to_numpy(np.int64), np.arange(len(g))
        kids = [np.where(feature < 0, own, g[c].to_numpy(np.int64)) for c in ("right_child", "left_child")]
        path = np.array([float(d + c_factor(n)) for d, n in zip(g["depth"], g["size"])])
        trees.append((np.maximum(feature, 0), g["threshold"].to_numpy(float), np.stack(kids, axis=1).ravel(), path, int(g["depth"].max())))
    return trees


def _native_paths(df: DataFrame, cols, forest: pd.DataFrame) -> DataFrame:
    """(row_id, __total): summed paths, every row walking by higher-order functions."""
    x = F.array(*(F.col(quote(c)).cast("double") for c in cols))
    n_trees = max(forest["tree_id"].nunique(), 1)

    def end(tree):
        def step(node, _):
            feature = F.get(tree["feature"], node)
            below = F.get(F.col("__x"), feature) < F.get(tree["threshold"], node)
            # a null or not-a-number goes right, as a value that is not below
            return F.when(feature < 0, node).when(below, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
        return F.aggregate(F.sequence(F.lit(0), tree["depth"]), F.lit(0), step)

    total = F.aggregate("forest", F.lit(0.0), lambda a, t: a + F.get(t["path"], end(t)))
    rows = df.select("row_id", x.alias("__x")).crossJoin(F.broadcast(packed_forest(df.sparkSession, forest)))
    return rows.select(F.col("row_id").cast("long").alias("row_id"), total.alias("__total"))


def _chunk_paths(df: DataFrame, cols, forest: pd.DataFrame) -> DataFrame:
    """(row_id, __total): summed paths, chunks of rows walking down each tree together."""
    held = df.sparkSession.sparkContext.broadcast(forest_arrays(forest))
    dims, chunk = len(cols), CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                n = part.num_rows
                # a null or not-a-number is not below and goes right
                x = np.concatenate([part.column(1 + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(dims)])
                row, total = np.arange(n), np.zeros(n)
                for feature, threshold, kids, path, depth in held.value:
                    place, node = feature * n, np.zeros(n, np.int64)
                    for _ in range(depth):
                        below = x.take(place.take(node) + row) < threshold.take(node)
                        node = kids.take(2 * node + below)
                    total += path.take(node)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total)], names=["row_id", "__total"])

    rows = df.select(F.col("row_id").cast("long").alias("row_id"), *(F.col(quote(c)).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)))
    return rows.mapInArrow(run, "row_id long, __total double")


def score_rows(df: DataFrame, cols, forest: pd.DataFrame, sample_size: int = SAMPLE_SIZE, native: bool = True) -> DataFrame:
    """Anomaly score 2^(-E[h(x)] / c(sample_size)) per row: every row walks down every tree;
    the forest is broadcast, of bounded size. Natively without Python, which suits few rows,
    or by chunks of rows in numpy with the same scores at a fraction of the time."""
    n_trees = max(forest["tree_id"].nunique(), 1)
    paths = (_native_paths if native else _chunk_paths)(df, cols, forest)
    score = F.pow(F.lit(2.0), -(F.col("__total") / n_trees) / F.lit(c_factor(sample_size)))
    return paths.select("row_id", score.alias("isolation_score"))


def isolation_outliers(df: DataFrame, cols, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                       contamination: float = CONTAMINATION, seed: int = SEED) -> DataFrame:
    """(row_id, isolation_score, isolation_raw_outlier) for every row of ``df``
    (which needs ``row_id`` and numeric, already imputed/scaled ``cols``)."""
    n = df.count()
    sample = sample_for_trees(df, cols, n, n_trees, sample_size, seed)
    forest = grow_trees(sample, cols, sample_size, seed).toPandas()  # n_trees * <= 2*sample_size rows
    # the scores feed the quantile and the result: write them once
    scored = cut_lineage(score_rows(df, cols, forest, sample_size, native=False), "isolation_scores")
    from pricewise.operators.quantiles import quantile_row
    q = quantile_row(scored, "isolation_score", [1.0 - contamination], "_qs").select(F.col("_qs")[0].alias("_q"))
    return (scored.crossJoin(F.broadcast(q))
            .withColumn("isolation_raw_outlier", F.col("isolation_score") > F.col("_q")).drop("_q"))
