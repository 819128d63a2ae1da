"""Random forests of deep trees: nodes of many rows are split by distributed sums, the
subtrees below them grow inside tasks.

Equal rows are counted once with their number, features binned to bytes and kept as blocks.
A row's weight in a tree is a Poisson draw from a hash of the whole row and the tree, the
features that a node may split on a draw from (tree, node): nothing depends on
partitions or on the order of tasks. Targets are rounded to a grid that makes all sums exact.

1. While a node has more than ``SMALL_ROWS`` rows, a pass sums (rows, targets) by
   (tree, node, feature, bin); the sums meet by node and the best split is chosen there.
   The driver gets one row per such node, about trees x rows / SMALL_ROWS in all.
2. Every block then sends its rows to the (tree, node) they arrive at, and each such group,
   at most SMALL_ROWS rows, grows its subtree level by level in one task.
3. Subtrees stay a table in the shared folder. Scoring walks rows through the upper nodes,
   meets them by (tree, node) with their subtrees, ``SCORE_ROWS`` rows at a time, and averages
   over the trees. Neither side is ever broadcast.

Splits are those of MLlib's forests: largest decrease of variance, a third of the features
per node (all for one tree), both children with ``min_rows`` rows or more; a leaf is the mean
of its rows. Missing values rank above every number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.operators.boosting import quantile_cuts
from pricewise.session import cut_lineage
from pricewise.sources.tables import quote

#: A node of at most this many rows, repeats counted, grows on in one task.
SMALL_ROWS = 1 << 15
BLOCK_ROWS = 1 << 13
#: Rows that are scored in one group at most, or about; a larger table is dealt to several.
SCORE_ROWS = 1 << 19
#: Cells of sums that one step of a task holds.
CELLS = 1 << 21
#: Leaf values are kept as whole numbers, this much finer than the grid of the targets.
FINER = 1024
SUBTREE = ("feature", "bin", "left", "right", "value")


@dataclass(frozen=True)
class Forest:
    """Parameters of a fit."""
    trees: int = 220
    depth: int = 18
    min_rows: int = 2
    rows: float = 1.0
    bins: int = 32
    seed: int = 42


def feature_cuts(df: DataFrame, features, bins: int) -> list[np.ndarray]:
    """Ascending cuts of every feature, a value goes left up to its cut: halfway between the
    values of a feature that has at most ``bins`` of them, exact quantiles otherwise."""
    pairs = F.array(*(F.struct(F.lit(i).alias("pos"), F.col(quote(f)).cast("double").alias("val")) for i, f in enumerate(features)))
    values = df.select(F.inline(pairs)).where(F.col("val").isNotNull() & ~F.isnan("val")).distinct()
    values = cut_lineage(values, "forest_values")
    few = values.groupBy("pos").count().where(F.col("count") <= bins).select("pos")
    held: dict[int, list[float]] = {}
    for r in values.join(F.broadcast(few), "pos").collect():  # at most ``bins`` per feature
        held.setdefault(r.pos, []).append(r.val)
    seen = {r.pos for r in values.select("pos").distinct().collect()}
    many = [i for i in range(len(features)) if i in seen and i not in held]
    cuts = [np.zeros(0)] * len(features)
    for i, c in zip(many, quantile_cuts(df, [features[i] for i in many], bins) if many else []):
        cuts[i] = c
    for i, v in held.items():
        v = np.array(sorted(v))
        cuts[i] = np.append(v[:-1] + (v[1:] - v[:-1]) / 2, v[-1])  # above the last are only missing ones
    return cuts


# --- work inside tasks -----------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _uniform(key: np.ndarray, *numbers: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        for n in numbers:
            key = _mixed(key + np.uint64((n + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return (key >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def bag(key: np.ndarray, copies: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """How often a tree sees each row: Poisson with mean share x copies."""
    mean, out, turn = share * copies, np.zeros(len(key), np.int64), 0
    while len(todo := np.flatnonzero(mean > 0)):
        part = np.minimum(mean[todo], 256.0)  # a sum of Poisson draws is one
        u = _uniform(key[todo], seed, tree, turn)
        p = np.exp(-part)
        total, k = p.copy(), 0
        while (more := u > total).any() and k < 1024:
            k += 1
            p = p * part / k
            total = total + p
            out[todo[more]] += 1
        mean[todo] -= part
        turn += 1
    return out


def node_features(tree: int, nodes: np.ndarray, n_features: int, m: int, seed: int) -> np.ndarray:
    """The features each node may split on, ascending: (nodes, m)."""
    if m == n_features:
        return np.tile(np.arange(n_features), (len(nodes), 1))
    key = _mixed(nodes.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))
    draw = _uniform((key[:, None] + np.arange(n_features, dtype=np.uint64)[None] * np.uint64(0xA0761D6478BD642F)), seed, tree)
    return np.sort(np.argsort(draw, axis=1, kind="stable")[:, :m], axis=1)


def best_splits(slot, bins, weight, target, cols, width: int, min_rows: int):
    """(feature or -1, bin, gain, rows left, target left) of each slot from its rows' bins;
    ``slot`` ascends, ``target`` is already times ``weight``. ``cols`` has each slot's features."""
    n, m = cols.shape
    flat = ((slot[:, None] * m + np.arange(m)) * width + bins[np.arange(len(slot))[:, None], cols[slot]]).ravel()
    rows = np.bincount(flat, np.repeat(weight, m).astype(np.float64), n * m * width)
    sums = np.bincount(flat, np.repeat(target, m), n * m * width)
    return best_of_sums(rows, sums, cols, width, min_rows)


def best_of_sums(rows, sums, cols, width: int, min_rows: int):
    """See ``best_splits``; from sums by (slot, feature, bin). Only bins with rows are looked at."""
    n, m = cols.shape
    feature, cut, gain = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n)
    left_rows, left_sum = np.zeros(n), np.zeros(n)
    cell = np.flatnonzero(rows)
    if not len(cell):
        return feature, cut, gain, left_rows, left_sum
    part = cell // width  # slot and feature
    head = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    size = np.diff(np.append(head, len(cell)))
    run_rows, run_sum = np.cumsum(rows[cell]), np.cumsum(sums[cell])
    before_rows, before_sum = run_rows[head] - rows[cell][head], run_sum[head] - sums[cell][head]
    nl, gl = run_rows - np.repeat(before_rows, size), run_sum - np.repeat(before_sum, size)
    n_all = np.repeat(run_rows[head + size - 1] - before_rows, size)
    g_all = np.repeat(run_sum[head + size - 1] - before_sum, size)
    nr = n_all - nl
    off = gl - nl * (g_all / n_all)  # how far the left sum is from its share
    good = (nl >= min_rows) & (nr >= min_rows) & (np.abs(off) > 2)
    here = np.flatnonzero(good)
    if not len(here):
        return feature, cut, gain, left_rows, left_sum
    score = off[here] ** 2 * (1 / nl[here] + 1 / nr[here])
    slot = part[here] // m
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
    best = np.maximum.reduceat(score, first)
    hit = np.flatnonzero(score == np.repeat(best, np.diff(np.append(first, len(slot)))))
    hit = hit[np.append(True, slot[hit][1:] != slot[hit][:-1])]  # the first of equal ones
    at, s = here[hit], slot[hit]
    feature[s], cut[s], gain[s] = cols[s, part[at] % m], cell[at] % width, score[hit]
    left_rows[s], left_sum[s] = nl[at], gl[at]
    return feature, cut, gain, left_rows, left_sum


def grow(tree: int, root: int, bins, weight, target, p: Forest, m: int, width: int):
    """The subtree of a node as arrays (SUBTREE, the root first; a leaf is its own child) and
    the gain of each feature. ``root`` is a node's number as in a heap."""
    feature, cut, left, right, value = [], [], [], [], []
    importance = np.zeros(bins.shape[1])
    names = np.array([root], np.uint64)
    rows = np.array([float(weight.sum())])
    sums = np.array([float((weight * target).sum())])
    slot, base = np.zeros(len(weight), np.int64), 0
    level = int(root).bit_length() - 1
    while len(names):
        n = len(names)
        order = np.argsort(slot, kind="stable")
        slot, bins, weight, target = slot[order], bins[order], weight[order], target[order]
        f, b, gain = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n)
        nl, gl = np.zeros(n), np.zeros(n)
        step = max(1, CELLS // (m * width))
        for lo in range(0, n if level < p.depth else 0, step):
            hi = min(n, lo + step)
            i, j = np.searchsorted(slot, [lo, hi])
            cols = node_features(tree, names[lo:hi], bins.shape[1], m, p.seed)
            f[lo:hi], b[lo:hi], gain[lo:hi], nl[lo:hi], gl[lo:hi] = best_splits(
                slot[i:j] - lo, bins[i:j], weight[i:j], weight[i:j] * target[i:j], cols, width, p.min_rows)
        split = np.flatnonzero(f >= 0)
        child = base + n + 2 * np.arange(len(split))
        lefts, rights = base + np.arange(n), base + np.arange(n)
        lefts[split], rights[split] = child, child + 1
        feature.append(np.maximum(f, 0)); cut.append(b); left.append(lefts); right.append(rights)
        value.append(np.rint(sums / np.maximum(rows, 1) * FINER).astype(np.int64))
        np.add.at(importance, f[split], gain[split])
        place = np.full(n, -1, np.int64)
        place[split] = 2 * np.arange(len(split))
        keep = place[slot] >= 0
        slot, bins, weight, target = slot[keep], bins[keep], weight[keep], target[keep]
        slot = place[slot] + (bins[np.arange(len(slot)), f[slot]] > b[slot])
        names = (np.repeat(names[split], 2) * np.uint64(2)) + np.tile(np.array([0, 1], np.uint64), len(split))
        rows, sums = (np.column_stack([x[split], y[split] - x[split]]).ravel() for x, y in ((nl, rows), (gl, sums)))
        base, level = base + n, level + 1
    return [np.concatenate(x) for x in (feature, cut, left, right, value)], importance


def walk(feature, cut, left, right, bins: np.ndarray, depth: int) -> np.ndarray:
    node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = np.where(bins[at, feature[node]] > cut[node], right[node], left[node])
    return node


# --- the upper part of a tree, on the driver -----------------------------------------

class Top:
    """Split nodes of many rows, by heap number: (feature, bin). ``leaves`` are nodes of many
    rows that are not split."""

    def __init__(self):
        self.splits: dict[int, tuple[int, int]] = {}
        self.leaves: dict[int, int] = {}

    def arrays(self):
        """feature, bin, left, right, heap number of each place, and the depth."""
        order = [1]
        for v in order:
            if v in self.splits:
                order += [2 * v, 2 * v + 1]
        at = {v: i for i, v in enumerate(order)}
        f, b, left, right = (np.array(x, np.int64) for x in zip(*(
            (*self.splits[v], at[2 * v], at[2 * v + 1]) if v in self.splits else (0, 0, i, i) for v, i in at.items())))
        return f, b, left, right, np.array(order, np.int64), max(v.bit_length() for v in order) - 1


def _blocks(df: DataFrame, features, cuts, extra: list[Column], types: list[np.dtype], names: list[str]) -> DataFrame:
    """Rows of up to BLOCK_ROWS table rows: ``n``, ``bins`` and the ``extra`` columns as bytes."""
    nf, ne, block_rows = len(features), len(extra), BLOCK_ROWS
    cols = [*(c.alias(f"e{i}") for i, c in enumerate(extra)), *(F.col(quote(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                b = np.empty((part.num_rows, nf), np.uint8)
                for i in range(nf):
                    b[:, i] = np.searchsorted(cuts[i], part.column(ne + i).to_numpy(zero_copy_only=False).astype(np.float64), side="left")
                held = [part.column(i).to_numpy(zero_copy_only=False).astype(t).tobytes() for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), *(pa.array([x], pa.binary()) for x in (b.tobytes(), *held))],
                                                 names=["n", "bins", *names])

    return df.select(*cols).mapInArrow(run, "n int, bins binary, " + ", ".join(f"{c} binary" for c in names))


def _routed(blocks: DataFrame, tops, nf: int, weights=None, parts: int = 1) -> DataFrame:
    """(tree, node, part, bins, one or two columns of bytes): the rows of each block by the node
    at which they leave a tree's upper part. With ``weights`` (seed, share), for a fit, rows
    a tree does not see and those in known leaves are left out. Without, blocks are dealt to ``parts``."""
    packed = blocks.sparkSession.sparkContext.broadcast([(*t.arrays(), np.array(sorted(t.leaves), np.int64)) for t in tops])
    names = ["weight", "target"] if weights else ["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint8).reshape(r["n"], nf)
                if weights:
                    key, copies, target = (np.frombuffer(r[c], t) for c, t in (("key", np.uint64), ("copies", np.int64), ("target", np.float64)))
                else:
                    ids = np.frombuffer(r["id"], np.int64)
                own = 0 if weights else int(_mixed(ids[:1].view(np.uint64) + np.uint64(1))[0] % np.uint64(parts))
                for tree, (f, b, left, right, number, depth, leaves) in enumerate(packed.value):
                    w = bag(key, copies, tree, *weights) if weights else None
                    rows = np.flatnonzero(w) if weights else np.arange(r["n"])
                    end = number[walk(f, b, left, right, bins[rows], depth)]
                    if weights and len(leaves):
                        more = ~np.isin(end, leaves)
                        rows, end = rows[more], end[more]
                    order = np.argsort(end, kind="stable")
                    groups = [rows[x] for x in np.split(order, np.flatnonzero(np.diff(end[order])) + 1)] if len(rows) else []
                    cols = [[bins[at].tobytes() for at in groups]]
                    cols += [[w[at].astype(np.int32).tobytes() for at in groups], [target[at].tobytes() for at in groups]] if weights else [[ids[at].tobytes() for at in groups]]
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(groups), pa.int32()), pa.array(np.unique(end)), pa.array([own] * len(groups), pa.int32()),
                                                      *(pa.array(c, pa.binary()) for c in cols)], names=["tree", "node", "part", "bins", *names])

    return blocks.mapInArrow(run, "tree int, node long, part int, bins binary, " + ", ".join(f"{c} binary" for c in names))


def _top_splits(blocks: DataFrame, tops, asked: dict[int, list[int]], nf: int, m: int, width: int, p: Forest):
    """Best splits of the ``asked`` nodes, one row each: sums of tasks meet by node."""
    held = blocks.sparkSession.sparkContext.broadcast([(tree, tops[tree].arrays(), np.array(nodes, np.int64)) for tree, nodes in asked.items()])
    name = "tree int, node long, "

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint8).reshape(r["n"], nf)
                key, copies, target = (np.frombuffer(r[c], t) for c, t in (("key", np.uint64), ("copies", np.int64), ("target", np.float64)))
                for tree, (f, b, left, right, number, depth), nodes in held.value:
                    w = bag(key, copies, tree, p.seed, p.rows)
                    end = number[walk(f, b, left, right, bins, depth)]
                    slot = np.minimum(np.searchsorted(nodes, end), len(nodes) - 1)
                    use = np.flatnonzero((w > 0) & (nodes[slot] == end))
                    cols = node_features(tree, nodes, nf, m, p.seed)
                    flat = ((slot[use, None] * m + np.arange(m)) * width + bins[use[:, None], cols[slot[use]]]).ravel()
                    size = len(nodes) * m * width
                    add = np.stack([np.bincount(flat, np.repeat(w[use], m).astype(np.float64), size), np.bincount(flat, np.repeat(w[use] * target[use], m), size)])
                    total[tree] = total[tree] + add if tree in total else add
        for tree, _, nodes in held.value:
            if tree in total:
                each = total[tree].reshape(2, len(nodes), -1)
                for k, node in enumerate(nodes.tolist()):
                    yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([each[:, k].tobytes()], pa.binary())],
                                                     names=["tree", "node", "sums"])

    def choose(group: pa.Table) -> pa.Table:
        tree, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        rows, targets = sum(np.frombuffer(x.as_py(), np.float64).reshape(2, -1) for x in group.column("sums"))
        cols = node_features(tree, np.array([node]), nf, m, p.seed)
        f, b, gain, nl, gl = (x[0] for x in best_of_sums(rows, targets, cols, width, p.min_rows))
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), "feature": pa.array([f], pa.int32()),
                         "bin": pa.array([b], pa.int32()), "gain": [float(gain)], "left_rows": [float(nl)], "left_sum": [float(gl)],
                         "all_rows": [float(rows[:width].sum())], "all_sum": [float(targets[:width].sum())]})

    return blocks.mapInArrow(sums, name + "sums binary").groupBy("tree", "node").applyInArrow(
        choose, name + "feature int, bin int, gain double, left_rows double, left_sum double, all_rows double, all_sum double").collect()


@dataclass
class ForestModel:
    """A fitted forest; takes the place of a fitted pipeline (``transform`` adds ``pred_t``).
    ``subtrees`` is a table of the shared folder."""
    features: list[str]
    cuts: list[np.ndarray]
    tops: list[Top]
    subtrees: DataFrame
    middle: float
    scale: float
    gains: np.ndarray  # by tree and feature

    @property
    def stages(self):
        return [self]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name MLlib's models use
        """Mean over the trees of each feature's share in the gain of a tree's splits."""
        whole = self.gains.sum(axis=1, keepdims=True)
        share = np.divide(self.gains, whole, out=np.zeros_like(self.gains), where=whole > 0).sum(axis=0)
        return DenseVector(share / share.sum() if share.sum() > 0 else share)

    def transform(self, df: DataFrame) -> DataFrame:
        nf, n_trees = len(self.features), len(self.tops)
        base = cut_lineage(df.withColumn("__id", F.monotonically_increasing_id()), "forest_rows")
        blocks = _blocks(base, self.features, self.cuts, [F.col("__id")], [np.int64], ["id"])
        n = base.count()
        parts = max(1, math.ceil(n / SCORE_ROWS))
        keys = ["tree", "node", "part"]
        spread = max(8 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(n * n_trees * (nf + 8) / (1 << 26)))
        sent = _routed(blocks, self.tops, nf, parts=parts).repartition(spread, *keys)
        grown = self.subtrees.drop("importance").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(spread, *keys)

        def run(rows: pa.Table, subtree: pa.Table) -> pa.Table:
            if not rows.num_rows or not subtree.num_rows:
                return pa.table({"__id": pa.array([], pa.int64()), "value": pa.array([], pa.int64())})
            f, b, left, right, value = (np.frombuffer(subtree.column(c)[0].as_py(), np.int64 if c == "value" else np.int32) for c in SUBTREE)
            bins, ids = (b"".join(x.as_py() for x in rows.column(c)) for c in ("bins", "id"))
            end = walk(f, b, left, right, np.frombuffer(bins, np.uint8).reshape(-1, nf), subtree.column("depth")[0].as_py())
            return pa.table({"__id": pa.array(np.frombuffer(ids, np.int64)), "value": pa.array(value[end])})

        # a block's file says nothing about the rows that its trees make of it, and that of the table little: no side is broadcast
        found = sent.groupBy(*keys).cogroup(grown.groupBy(*keys)).applyInArrow(run, "__id long, value long").groupBy("__id").agg(F.sum("value").alias("__v"))
        pred = F.col("__v") / F.lit(float(n_trees) * FINER * self.scale) + F.lit(self.middle)
        return base.join(found.hint("merge"), "__id").withColumn("pred_t", pred).drop("__id", "__v")

    def write(self, path: str) -> dict:
        """Writes the subtrees to ``path``; returns what else ``read_forest`` needs, as plain values."""
        self.subtrees.write.mode("overwrite").parquet(path)
        return {"features": self.features, "cuts": [c.tolist() for c in self.cuts], "middle": self.middle, "scale": self.scale, "gains": self.gains.tolist(),
                "tops": [[[v, *s] for v, s in t.splits.items()] for t in self.tops], "leaves": [list(t.leaves.items()) for t in self.tops]}


def read_forest(subtrees: DataFrame, held: dict) -> ForestModel:
    tops = [Top() for _ in held["tops"]]
    for top, splits, leaves in zip(tops, held["tops"], held["leaves"]):
        top.splits, top.leaves = {v: (f, b) for v, f, b in splits}, dict(leaves)
    return ForestModel(held["features"], [np.array(c) for c in held["cuts"]], tops, subtrees, held["middle"], held["scale"], np.array(held["gains"]))


def fit_forest(train: DataFrame, features, target: Column, p: Forest, key: str = "row_id") -> ForestModel:
    """One forest on the rows of ``train``; a target that is no finite number is refused."""
    features = list(features)
    nf = len(features)
    m = nf if p.trees == 1 else math.ceil(nf / 3)
    keys = [F.col(key)] if key in train.columns else []
    cols = [F.col(quote(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    rows = train.select(*[k.alias("k") for k in keys], *cols, target.cast("double").alias("y"))
    rows = cut_lineage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "forest_train")
    y = F.col("y")
    bad = y.isNull() | F.isnan("y") | (F.abs("y") == float("inf"))
    s = rows.agg(F.sum("copies").alias("n"), F.count_if(bad).alias("bad"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if not s.n:
        raise ValueError("no row to fit on")
    if s.bad:
        raise ValueError("labels must not be null, not-a-number or infinite")
    names = [f"x{i}" for i in range(nf)]
    cuts = feature_cuts(rows, names, p.bins)
    width = max(len(c) for c in cuts) + 1
    middle = s.low + (s.high - s.low) / 2
    reach = max(s.high - middle, middle - s.low)
    # sums of 8 times the rows' weights stay whole numbers in a double
    scale = 2.0 ** math.floor(52 - math.log2(max(8 * s.n * p.rows, 1 << 20) * reach)) if reach > 0 else 1.0
    whole = F.xxhash64(*(["k"] if keys else []), *names, "y")
    cores = train.sparkSession.sparkContext.defaultParallelism
    blocks = _blocks(rows, names, cuts, [whole, F.col("copies"), F.rint((y - F.lit(middle)) * F.lit(scale))],
                     [np.int64, np.int64, np.float64], ["key", "copies", "target"])
    blocks = cut_lineage(blocks.repartition(max(2 * cores, s.n // (64 * BLOCK_ROWS))), "forest_blocks")
    tops = [Top() for _ in range(p.trees)]
    gains = np.zeros((p.trees, nf))
    asked = {t: [1] for t in range(p.trees)} if s.n * p.rows > SMALL_ROWS and p.depth > 0 else {}
    while asked:
        following: dict[int, list[int]] = {}
        for r in _top_splits(blocks, tops, asked, nf, m, width, p):
            top = tops[r.tree]
            if r.all_rows <= SMALL_ROWS:
                continue  # grows on in a task
            if r.feature < 0:
                top.leaves[r.node] = round(r.all_sum / r.all_rows * FINER)
                continue
            top.splits[r.node] = (r.feature, r.bin)
            gains[r.tree, r.feature] += r.gain
            for child, size, total in ((2 * r.node, r.left_rows, r.left_sum), (2 * r.node + 1, r.all_rows - r.left_rows, r.all_sum - r.left_sum)):
                if size > SMALL_ROWS and child.bit_length() <= p.depth:
                    following.setdefault(r.tree, []).append(child)
                elif size > SMALL_ROWS:
                    top.leaves[child] = round(total / size * FINER)
        asked = {t: sorted(v) for t, v in following.items()}

    def subtree(group: pa.Table) -> pa.Table:
        tree, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        joined = [b"".join(x.as_py() for x in group.column(c)) for c in ("bins", "weight", "target")]
        arrays, importance = grow(tree, node, np.frombuffer(joined[0], np.uint8).reshape(-1, nf), np.frombuffer(joined[1], np.int32).astype(np.float64),
                                  np.frombuffer(joined[2], np.float64), p, m, width)
        held = {c: pa.array([x.astype(np.int64 if c == "value" else np.int32).tobytes()], pa.binary()) for c, x in zip(SUBTREE, arrays)}
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), **held,
                         "depth": pa.array([p.depth - node.bit_length() + 1], pa.int32()), "importance": pa.array([importance.tolist()], pa.list_(pa.float64()))})

    schema = "tree int, node long, " + ", ".join(f"{c} binary" for c in SUBTREE) + ", depth int, importance array<double>"
    spread = max(8 * cores, math.ceil(s.n * p.rows * p.trees * (nf + 12) / (1 << 26)))
    sent = _routed(blocks, tops, nf, (p.seed, p.rows)).repartition(spread, "tree", "node")
    zero = np.zeros(1, np.int32).tobytes()
    leaves = [(t, v, zero, zero, zero, zero, np.array([x], np.int64).tobytes(), 0, [0.0] * nf) for t, top in enumerate(tops) for v, x in top.leaves.items()]
    grown = sent.groupBy("tree", "node").applyInArrow(subtree, schema)
    subtrees = cut_lineage(grown.unionByName(train.sparkSession.createDataFrame(leaves, schema)) if leaves else grown, "forest_subtrees")
    per_tree = subtrees.select("tree", F.posexplode("importance").alias("i", "v")).groupBy("tree", "i").agg(F.sum("v").alias("v"))
    for r in per_tree.collect():  # trees x features
        gains[r.tree, r.i] += r.v
    return ForestModel(features, cuts, tops, subtrees, middle, scale, gains)
