"""Boosted regression trees on histograms of binned features, many fits at a time.

Features are binned once by exact quantiles of all rows and kept as blocks of bytes. A
pass over the blocks sums, for every fit that is still growing, the gradients and row
counts by (node, feature, bin), each feature with the bins it has. Tasks' sums are added up by
fit on the executors and arrive once; all splits are chosen from them on the driver, so what it
gets and holds depends on nodes and bins and never on rows or tasks. Fits that share the table
(folds, targets, parameter sets) advance in the same passes, so a cross-validation takes
the Spark jobs of its slowest fit.

- **leaf-wise** trees split the leaf of the highest gain first. A pass opens the leaf in
  turn and, ahead of their turn, the other known leaves of the highest gains, so a tree
  takes about as many passes as it is deep and equals one grown a leaf at a time.
- **symmetric** trees split all leaves of a level alike; such a tree is a list of
  comparisons whose answers are the bits of an index into its leaves.

Only the smaller child of a split is summed; its sibling is the parent less the child.

A table of at most LOCAL_BYTES bytes of bins needs no passes: every fit grows in a task of its
own from the whole of the blocks, which are broadcast. Sums are exact, so both ways give the
same trees.

Gradients of the squared loss are rounded to a grid that makes every sum exact in a double,
so a fit doesn't depend on how rows are partitioned or in which order tasks end. Rows and
features of a round are sampled by hashes of the row key and the round.

Every CHECKPOINT_ROUNDS rounds the running predictions are checkpointed in the shared
folder; a lost executor costs the rounds since then at most.

Rows whose target is null or not finite are left out of the fit. A null or not-a-number
feature ranks above every number. A fit without a row predicts not-a-number.
A fit that sees all rows and features and finds no split ends early.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.operators.quantiles import exact_quantiles
from pricewise.session import cut_lineage, ensure_checkpoint_dir
from pricewise.sources.tables import quote

BLOCK_ROWS = 8192
CHECKPOINT_ROUNDS = 50
#: Bytes of bins, over all fits, from which a pass uses a further task, up to one a core.
TASK_BYTES = 1 << 21
#: Bytes of bins that a task holds at most, however few the cores.
MOST_BYTES = 1 << 24
#: Bytes of bins up to which a fit grows in one task; rows summed there at a time.
LOCAL_BYTES = 1 << 24
LOCAL_ROWS = 1 << 15
#: Sums of more partitions than this are added up before they are sent to the driver.
DIRECT_PARTITIONS = 1


@dataclass(frozen=True)
class Boost:
    """Parameters of a fit. ``leaves`` bounds leaf-wise trees, ``depth`` symmetric ones."""
    rounds: int = 450
    rate: float = 0.045
    shape: str = "leafwise"  # leafwise | symmetric
    leaves: int = 31
    depth: int = 8
    min_rows: int = 20
    l2: float = 0.0
    rows: float = 1.0
    columns: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Run:
    """One fit: its parameters, the target's name and the fold it must not see (or None)."""
    params: Boost
    target: str
    left_out: int | None = None


@dataclass
class Tree:
    """Nodes as arrays, the root first; a leaf is its own child. ``cut`` is the value that a
    feature must exceed to go right, ``bin`` the same in bins."""
    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int


@dataclass
class BoostedModel:
    """A fitted model; takes the place of a fitted pipeline (``transform`` adds ``pred_t``)."""
    features: list[str]
    start: float
    trees: list[Tree] = field(default_factory=list)
    symmetric: bool = False

    @property
    def stages(self):
        return [self]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name MLlib's models use
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            np.add.at(total, t.feature, t.gain)
        whole = total.sum()
        return DenseVector(total / whole if whole > 0 else total)

    def transform(self, df: DataFrame) -> DataFrame:
        return score(df, {"pred_t": {None: self}})


# --- bins and blocks -----------------------------------------------------------

def quantile_cuts(df: DataFrame, features, bins: int = 64) -> list[np.ndarray]:
    """Ascending cuts of every feature: its exact quantiles at multiples of 1/bins, without
    repeats. Above the last, the largest value, are only missing ones. At most ``bins`` each."""
    if not 1 <= bins <= 255:
        raise ValueError("bins must be 2 to 256, they are kept as bytes")
    features = list(features)
    pairs = F.array(*(F.struct(F.lit(i).alias("_pos"), F.col(quote(f)).cast("double").alias("_val")) for i, f in enumerate(features)))
    qs = [i / bins for i in range(1, bins)] + [1.0]
    found = exact_quantiles(df.select(F.inline(pairs)), "_val", qs, ["_pos"])
    cuts: list[np.ndarray] = [np.zeros(0)] * len(features)
    for r in found.groupBy("_pos").agg(F.collect_set("value").alias("v")).collect():
        cuts[r._pos] = np.array(sorted(r.v))
    return cuts


def binned_blocks(df: DataFrame, features, targets: dict[str, Column], cuts, fold: Column | None = None, key: str = "row_id") -> DataFrame:
    """Rows of up to BLOCK_ROWS table rows: bins (bytes, row by row), folds, hashed row keys
    and targets as binary arrays. Rows stay in their partitions."""
    features = list(features)
    nf, nt = len(features), len(targets)
    cols = [F.xxhash64(F.col(key)).alias("k"), (F.lit(-1) if fold is None else F.coalesce(fold, F.lit(-1))).cast("int").alias("j"),
            *(t.cast("double").alias(f"t{i}") for i, t in enumerate(targets.values())),
            *(F.col(quote(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features))]
    block_rows = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                n = part.num_rows

                def numbers(i):
                    return part.column(i).to_numpy(zero_copy_only=False).astype(np.float64)

                b = np.empty((n, nf), np.uint8)
                for i in range(nf):
                    b[:, i] = np.searchsorted(cuts[i], numbers(2 + nt + i), side="left")
                y = np.vstack([numbers(2 + i) for i in range(nt)]) if nt else np.zeros((0, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (
                        b, part.column(1).to_numpy(zero_copy_only=False).astype(np.int32),
                        part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), y))],
                    names=["n", "bins", "fold", "key", "y"])

    return df.select(*cols).mapInArrow(run, "n int, bins binary, fold binary, key binary, y binary")


# --- work inside tasks -----------------------------------------------------------

def _walk(tree, bins: np.ndarray) -> np.ndarray:
    feature, cut, left, right, depth = tree
    node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = np.where(bins[at, feature[node]] > cut[node], right[node], left[node])
    return node


def _sampled(key: np.ndarray, round_no: int, seed: int, share: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = key ^ (np.uint64(round_no + 1) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.uint64(seed) << np.uint64(40))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)).astype(np.float64) < share * 2.0 ** 53


def _tasks(nf: int, nt: int, starts: list[float], widths: np.ndarray):
    """Functions that run in tasks; nested, so that they travel with the task."""
    import numpy as np

    def decode(row):
        n = row.n
        bins = np.frombuffer(row.bins, np.uint8).reshape(n, nf)
        y = np.frombuffer(row.y, np.float64).reshape(nt, n)
        margin = np.repeat(np.asarray(starts, np.float64)[:, None], n, axis=1)
        return bins, np.frombuffer(row.fold, np.int32), np.frombuffer(row.key, np.int64).view(np.uint64), y, margin

    def advance(trees):
        def run(block):
            bins, fold, key, y, margin = block
            margin = margin.copy()
            for i, (tree, value) in trees.items():
                margin[i] += value[_walk(tree, bins)]
            return bins, fold, key, y, margin
        return run

    def sums(wanted, round_no):
        """wanted: {fit: (target, left-out fold, scale, row share, seed, features, tree, slot of each node, slots)};
        yields (fit, sums by kind, slot and bin)."""
        def run(blocks):
            held = {}
            for bins, fold, key, y, margin in blocks:
                for i, (t, out, scale, share, seed, cols, tree, slot_of, slots) in wanted.items():
                    slot = slot_of[_walk(tree, bins)]
                    use = (slot >= 0) & np.isfinite(y[t])
                    if out is not None:
                        use &= fold != out
                    if share < 1.0:
                        use &= _sampled(key, round_no, seed, share)
                    use = np.flatnonzero(use)
                    if not len(use):
                        continue
                    g = np.rint((margin[i][use] - y[t][use]) * scale)
                    m = len(cols)
                    begin = np.cumsum(widths[cols])
                    whole, begin = int(begin[-1]), begin - widths[cols]
                    flat = (slot[use, None] * whole + begin + bins[use[:, None], cols]).ravel()
                    size = slots * whole
                    add = np.stack([np.bincount(flat, np.repeat(g, m), size), np.bincount(flat, minlength=size).astype(np.float64)])
                    held[i] = held[i] + add if i in held else add
            yield from held.items()
        return run

    return decode, advance, sums


# --- growing a tree from sums -----------------------------------------------------

class _Grower:
    """One tree: asks for the sums of nodes until its splits are known. Nodes are numbered
    as in a heap (root 1, children 2i and 2i + 1)."""

    def __init__(self, p: Boost, cols: np.ndarray, widths: np.ndarray):
        self.p, self.cols = p, cols
        own = widths[cols]
        self.ends = np.cumsum(own)
        self.begin, self.width = self.ends - own, int(own.max())
        self.place = np.repeat(np.arange(len(cols)) * self.width - self.begin, own) + np.arange(self.ends[-1])
        self.hist: dict[int, np.ndarray] = {}   # node -> (gradient, rows) by bin, column after column
        self.total: dict[int, tuple[float, float]] = {}
        self.split: dict[int, tuple[float, int, int]] = {}  # node -> (gain, column, bin)
        self.open: set[int] = set()  # nodes whose children are known

    def wants(self) -> list[int]:
        raise NotImplementedError

    def feed(self, sums: dict[int, np.ndarray]) -> None:
        raise NotImplementedError

    def _gains(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of both children, rows left, rows right) by (node, column, bin)."""
        even = np.zeros((*h.shape[:2], len(self.cols) * self.width))
        even[..., self.place] = h
        left = np.cumsum(even.reshape(*h.shape[:2], len(self.cols), self.width), axis=-1)
        right = left[..., -1:] - left
        gl, nl, gr, nr = left[:, 0], left[:, 1], right[:, 0], right[:, 1]
        return self._score(gl, nl) + self._score(gr, nr), nl, nr

    def _score(self, g, n):
        d = n + self.p.l2
        return np.divide(g * g, d, out=np.zeros_like(g), where=d > 0)

    def _column(self, node: int, c: int) -> np.ndarray:
        return self.hist[node][:, self.begin[c]: self.ends[c]]

    def _smaller(self, node: int) -> int:
        _, c, b = self.split[node]
        left = self._column(node, c)[1, : b + 1].sum()
        return 2 * node + (0 if 2 * left <= self.total[node][1] else 1)

    def _set_totals(self, node: int) -> None:
        _, c, b = self.split[node]
        g, n = self._column(node, c)
        self.total[2 * node] = (float(g[: b + 1].sum()), float(n[: b + 1].sum()))
        self.total[2 * node + 1] = (float(g[b + 1:].sum()), float(n[b + 1:].sum()))

    def _siblings(self, sums: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """The given nodes and, below the root, their siblings by subtraction."""
        out = {}
        for node, h in sums.items():
            out[node] = h
            if node > 1:
                out[node ^ 1] = self.hist[node // 2] - h
        return out

    def tree(self, splits, cuts, scale: float) -> Tree:
        """The tree of the given split nodes as arrays; values are those of the leaves."""
        order, depth = [1], 0
        for node in order:
            if node in splits:
                order += [2 * node, 2 * node + 1]
                depth = max(depth, node.bit_length())
        at = {node: i for i, node in enumerate(order)}
        size = len(order)
        t = Tree(np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.arange(size), np.arange(size), np.zeros(size), np.zeros(size), depth)
        for node, i in at.items():
            if node in splits:
                gain, c, b = self.split[node]
                f = int(self.cols[c])
                t.feature[i], t.bin[i], t.left[i], t.right[i], t.gain[i] = f, b, at[2 * node], at[2 * node + 1], gain / scale / scale
                t.cut[i] = cuts[f][b]
            else:
                g, n = self.total.get(node, (0.0, 0.0))
                t.value[i] = -self.p.rate * (g / scale) / (n + self.p.l2) if n + self.p.l2 > 0 else 0.0
        self.at = at
        return t


class _Leafwise(_Grower):
    def wants(self) -> list[int]:
        if not self.hist and not self.total:
            return [1]
        frontier, chosen, left = {1}, [], self.p.leaves - 1
        while left > 0 and frontier:
            best = max(frontier, key=lambda v: (self.split[v][0], -v))
            if self.split[best][0] <= 0:
                break
            if best not in self.open and left > 1:
                break
            chosen.append(best)
            frontier.remove(best)
            left -= 1
            if left:
                frontier |= {2 * best, 2 * best + 1}
        else:
            best = None
        if best is None or left == 0 or self.split[best][0] <= 0:
            self.splits = set(chosen)
            for node in chosen:
                if node not in self.open:
                    self._set_totals(node)
            return []
        closed = sorted((v for v, s in self.split.items() if v not in self.open and s[0] > 0), key=lambda v: (-self.split[v][0], v))
        asked = []
        for node in {best: 0, **dict.fromkeys(closed[:left])}:  # no more than ``left`` can be split
            self._set_totals(node)
            self.open.add(node)
            if max(self.total[2 * node][1], self.total[2 * node + 1][1]) < 2 * self.p.min_rows:
                self.split[2 * node] = self.split[2 * node + 1] = (-1.0, 0, 0)  # neither child can be split
                continue
            asked.append(self._smaller(node))
        return asked or self.wants()

    def feed(self, sums: dict[int, np.ndarray]) -> None:
        found = self._siblings(sums)
        nodes = list(found)
        h = np.stack([found[v] for v in nodes])
        if nodes == [1]:
            self.total[1] = tuple(float(v) for v in h[0, :, : self.ends[0]].sum(axis=1))
        gain, nl, nr = self._gains(h)
        whole = np.array([self._score(np.array(self.total[v][0]), np.array(self.total[v][1])) for v in nodes])
        gain = gain - whole[:, None, None]
        few = max(self.p.min_rows, 1)
        gain[(nl < few) | (nr < few)] = -1.0
        flat = gain.reshape(len(nodes), -1)
        best = flat.argmax(axis=1)
        for i, v in enumerate(nodes):
            c, b = divmod(int(best[i]), gain.shape[2])
            self.split[v] = (float(flat[i, best[i]]), c, b)
            self.hist[v] = found[v]
        for v in {v // 2 for v in nodes if v > 1}:
            self.hist.pop(v, None)


class _Symmetric(_Grower):
    def __init__(self, p: Boost, cols: np.ndarray, widths: np.ndarray):
        super().__init__(p, cols, widths)
        self.level, self.splits = [1], set()

    def wants(self) -> list[int]:
        if not self.total:
            return [1]
        if self.level is None:
            return []
        return [self._smaller(v // 2) for v in self.level if v % 2 == 0]

    def feed(self, sums: dict[int, np.ndarray]) -> None:
        found = self._siblings(sums)
        h = np.stack([found[v] for v in self.level])
        if self.level == [1]:
            self.total[1] = tuple(float(v) for v in h[0, :, : self.ends[0]].sum(axis=1))
        both, nl, nr = self._gains(h)
        before = sum(float(self._score(np.array(self.total[v][0]), np.array(self.total[v][1]))) for v in self.level)
        gain = both.sum(axis=0) - before
        gain[(nl.sum(axis=0) == 0) | (nr.sum(axis=0) == 0)] = -1.0
        best = int(gain.argmax())
        c, b = divmod(best, gain.shape[1])
        if gain[c, b] <= 0:
            self.level = None
            return
        self.hist = found
        for v in self.level:
            self.split[v] = (float(gain[c, b]) / len(self.level), c, b)
            self._set_totals(v)
        self.splits |= set(self.level)
        deeper = [w for v in self.level for w in (2 * v, 2 * v + 1)]
        self.level = deeper if deeper[0].bit_length() <= self.p.depth else None


# --- the fits ------------------------------------------------------------------------

def _sampled_columns(p: Boost, nf: int, round_no: int) -> np.ndarray:
    if p.columns >= 1.0:
        return np.arange(nf)
    keep = max(1, round(p.columns * nf))
    return np.sort(np.random.default_rng([p.seed, round_no]).permutation(nf)[:keep])


def _digits(v: float) -> float:
    return float(f"{v:.12g}")  # a mean does not depend on the order of its rows in the last digits


def _grow_here(p: Boost, start: float, scale: float, cuts, widths: np.ndarray, bins: np.ndarray, key: np.ndarray, y: np.ndarray) -> list[tuple]:
    """The trees of one fit (as tuples) from all its rows."""
    margin, trees = np.full(len(y), start), []
    for round_no in range(p.rounds):
        cols = _sampled_columns(p, bins.shape[1], round_no)
        g = (_Symmetric if p.shape == "symmetric" else _Leafwise)(p, cols, widths)
        own = bins[:, cols]
        gradient = np.rint((margin - y) * scale)
        begin, whole = g.begin, int(g.ends[-1])
        rows_of = {1: np.flatnonzero(_sampled(key, round_no, p.seed, p.rows)) if p.rows < 1.0 else np.arange(len(y))}

        def rows(node):
            if node not in rows_of:
                above = rows(node // 2)
                _, c, b = g.split[node // 2]
                right = own[above, c] > b
                rows_of[node - node % 2], rows_of[node - node % 2 + 1] = above[~right], above[right]
            return rows_of[node]

        while nodes := g.wants():
            held = [rows(v) for v in nodes]
            at, slot = np.concatenate(held), np.repeat(np.arange(len(nodes)) * whole, [len(x) for x in held])
            h = np.zeros((2, len(nodes) * whole))
            for lo in range(0, len(at), LOCAL_ROWS):
                some = at[lo:lo + LOCAL_ROWS]
                flat = (own[some] + begin + slot[lo:lo + LOCAL_ROWS, None]).ravel()
                h[0] += np.bincount(flat, np.repeat(gradient[some], len(cols)), h.shape[1])
                h[1] += np.bincount(flat, minlength=h.shape[1])
            h = h.reshape(2, len(nodes), whole)
            g.feed({v: h[:, s] for s, v in enumerate(nodes)})
        t = g.tree(g.splits, cuts, scale)
        trees.append((t.feature, t.bin, t.cut, t.left, t.right, t.value, t.gain, t.depth))
        margin += t.value[_walk((t.feature, t.bin, t.left, t.right, t.depth), bins)]
        if not g.splits and p.rows >= 1 and p.columns >= 1:
            break  # nothing is left to split, and every further round would see the same
    return trees


def _fit_in_tasks(blocks: DataFrame, nf: int, names: list[str], runs: list[Run], starts, scales, cuts, widths, alive) -> dict[int, list[Tree]]:
    """{fit: trees}, one task a fit; the blocks are small (LOCAL_BYTES)."""
    sc = blocks.sparkSession.sparkContext
    table = sc.broadcast([(r.n, bytes(r.bins), bytes(r.fold), bytes(r.key), bytes(r.y)) for r in blocks.collect()])
    wanted = [(i, runs[i].params, names.index(runs[i].target), runs[i].left_out, starts[i], scales[i]) for i in sorted(alive)]
    n_targets = len(names)

    def run(fit):
        i, p, t, out, start, scale = fit
        parts = []
        for n, b, f, k, y in table.value:
            target = np.frombuffer(y, np.float64).reshape(n_targets, n)[t]
            use = np.isfinite(target)
            if out is not None:
                use &= np.frombuffer(f, np.int32) != out
            parts.append((np.frombuffer(b, np.uint8).reshape(n, nf)[use], np.frombuffer(k, np.int64).view(np.uint64)[use], target[use]))
        return i, _grow_here(p, start, scale, cuts, widths, *(np.concatenate(x) for x in zip(*parts)))

    found = {i: [Tree(*t) for t in trees] for i, trees in sc.parallelize(wanted, len(wanted)).map(run).collect()}
    table.unpersist()
    return found


def fit_many(df: DataFrame, features, targets: dict[str, Column], runs: list[Run], fold: Column | None = None,
             key: str = "row_id", bins: int = 64, cuts: list[np.ndarray] | None = None) -> list[BoostedModel]:
    """The models of all runs, which advance together; see the module's docstring."""
    features, names = list(features), list(targets)
    nf, spark = len(features), df.sparkSession
    ensure_checkpoint_dir(spark)
    if cuts is None:
        cuts = quantile_cuts(df, features, bins)
    ok = {t: c.cast("double") for t, c in targets.items()}
    ok = {t: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c) for t, c in ok.items()}
    per_fold = df.groupBy((F.lit(-1) if fold is None else F.coalesce(fold, F.lit(-1))).cast("int").alias("j")).agg(
        F.count(F.lit(1)).alias("rows"),
        *(f(ok[t]).alias(f"{n}{i}") for i, t in enumerate(names) for n, f in (("n", F.count), ("s", F.sum), ("lo", F.min), ("hi", F.max)))).collect()
    starts, scales = [], []
    for r in runs:
        i = names.index(r.target)
        seen = [x for x in per_fold if x[f"n{i}"] and (r.left_out is None or x.j != r.left_out)]
        n = sum(x[f"n{i}"] for x in seen)
        if not n:
            starts.append(float("nan"))
            scales.append(1.0)
            continue
        start = _digits(math.fsum(x[f"s{i}"] for x in seen) / n)
        top = max(max(abs(x[f"lo{i}"] - start), abs(x[f"hi{i}"] - start)) for x in seen)
        starts.append(start)
        scales.append(2.0 ** math.floor(51 - math.log2(4 * n * top)) if top > 0 else 1.0)

    models = [BoostedModel(features, s, [], r.params.shape == "symmetric") for s, r in zip(starts, runs)]
    growers = {"leafwise": _Leafwise, "symmetric": _Symmetric}
    widths = np.array([len(c) + 1 for c in cuts], np.int64)
    alive = {i for i, r in enumerate(runs) if math.isfinite(starts[i]) and nf}
    whole = sum(x.rows for x in per_fold) * nf
    if whole <= LOCAL_BYTES:
        for i, trees in (_fit_in_tasks(binned_blocks(df, features, targets, cuts, fold, key), nf, names, runs, starts, scales, cuts, widths, alive) if alive else {}).items():
            models[i].trees = trees
        return models
    decode, advance, sums = _tasks(nf, len(names), starts, widths)
    cores = spark.sparkContext.defaultParallelism
    parts = max(min(cores, math.ceil(whole * len(runs) / TASK_BYTES)), math.ceil(whole / MOST_BYTES), 1)
    blocks = cut_lineage(binned_blocks(df, features, targets, cuts, fold, key).repartition(parts), "binned")
    state = blocks.rdd.coalesce(parts).map(decode).persist(StorageLevel.MEMORY_AND_DISK)

    def total(wanted, round_no):
        """The sums of every fit, added up on the executors: one array a fit comes back."""
        held = state.mapPartitions(sums(wanted, round_no))
        if parts > DIRECT_PARTITIONS:
            held = held.reduceByKey(np.add, min(len(wanted), parts))
        return dict(held.collect())

    before, round_no = None, 0
    while alive := {i for i in alive if round_no < runs[i].params.rounds}:
        growing = {i: growers[runs[i].params.shape](runs[i].params, _sampled_columns(runs[i].params, nf, round_no), widths) for i in alive}
        while asked := {i: w for i, g in growing.items() if (w := g.wants())}:
            wanted = {}
            for i, nodes in asked.items():
                g, r = growing[i], runs[i]
                t = g.tree({v for v in g.split if 2 * v in g.total}, cuts, scales[i])
                slot_of = np.full(len(t.value), -1, np.int64)
                for s, v in enumerate(nodes):
                    slot_of[g.at[v]] = s
                wanted[i] = (names.index(r.target), r.left_out, scales[i], r.params.rows, r.params.seed, g.cols,
                             (t.feature, t.bin, t.left, t.right, t.depth), slot_of, len(nodes))
            found = total(wanted, round_no)
            if before is not None:
                before.unpersist()
                before = None
            for i, nodes in asked.items():
                g = growing[i]
                shape = (2, len(nodes), int(g.ends[-1]))
                h = found[i].reshape(shape) if i in found else np.zeros(shape)
                g.feed({v: h[:, s] for s, v in enumerate(nodes)})
        grown = {}
        for i, g in growing.items():
            t = g.tree(g.splits, cuts, scales[i])
            models[i].trees.append(t)
            grown[i] = ((t.feature, t.bin, t.left, t.right, t.depth), t.value)
            if not g.splits and runs[i].params.rows >= 1 and runs[i].params.columns >= 1:
                alive.discard(i)  # nothing is left to split, and every further round would see the same
        round_no += 1
        if any(round_no < runs[i].params.rounds for i in alive):
            before, state = state, state.map(advance(grown)).persist(StorageLevel.MEMORY_AND_DISK)  # computed by the next pass
            if round_no % CHECKPOINT_ROUNDS == 0:
                state.checkpoint()
    for used in (before, state):
        if used is not None:
            used.unpersist()
    return models


# --- scoring ---------------------------------------------------------------------------

def score(df: DataFrame, columns: dict[str, dict[int | None, BoostedModel]], fold: str | None = None) -> DataFrame:
    """``df`` with one prediction per entry of ``columns``: that of the model of the row's
    fold, or of the model under None. A fold without a model gives not-a-number."""
    flat = {n: models for n, models in columns.items() if not all(m.symmetric for m in models.values())}
    out = _score_leafwise(df, flat, fold) if flat else df
    for n, models in columns.items():
        if n not in flat:
            out = _score_symmetric(out, n, models, fold)
    return out


def _score_leafwise(df: DataFrame, columns, fold: str | None) -> DataFrame:
    features = list(dict.fromkeys(f for models in columns.values() for m in models.values() for f in m.features))
    place = {f: i for i, f in enumerate(features)}
    plain = [(n, [(j, m.start, np.array([place[f] for f in m.features], np.int64), [(t.feature, t.cut, t.left, t.right, t.value, t.depth) for t in m.trees])
                  for j, m in models.items()]) for n, models in columns.items()]
    held = df.sparkSession.sparkContext.broadcast(plain)  # arrays only; its size is that of the models
    schema = T.StructType(df.schema.fields + [T.StructField(n, T.DoubleType()) for n in columns])
    given, nf = len(df.columns), len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = np.column_stack([batch.column(given + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(nf)]) if nf else np.zeros((n, 0))
            folds = batch.column(given + nf).to_numpy(zero_copy_only=False)
            more = []
            for _, models in held.value:
                out = np.full(n, np.nan)
                for j, start, at, trees in models:
                    rows = np.arange(n) if j is None else np.flatnonzero(folds == j)
                    part = x[np.ix_(rows, at)]
                    total, here = np.full(len(rows), start), np.arange(len(rows))
                    for feature, cut, left, right, value, depth in trees:
                        node = np.zeros(len(rows), np.int64)
                        for _ in range(depth):
                            node = np.where(part[here, feature[node]] <= cut[node], left[node], right[node])  # missing: right
                        total += value[node]
                    out[rows] = total
                more.append(pa.array(out))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(given)), *more], names=schema.names)

    extra = [F.col(quote(f)).cast("double").alias(f"__x{i}") for i, f in enumerate(features)]
    extra.append((F.lit(-1) if fold is None else F.coalesce(F.col(fold), F.lit(-1))).cast("int").alias("__j"))
    return df.select(*(F.col(quote(c)).alias(f"__g{i}") for i, c in enumerate(df.columns)), *extra).mapInArrow(run, schema)


def _score_symmetric(df: DataFrame, name: str, models: dict[int | None, BoostedModel], fold: str | None) -> DataFrame:
    """Natively: the answers to a tree's comparisons are the bits of its leaf's place."""
    some = next(iter(models.values()))
    packed = []
    for j, m in models.items():
        trees = []
        for t in m.trees:
            path, node = [], 0
            while t.left[node] != node:
                path.append((int(t.feature[node]), float(t.cut[node])))
                node = int(t.left[node])
            leaves = []
            for bits in range(2 ** len(path)):
                node = 0
                for d in range(len(path)):
                    node = int((t.right if bits >> (len(path) - 1 - d) & 1 else t.left)[node])
                leaves.append(float(t.value[node]))
            trees.append(([f for f, _ in path], [c for _, c in path], leaves))
        packed.append((j, float(m.start), trees))
    row = df.sparkSession.createDataFrame([(packed,)], "__m array<struct<fold: int, start: double, trees: array<struct<feature: array<int>, cut: array<double>, leaf: array<double>>>>>")
    own = F.get(F.filter("__m", lambda m: m["fold"].isNull() | (m["fold"] == (F.lit(-1) if fold is None else F.col(fold)))), F.lit(0))
    x = F.array(*(F.coalesce(F.col(quote(f)).cast("double"), F.lit(float("nan"))) for f in some.features))

    def leaf(t):
        bits = F.zip_with(t["feature"], t["cut"], lambda f, c: F.when(F.get(F.col("__x"), f) > c, 1).otherwise(0))
        return F.get(t["leaf"], F.aggregate(bits, F.lit(0), lambda a, b: a * 2 + b))

    total = F.aggregate(own["trees"], own["start"], lambda a, t: a + leaf(t))
    out = df.withColumn("__x", x).crossJoin(F.broadcast(row)).withColumn(name, F.coalesce(total, F.lit(float("nan"))))
    return out.drop("__x", "__m")
