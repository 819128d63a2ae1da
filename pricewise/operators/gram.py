"""Least squares from additive sums: one scan for every fold, penalty and target.

The products of all pairs of columns [1, features, targets] are summed by fold in one
aggregate. Sums add up, so the training sums of a fold are the total minus the fold's
own, and every linear or ridge fit of a cross-validation is a small solve on the driver
(its size is the number of features, never of rows). Rows are read once and not moved.

Without a penalty the table may be rank-deficient (the indicators of a category add up
to one): the solve keeps the eigenvalues above EPS of the largest and gives the solution
of least norm, as a dense least-squares solver does. With a penalty the matrix is
positive definite. The intercept is not penalised.

Rows with a null or not a number in any feature or target are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.sources.tables import quote

EPS = 1e-10
ONE = "1"


def fold_gram(df: DataFrame, features, targets: dict[str, Column], fold: Column | None = None) -> DataFrame:
    """(fold, i, j, total): sums of products of columns i <= j of [1, features, targets].

    A task adds its rows up in one matrix per fold, so what is shuffled is the number of
    folds times the square of the number of columns, per task."""
    cols = [F.lit(1.0).alias("c0"), *(F.col(quote(f)).cast("double").alias(f"c{i + 1}") for i, f in enumerate(features)),
            *(t.cast("double").alias(f"t{i}") for i, t in enumerate(targets.values()))]
    q = len(cols)
    upper = np.triu_indices(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            fold_no = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(q)])
            whole = np.isfinite(x).all(axis=1)
            for k in np.unique(fold_no[whole]).tolist():
                part = x[whole & (fold_no == k)]
                held[k] = held.get(k, 0.0) + part.T @ part
        for k, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(upper[0]), k, np.int32)), pa.array(upper[0].astype(np.int32)),
                                              pa.array(upper[1].astype(np.int32)), pa.array(m[upper])], names=["fold", "i", "j", "total"])

    keyed = df.select((F.lit(0) if fold is None else fold).cast("int").alias("fold"), *cols).where("fold IS NOT NULL")
    return keyed.mapInArrow(run, "fold int, i int, j int, total double").groupBy("fold", "i", "j").agg(F.sum("total").alias("total"))


@dataclass
class GramSums:
    """The symmetric matrix of sums over some rows."""
    features: list[str]
    targets: list[str]
    m: np.ndarray

    def __sub__(self, other: "GramSums") -> "GramSums":
        return GramSums(self.features, self.targets, self.m - other.m)

    @property
    def n(self) -> float:
        return float(self.m[0, 0])

    def solve(self, target: str, alpha: float = 0.0) -> tuple[np.ndarray, float]:
        """(coefficients, intercept) of least squares plus alpha times their square."""
        p = len(self.features)
        if self.n == 0:
            return np.zeros(p), float("nan")
        t = 1 + p + self.targets.index(target)
        mean = self.m[0] / self.n
        centred = self.m - self.n * np.outer(mean, mean)
        a, b = centred[1:1 + p, 1:1 + p], centred[1:1 + p, t]
        if alpha > 0:
            w = np.linalg.solve(a + alpha * np.eye(p), b)
        else:
            value, vector = np.linalg.eigh(a)
            keep = value > EPS * max(value.max(initial=0.0), 0.0)
            vector = vector[:, keep]
            w = vector @ ((vector.T @ b) / value[keep])
        return w, float(mean[t] - mean[1:1 + p] @ w)


def collect_grams(df: DataFrame, features, targets: dict[str, Column], fold: Column | None = None) -> dict[int, GramSums]:
    """The matrices by fold, on the driver: (1 + features + targets)^2 numbers a fold."""
    features, names = list(features), list(targets)
    q = 1 + len(features) + len(names)
    out: dict[int, np.ndarray] = {}
    for r in fold_gram(df, features, targets, fold).collect():
        m = out.setdefault(r.fold, np.zeros((q, q)))
        m[r.i, r.j] = m[r.j, r.i] = r.total
    return {k: GramSums(features, names, m) for k, m in sorted(out.items())}


def total_of(grams: dict[int, GramSums]) -> GramSums:
    parts = list(grams.values())
    return GramSums(parts[0].features, parts[0].targets, sum(g.m for g in parts))


class LinearModel:
    """A linear predictor as a native expression; takes the place of a fitted pipeline."""

    def __init__(self, features, coefficients, intercept: float):
        self.features, self.intercept = list(features), float(intercept)
        self.coefficients = DenseVector(np.asarray(coefficients, float))

    @property
    def stages(self):
        return [self]

    def expression(self) -> Column:
        out = F.lit(self.intercept)
        for f, w in zip(self.features, self.coefficients.toArray().tolist()):
            out = out + F.col(quote(f)).cast("double") * F.lit(w)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("pred_t", self.expression())


def fold_predictor(features, by_fold: dict[int, tuple[np.ndarray, float]], n_folds: int, fold: str = "fold") -> Column:
    """The prediction of each row by its own fold's model: one expression for all folds."""
    def number(v: float) -> str:
        return f"double('{float(v)!r}')"

    rows = [by_fold.get(j) for j in range(n_folds)]
    table = "array(" + ", ".join("array(" + ", ".join(number(v) for v in (r[0] if r else [float("nan")] * len(list(features)))) + ")" for r in rows) + ")"
    start = "array(" + ", ".join(number(r[1] if r else float("nan")) for r in rows) + ")"
    x = F.array(*(F.col(quote(f)).cast("double") for f in features))
    return F.aggregate(F.zip_with(x, F.get(F.expr(table), F.col(fold)), lambda a, w: a * w), F.get(F.expr(start), F.col(fold)), lambda s, v: s + v)
