"""Nearest neighbours by a permutation index.

At most ``PIVOTS`` vectors of a bounded sample (SAMPLE rows) order the space: a vector is
represented by its ``NEAREST`` nearest pivots, in order. The index holds, for each block
of about BLOCK_ROWS vectors, one inverted file per pivot: the vectors that have the pivot
among their nearest, and at which place. A query reads only the files of its own nearest
pivots and sums, over the pivots both have, NEAREST less the difference of places; that
is a constant less half of Spearman's footrule for orders cut at NEAREST. The ``RERANK``
share of the block with the largest sums (ties included; all rows above DENSE of the
largest possible sum, so members of a dense group too) is reranked by the cosine in
double precision. Every vector is posted; nothing is sampled but pivots.

Scale: vectors are dealt to blocks by a hash of id and vector, queries to packs of at most
PACK_ROWS; a (block, pack) pair is one group of one task, so both sides of a task are
bounded and equal vectors spread over all blocks. A file is split by the blocks, and
sums stay in the task: a group gives at most ``k`` rows per query, and a window ranks
them. The search is the stated query set against all rows in blocks; a query meets about
NEAREST^2 / PIVOTS postings per vector of the table, two by default.

Recall: PIVOTS, NEAREST and RERANK were chosen by measurement against brute force (README).

Edge cases: vectors that are null, zero, hold null or non-finite components, or have
another length than the pivots take no part, as query or candidate; rows with the same id
and vector count once; an id with several vectors is a candidate with each and asks with
the smallest; ties of the score go to the smaller id; fewer than ``k`` candidates give fewer rows; a null id
takes no part; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import cut_lineage, split_rows

PIVOTS = 512
#: Pivots under which a vector is posted, and files that a query reads.
NEAREST = 32
#: Rows of which pivots are chosen, whatever the table's size.
SAMPLE = 2048
APART = 0.7
RERANK = 0.15
#: At least so many candidates of a block are reranked: in a few rows the footrule is coarse.
FLOOR = 512
#: Rows above this share of the largest possible sum are all reranked: members of a dense
#: group, which share one order of pivots and which the footrule cannot part.
DENSE = 0.5
BLOCK_ROWS = 1 << 14
PACK_ROWS = 1 << 15
K = 5
#: Rounding of a product by BLAS, which may differ between equal rows.
BLAS_ERROR = 1e-9


def usable(v: Column) -> Column:
    """The vector has a direction: not null, all components finite, some not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of the list column as doubles."""
    flat = column.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivots_of(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """At most ``n`` pivots, the same for any partitioning: the rows of a bounded sample
    (SAMPLE rows with the smallest hash) in turn, each unless its cosine with an earlier
    pivot exceeds APART; else a dense group would fill the orders with equal pivots. The
    length of the first vector is the index's; others of another length are left out."""
    rows = vectors.orderBy(F.xxhash64(F.lit("pivot"), F.col("id")), "id", "vec").limit(SAMPLE).collect()
    rows = [r.vec for r in rows if len(r.vec) == len(rows[0].vec)]
    unit = _unit(np.array(rows, np.float64)) if rows else np.zeros((0, 0))
    taken: list[int] = []
    for i in range(len(unit)):
        if len(taken) < n and (not taken or (unit[taken] @ unit[i]).max() <= APART):
            taken.append(i)
    return unit[taken]


def orders(x: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """[row, place]: the row's nearest pivots, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int32)


def post(order: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverted files: first posting of each pivot, then row and place of the postings."""
    flat = order.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    first = np.searchsorted(flat[by_pivot], np.arange(n_pivots + 1))
    return first, (by_pivot // order.shape[1]).astype(np.int32), (by_pivot % order.shape[1]).astype(np.int32)


def _agreement(asked: np.ndarray, files: tuple, rows: int) -> np.ndarray:
    """Sum of every row of the block over the files of a query's pivots."""
    first, row, place = files
    out = np.zeros(rows, np.int32)
    for j, p in enumerate(asked.tolist()):
        part = slice(first[p], first[p + 1])
        out[row[part]] += len(asked) - np.abs(place[part] - j)  # a row is posted once in a file
    return out


def _distinct(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rows without those that repeat an id with its vector."""
    _, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
    keep = counts[which] == 1
    seen = set()
    for r in np.flatnonzero(~keep).tolist():
        key = (int(ids[r]), x[r].tobytes())
        keep[r] = key not in seen
        seen.add(key)
    return np.flatnonzero(keep)


def _search(index: pa.Table, queries: pa.Table, pivots: np.ndarray, k: int, rerank: float):
    """Up to ``k`` (query, id, score) of the block for every query row."""
    width = pivots.shape[1]
    ids, qids = index.column("id").to_numpy(), queries.column("id").to_numpy()
    x, q = _matrix(index.column("vec"), width), _matrix(queries.column("vec"), width)
    rows = _distinct(ids, x)
    ids, x = ids[rows], x[rows]
    ux, uq = _unit(x), _unit(q)
    files = post(orders(ux, pivots), len(pivots))
    asked = orders(uq, pivots)
    budget = max(FLOOR, int(np.ceil(rerank * len(ids))))
    out = []
    for i in range(len(qids)):
        near = np.flatnonzero(ids != qids[i])
        if budget < len(ids):
            agree = _agreement(asked[i], files, len(ids))
            limit = min(np.partition(agree, len(ids) - budget)[len(ids) - budget], DENSE * asked.shape[1] ** 2)
            some = near[agree[near] >= max(limit, 1)]
            near = some if len(some) >= k else near
        if len(near) > k:
            rough = ux[near] @ uq[i]
            near = near[rough >= np.partition(rough, len(near) - k)[len(near) - k] - BLAS_ERROR]
        score = (ux[near] * uq[i]).sum(axis=1)
        best = near[np.lexsort((ids[near], -score))[:k]]
        out += zip([qids[i]] * len(best), ids[best].tolist(), (_cosine(x[b], q[i], ux[b], uq[i]) for b in best))
    return out


def _cosine(a: np.ndarray, b: np.ndarray, unit_a: np.ndarray, unit_b: np.ndarray) -> float:
    """Of the original vectors; of their unit vectors if squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore"):
        norm = np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))
    return float(np.dot(a, b) / norm) if np.isfinite(norm) and norm > 1e-150 else float(np.dot(unit_a, unit_b))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, n_pivots: int = PIVOTS, rerank: float = RERANK,
           id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, rows
    with the query's own id left out."""
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
        return df.where(F.col("id").isNotNull() & usable(F.col("vec")))

    index, asked = cut_lineage(clean(vectors), "vectors"), cut_lineage(clean(queries), "queries")
    asked = asked.groupBy("id").agg(F.min("vec").alias("vec"))
    pivots = pivots_of(index, n_pivots)
    width = pivots.shape[1]
    index, asked = (df.where(F.size("vec") == width) for df in (index, asked))
    blocks, packs = split_rows(spark, index.count(), block_rows), split_rows(spark, asked.count(), PACK_ROWS)
    left = index.select(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(packs - 1))).alias("pack"), "id", "vec")
    right = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int").alias("pack"), "id", "vec")
    schema = T._parse_datatype_string("query_id long, vec_id long, score double")
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found = _search(a, b, pivots, k, rerank) if len(a) and len(b) else []
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)] if found else [pa.array([], f.type) for f in arrow], schema=arrow)

    found = left.groupBy("block", "pack").cogroup(right.groupBy("block", "pack")).applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
