"""Permutation index: recall against brute force, scores, edge cases."""

import numpy as np
import pytest

from pricewise.llm import permutation

NAN, INF = float("nan"), float("inf")


def brute(rows, queries, k):
    ok = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r[1]))):
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and i not in ok:
            ok[i] = np.array(v, np.float64)
    out = {}
    for q in queries:
        if q in ok:
            s = sorted(((-float(np.dot(v, ok[q]) / np.linalg.norm(v) / np.linalg.norm(ok[q])), i) for i, v in ok.items() if i != q))[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


@pytest.mark.parametrize("block_rows", [1 << 14, 700])
def test_recall(spark, block_rows):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in v.collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = {}
    for r in permutation.search(v, v.where("vec_id % 50 = 0"), block_rows=block_rows).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    hits = sum(len({i for i, _ in got[q].values()} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    vec = dict(rows)
    for q, found in got.items():
        for i, score in found.values():
            a, b = np.array(vec[q], np.float64), np.array(vec[i], np.float64)
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_files_hold_the_nearest_pivots_only():
    rng = np.random.default_rng(3)
    x, pivots = (permutation._unit(rng.normal(size=(n, 8))) for n in (200, 40))
    order = permutation.orders(x, pivots, 6)
    first, row, place = permutation.post(order, 40)
    assert len(row) == 200 * 6
    for p in range(40):
        got = sorted(zip(row[first[p]:first[p + 1]].tolist(), place[first[p]:first[p + 1]].tolist()))
        assert got == [(r, int(np.flatnonzero(order[r] == p)[0])) for r in range(200) if p in order[r]]
    agree = permutation._agreement(order[7], (first, row, place), 200)
    want = [sum(6 - abs(j - list(order[r]).index(p)) for j, p in enumerate(order[7]) if p in order[r]) for r in range(200)]
    assert agree.tolist() == want and agree.argmax() == 7 and agree[7] == 36


def test_an_id_with_several_vectors_is_a_candidate_with_each(spark):
    v = spark.createDataFrame([(50, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [1.0, 0.2]), (7, [1.0, 0.2])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, round(r.score, 9)) for r in permutation.search(v, v.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(1, 7, round(1 / 1.01 ** 0.5, 9)), (2, 7, round(1 / 1.04 ** 0.5, 9))]


def test_small_table_is_exact_with_edge_cases(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [2.0, 0.2, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [NAN, 1.0, 0.0]), (6, [INF, 1.0, 0.0]),
            (7, [0.0, 1.0, 0.0]), (8, [None, 1.0, 0.0]), (9, [1e200, 1e200, 0.0]), (None, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]),
            (100, [0.0, 0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as block", "'x' as rank", "2 as id")
    got = {}
    for r in permutation.search(v, v.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert got[0] == [(50, 1.0), (1, round(1 / 1.01 ** 0.5, 12)), (2, round(1 / 1.01 ** 0.5, 12)), (9, round(0.5 ** 0.5, 12)), (7, 0.0)]
    assert set(got) == {0, 50} and got[50][0] == (0, 1.0)


def test_empty_and_other_lengths(spark):
    v = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert permutation.search(v, v).collect() == []
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0])], "vec_id long, embedding array<double>")
    out = permutation.search(v, v).collect()
    assert {(r.query_id, r.vec_id) for r in out} <= {(1, 2), (2, 1)}


def test_dense_group_is_searched_whole(spark):
    rng = np.random.default_rng(1)
    c = rng.normal(size=16)
    rows = [(i, (rng.normal(size=16) if i % 3 else c + 1e-3 * rng.normal(size=16)).tolist()) for i in range(3000)]
    want = brute(rows, range(0, 3000, 50), 5)
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in permutation.search(v, v.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
