"""The most frequent values: bounded counters with a proof, against full counts."""

import random
from collections import Counter

import pytest

from pricewise.operators import heavy as H


def brute(rows, columns, k):
    out = set()
    for i, name in enumerate(columns):
        counts = Counter(str(r[i]) for r in rows if r[i] is not None)
        for rank, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k], 1):
            out.add((name, v, n, rank))
    return out


def _rows(n=3000, seed=1):
    rng = random.Random(seed)
    long = ["L" * 70 + str(i % 3) + "x" * (i % 5) for i in range(20)]
    return [(i, rng.choice(["a"] * 50 + ["b"] * 30 + [f"v{j}" for j in range(300)]), rng.choice([None, *long]), None, rng.choice(["é", "e", "z"]) * rng.randint(0, 90)) for i in range(n)]


COLUMNS = ["id", "word", "long", "none", "odd"]


@pytest.mark.parametrize("counters,slices", [(4096, 1), (4096, 6), (40, 6), (5, 3), (1, 2)])
def test_equals_full_counts(spark, counters, slices):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, word string, long string, none string, odd string").repartition(slices)
    got = {tuple(r) for r in H.top_k(df, None, 7, counters).collect()}
    assert got == brute(rows, COLUMNS, 7)


def test_counters_are_bounds():
    held = Counter({"a": 50, "b": 20, "c": 3, "d": 3, "e": 1})
    kept = dict(held)
    loss = H.reduce_counters(kept, 3)
    assert loss == 3 and kept == {"a": 47, "b": 17}
    assert all(kept.get(v, 0) <= n <= kept.get(v, 0) + loss for v, n in held.items())


def test_heavy_column_needs_no_wide_pass(spark, monkeypatch):
    """With a proof only candidates are counted, nearly unique columns take the wider pass."""
    rows = [("hot" if i % 2 else "warm" if i % 4 else f"cold{i}", str(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "w string, u string").repartition(4)
    found = H.summary(H._keyed(df, ["w", "u"]), 300).groupBy("pos", "prefix").sum("n").collect()
    error = {r.pos: r["sum(n)"] for r in found if r.prefix is None}
    assert error[0] < 1000 <= error[1] + 1000
    assert {tuple(r) for r in H.top_k(df, ["w"], 2, 300).collect()} == {("w", "hot", 2000, 1), ("w", "warm", 1000, 2)}


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "pos long, value string")
    assert H.top_k(df).collect() == []
    df = spark.createDataFrame([(1, "x"), (1, None)], "pos long, value string")
    assert {tuple(r) for r in H.top_k(df).collect()} == {("pos", "1", 2, 1), ("value", "x", 1, 1)}
