"""Exact places in a global order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import positions as PO


@pytest.mark.parametrize("ranges", [1, 7, 40, None])
def test_places_with_ties_and_nulls(spark, ranges):
    rows = [(i, None if i % 10 == 0 else float(i * 37 % 11)) for i in range(500)]
    got = {r.id: r.position for r in PO.with_position(spark.createDataFrame(rows, "id long, x double").repartition(5), ["x", "id"], ranges=ranges).collect()}
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [got[i] for i, _ in want] == list(range(500))


def test_contiguous_folds_are_those_of_an_unshuffled_split(spark):
    for n in (0, 3, 5, 23, 100):
        df = spark.createDataFrame([(i,) for i in range(n)], "id long").repartition(3)
        got = {r.id: r.fold for r in PO.contiguous_folds(df, ["id"], 5).collect()}
        want = {int(i): k for k, part in enumerate(np.array_split(np.arange(n), 5)) for i in part}
        assert got == want


def test_align_by_position(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "x long, name string")
    b = spark.createDataFrame([(9.0, 30), (7.0, 10), (8.0, 20), (10.0, 40)], "y double, v long")
    got = PO.align_by_position(a, b, ["x"], ["y"]).orderBy("position").collect()
    assert [(r.position, r.name, r.v) for r in got] == [(0, "a", 10), (1, "b", 20), (2, "c", 30)]


def test_sorted_positions_leave_out_what_has_no_place(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, float("nan")), (4, 1.0), (5, 5.0)], "id long, x double").withColumn("position", F.lit("clash"))
    assert [tuple(r) for r in PO.sorted_positions(df, "x", "id").orderBy("position").collect()] == [(0, 1.0), (1, 5.0), (2, 5.0)]
