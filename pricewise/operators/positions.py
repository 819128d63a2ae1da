"""The exact place of every row in a global order, without one task for the whole table.

Rows are dealt by ranges of the order columns and written with their range's number; the
rows per range are counted and added up (one row per range), and a row's place is its
range's offset plus its place inside the range. The order columns end in an id, so ties
are dealt over ranges as well and the place of each row is fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.session import cut_lineage
from pricewise.sources.tables import quote


def with_position(df: DataFrame, order, out: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with the 0-based place of each row in the order of the columns ``order``
    (ascending, nulls first). Rows equal in all order columns are ordered arbitrarily."""
    cols = [F.col(quote(c)) for c in order]
    dealt = df.repartitionByRange(ranges, *cols) if ranges else df.repartitionByRange(*cols)
    dealt = cut_lineage(dealt.withColumn("__range", F.spark_partition_id()), "position_ranges")
    sums = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # one row per range
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__range").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__range").orderBy(*cols)
    return (dealt.withColumn("__place", F.row_number().over(inside) - 1)
            .join(F.broadcast(sums), F.col("__range") == F.col("__of"))
            .withColumn(out, (F.col("__offset") + F.col("__place")).cast("long")).drop("__range", "__place", "__of", "__offset"))


def align_by_position(left: DataFrame, right: DataFrame, left_order, right_order) -> DataFrame:
    """Row i of ``left`` beside row i of ``right``, each in its own order (inner join by place)."""
    a, b = with_position(left, left_order), with_position(right, right_order, "__right_position")
    return a.join(b, F.col("position") == F.col("__right_position")).drop("__right_position")


def contiguous_folds(df: DataFrame, order, k: int = 5, out: str = "fold") -> DataFrame:
    """``df`` cut into k runs of the given order, the first n mod k one row longer."""
    placed = with_position(df, order, "__position")
    n = placed.agg(F.count(F.lit(1)).alias("__total"))
    size, extra = F.floor(F.col("__total") / k), F.col("__total") % k
    long_part = extra * (size + 1)
    fold = F.when(F.col("__position") < long_part, F.floor(F.col("__position") / (size + 1))).otherwise(
        extra + F.floor((F.col("__position") - long_part) / F.greatest(size, F.lit(1))))
    return placed.crossJoin(F.broadcast(n)).withColumn(out, fold.cast("int")).drop("__position", "__total")


def sorted_positions(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """(position, value): the sorted curve of ``col``, every value at its place (nulls and
    not-a-numbers left out, ties by id)."""
    x = df.select(F.col(quote(col)).cast("double").alias("value"), F.col(quote(id_col)).alias("__id")).where("value IS NOT NULL AND NOT isnan(value)")
    return with_position(x, ["value", "__id"]).select("position", "value")
