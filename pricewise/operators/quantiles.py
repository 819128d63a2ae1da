"""Exact quantiles without pulling a whole group into one task.

Spark's exact ``percentile`` / ``median`` keep every distinct value of a group
in one aggregation buffer, and the final merge of a group happens in one
task - for a global cut over a 100 TB catalogue that is the whole value
domain in one task. This module gives the same numbers (linear interpolation
between the values at ranks floor(q(n-1)) and ceil(q(n-1)), NULL and NaN
skipped) with bounded per-task state:

1. rows become (group, value, count), combined before the shuffle, so a value
   that a third of all rows share is one row; the result is written once;
2. these are dealt by ranges of (group, value) and written with their range
   number; a group of any size is spread over many ranges;
3. the counts per (group, range) - as many as ranges and groups - are summed up
   in range order, which tells the ranges that hold a target rank;
4. only those ranges are read again; inside each, running counts over its
   sorted values (one range per task) find the values at the target ranks.

No row is copied per quantile and no list of values is gathered: from the third
step on, rows grow only with groups x quantiles and with the number of ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.session import cut_lineage


def _same(groups, left: str, right: str):
    conds = [F.col(left + g) == F.col(right + g) for g in groups]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def exact_quantiles(df: DataFrame, col: str, qs, groups=(), weight: str | None = None,
                    ranges: int | None = None) -> DataFrame:
    """(groups..., qi, q, value): exact linear-interpolation quantiles of ``col``
    per group. Rows with a NULL group key are left out (as pandas does).

    ``weight`` names a column of row counts for input that is aggregated already;
    ``ranges`` fixes the number of ranges (adaptive execution decides by default)."""
    groups = list(groups)
    qs = [float(q) for q in qs]
    keys = [f"_g{i}" for i in range(len(groups))]
    base = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(col).cast("double").alias("_x"),
                     (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("_w"))
    base = base.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    pairs = cut_lineage(base.groupBy(*keys, "_x").agg(F.sum("_w").alias("_c")), "quantile_pairs")
    order = [*keys, "_x"]
    dealt = pairs.repartitionByRange(ranges, *order) if ranges else pairs.repartitionByRange(*order)
    dealt = cut_lineage(dealt.withColumn("_p", F.spark_partition_id()), "quantile_ranges")

    sums = dealt.groupBy(*keys, "_p").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    totals = sums.groupBy(*keys).agg(F.coalesce(F.sum("_t"), F.lit(0)).alias("_n"))
    targets = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(q).alias("q"),
                                 F.floor(F.lit(q) * (F.col("_n") - 1)).cast("long").alias("lo"),
                                 F.ceil(F.lit(q) * (F.col("_n") - 1)).cast("long").alias("hi")) for i, q in enumerate(qs)])
    # one row per group; groups x quantiles and groups x ranges are small next to the values
    totals = cut_lineage(totals.withColumn("_targets", targets), "quantile_targets")
    ranks = F.array_distinct(F.flatten(F.transform("_targets", lambda t: F.array(t["lo"], t["hi"]))))
    wanted = totals.select(*[F.col(k).alias("_t" + k) for k in keys], ranks.alias("_ranks"))
    inside = F.filter("_ranks", lambda r: (r >= F.col("_off")) & (r < F.col("_off") + F.col("_t")))
    need = sums.join(wanted, _same(keys, "", "_t")).withColumn("_ranks", inside).where(F.size("_ranks") > 0)
    need = need.select(*[F.col(k).alias("_n" + k) for k in keys], F.col("_p").alias("_np"), "_off", "_ranks")
    found = dealt.join(need, _same(keys, "", "_n") & (F.col("_p") == F.col("_np")))
    running = Window.partitionBy(*keys, "_p").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_end", F.col("_off") + F.sum("_c").over(running))
    hit = F.filter("_ranks", lambda r: (r >= F.col("_end") - F.col("_c")) & (r < F.col("_end")))
    values = (found.select(*keys, F.explode(hit).alias("_r"), "_x")
              .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at")))
    values = values.select(*[F.col(k).alias("_v" + k) for k in keys], "_at")
    out = totals.join(values, _same(keys, "", "_v"), "left").select(*keys, "_n", "_at", F.explode("_targets").alias("_q"))
    place = F.col("_q.q") * (F.col("_n") - 1)
    lo, hi = F.try_element_at("_at", F.col("_q.lo")), F.try_element_at("_at", F.col("_q.hi"))
    value = F.when(F.col("_n") > 0, F.when(F.col("_q.lo") == F.col("_q.hi"), lo)
                   .otherwise((F.col("_q.hi") - place) * lo + (place - F.col("_q.lo")) * hi))
    out = out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.col("_q.qi").alias("qi"), F.col("_q.q").alias("q"), value.alias("value"))
    return cut_lineage(out, "quantiles")


def exact_median(df: DataFrame, col: str, groups=(), out: str | None = None) -> DataFrame:
    """(groups..., out) with the exact median of ``col`` per group."""
    r = exact_quantiles(df, col, [0.5], groups)
    return r.select(*groups, F.col("value").alias(out or f"median_{col}"))


def quantile_row(df: DataFrame, col: str, qs, out: str = "_cuts") -> DataFrame:
    """One row holding the array of exact quantiles of ``col`` (no groups)."""
    r = exact_quantiles(df, col, qs)
    return r.agg(F.transform(F.array_sort(F.collect_list(F.struct("qi", "value"))), lambda s: s["value"]).alias(out))


def column_medians_exact(df: DataFrame, cols, groups=()) -> DataFrame:
    """(groups..., one column per input column) holding exact medians; all
    columns in one pass by unpivoting to (column, value)."""
    groups = list(groups)
    pairs = F.array(*[F.struct(F.lit(i).alias("_pos"), F.col(f"`{c}`").cast("double").alias("_val"))
                      for i, c in enumerate(cols)])
    longv = df.select(*groups, F.inline(pairs))
    med = exact_quantiles(longv, "_val", [0.5], groups + ["_pos"])
    wide = [F.first(F.when(F.col("_pos") == i, F.col("value")), ignorenulls=True).alias(c) for i, c in enumerate(cols)]
    if groups:
        return med.groupBy(*groups).agg(*wide)
    return med.agg(*wide)
