"""Top-N under a budget for many requests, without forming request-item pairs.

A request wants the best N items with price <= budget in one group: all items, those of a
segment, of a brand, or of both. Items are posted under each kind of group that some
request asks for (at most four rows an item). Prices are cut into ranges of about
ROWS_PER_RANGE items, and the best N items of every (group, range) are kept: lists that
merge, so that the best N of all ranges below a range come from at most BLOCK lists of
its block of ranges and one list for each block before. A request then takes

- the merged list of the ranges below its budget's range (all of their items fit), and
- the items of that one range, met in price order together with all its requests: one
  sweep that keeps the best N seen so far and answers each budget as it passes.

Work is that of sorting the items once per kind, plus N rows a request. Equal requests
(same group and budget) are answered once. An item is in a sweep only if fewer than N
items of its price are better, so a price that a third of all items share is N rows.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.operators.common import Roles
from pricewise.session import cut_lineage

ROWS_PER_RANGE = 1 << 16
BLOCK = 64
DEFAULT_TOP_N = 10
GROUP = ["kind", "gs", "gb"]
CELL = [*GROUP, "range"]


def checked_requests(scenarios: DataFrame) -> DataFrame:
    """Requests with ``top_n`` filled in; a request number must stand for one request."""
    if scenarios.groupBy("scenario").count().where("count > 1").limit(1).count():
        raise ValueError("each scenario number must belong to one request")
    return scenarios.withColumn("top_n", F.coalesce(F.col("top_n"), F.lit(DEFAULT_TOP_N)).cast("int"))


def _kind(segment: Column, brand: Column) -> Column:
    return F.when(segment.isNotNull(), 1).otherwise(0) + F.when(brand.isNotNull(), 2).otherwise(0)


def _ranged(df: DataFrame, col: str, cuts: Sequence[float]) -> DataFrame:
    """``df`` with ``range``: the number of cuts <= the value. Nulls and not-a-numbers go."""
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) == 2:
        return df.where(F.col(col).isNotNull() & ~F.isnan(col)).withColumn("range", F.lit(0))
    out = Bucketizer(splits=splits, inputCol=col, outputCol="__range", handleInvalid="skip").transform(df)
    return out.withColumn("range", F.col("__range").cast("int")).drop("__range")


def _price_cuts(items: DataFrame, rows_per_range: int) -> list[float]:
    """Increasing price limits of ranges with about that many items; any limits are right."""
    n = items.count()
    ranges = -(-n // rows_per_range)
    if ranges < 2:
        return []
    points = [i / ranges for i in range(1, ranges)]
    found = items.agg(F.percentile_approx("price", points, max(10_000, 10 * ranges))).first()[0] or []
    return sorted({float(c) for c in found})


def _posted(items: DataFrame, kinds: list[int]) -> DataFrame:
    """Items once per kind of group in ``kinds`` (segment: bit 1, brand: bit 2)."""
    entries = [F.when((F.lit(not k & 1) | F.col("segment").isNotNull()) & (F.lit(not k & 2) | F.col("brand").isNotNull()),
                      F.struct(F.lit(k).alias("kind"), (F.col("segment") if k & 1 else F.lit("")).alias("gs"), (F.col("brand") if k & 2 else F.lit("")).alias("gb")))
               for k in kinds]
    rest = [c for c in items.columns if c not in ("segment", "brand")]
    return items.select(*rest, F.explode(F.array_compact(F.array(*entries))).alias("g")).select(*rest, "g.kind", "g.gs", "g.gb")


def _asked(requests: DataFrame, cuts) -> DataFrame:
    keyed = requests.select("scenario", F.col("budget_eur").cast("double").alias("budget"), "top_n",
                            _kind(F.col("segment"), F.col("brand")).alias("kind"),
                            F.coalesce("segment", F.lit("")).alias("gs"), F.coalesce("brand", F.lit("")).alias("gb"))
    return _ranged(keyed, "budget", cuts)


def _best(df: DataFrame, by, order, n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def _sweep(left: pa.Table, right: pa.Table) -> pa.Table:
    """Answers of one cell: for each budget the best-ranked items priced at or below it."""
    names = [*CELL, "budget", "place", "item_id"]
    price, rank, item = left.column("price").to_pylist(), left.column("rank").to_pylist(), left.column("item_id").to_pylist()
    line = sorted(range(len(price)), key=price.__getitem__)
    asked = sorted(zip(right.column("budget").to_pylist(), right.column("n").to_pylist()))
    most = max((n for _, n in asked), default=0)
    best: list[tuple[int, int]] = []
    at = 0
    budgets, places, items = [], [], []
    for budget, n in asked:
        while at < len(line) and price[line[at]] <= budget:
            i = line[at]
            if most and (len(best) < most or rank[i] < best[-1][0]):
                insort(best, (rank[i], i))
                del best[most:]
            at += 1
        for place, (_, i) in enumerate(best[:n], 1):
            budgets.append(budget)
            places.append(place)
            items.append(item[i])
    keys = [pa.array([right.column(c)[0].as_py()] * len(items) if len(asked) else [], right.schema.field(c).type) for c in CELL]
    return pa.Table.from_arrays([*keys, pa.array(budgets, pa.float64()), pa.array(places, pa.int32()), pa.array(items, left.schema.field("item_id").type)], names=names)


def _below(posted: DataFrame, cells: DataFrame, keys, most: int, columns) -> DataFrame:
    """The best items of all ranges below each cell, priced to fit every budget of it, from
    lists that merge: one per range, one per block of ranges."""
    heads = cut_lineage(_best(posted, CELL, keys, most), "range_heads").withColumn("block", F.floor(F.col("range") / BLOCK))
    blocks = _best(heads, [*GROUP, "block"], keys, most)
    wanted = cells.select(*(F.col(c).alias("w_" + c) for c in CELL), F.floor(F.col("range") / BLOCK).alias("w_block"))

    def same(df):
        cond = None
        for c in GROUP:
            cond = (df[c] == wanted["w_" + c]) if cond is None else cond & (df[c] == wanted["w_" + c])
        return cond

    near = heads.join(wanted, same(heads) & (heads["block"] == wanted["w_block"]) & (heads["range"] < wanted["w_range"]))
    far = blocks.join(wanted, same(blocks) & (blocks["block"] < wanted["w_block"]))
    below = near.select(*("w_" + c for c in CELL), *columns).unionByName(far.select(*("w_" + c for c in CELL), *columns))
    below = below.withColumnsRenamed({"w_" + c: c for c in CELL})
    return _best(below, CELL, keys, most).withColumn("price", F.lit(float("-inf"))).select(*CELL, *columns)


def prefix_topn(catalog: DataFrame, scenarios: DataFrame, order, roles: Roles = Roles(), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(scenario, recommendation_rank, item id): the best ``top_n`` items of each request in
    the order ``order``, pairs of (column, descending) that leave no ties. Item ids identify
    items; a budget that is null or not a number gets no rows."""
    requests = cut_lineage(checked_requests(scenarios), "requests")
    shape = requests.agg(F.max("top_n").alias("n"), F.collect_set(_kind(F.col("segment"), F.col("brand"))).alias("kinds")).first()
    most, kinds = int(shape["n"] or 0), sorted(shape["kinds"])
    plain = catalog.select(F.col(roles.item_id).alias("item_id"), F.col(roles.price).cast("double").alias("price"),
                           F.col(roles.segment).alias("segment"), F.col(roles.brand).alias("brand"), *((F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, (c, _) in enumerate(order)))
    keys = [F.col(f"o{i}").desc_nulls_last() if down else F.col(f"o{i}").asc_nulls_last() for i, (_, down) in enumerate(order)]
    items = cut_lineage(plain.where(F.col("price").isNotNull() & ~F.isnan("price")), "index_items")
    cuts = _price_cuts(items, rows_per_range)
    asked = cut_lineage(_asked(requests, cuts), "asked")
    cells = asked.select(*CELL).distinct()
    posted = _ranged(_posted(items, kinds or [0]), "price", cuts)
    columns = ["item_id", "price", *(f"o{i}" for i in range(len(order)))]
    boundary = _best(posted.join(cells, CELL, "left_semi"), [*CELL, "price"], keys, most).select(*CELL, *columns)
    met = boundary.unionByName(_below(posted, cells, keys, most, columns)) if cuts else boundary  # nothing lies below a single range
    met = met.withColumn("rank", F.row_number().over(Window.partitionBy(*CELL).orderBy(*keys)))
    budgets = asked.groupBy(*CELL, "budget").agg(F.max("top_n").alias("n"))
    kinds_of = {f.name: f.dataType.simpleString() for f in items.schema.fields}
    schema = f"kind int, gs string, gb string, range int, budget double, place int, item_id {kinds_of['item_id']}"
    answers = met.select(*CELL, "price", "rank", "item_id").groupBy(*CELL).cogroup(budgets.groupBy(*CELL)).applyInArrow(_sweep, schema)
    return (asked.join(answers, [*CELL, "budget"]).where(F.col("place") <= F.col("top_n"))
            .select("scenario", F.col("place").alias("recommendation_rank"), F.col("item_id").alias(roles.item_id)))


def candidate_counts(catalog: DataFrame, scenarios: DataFrame, roles: Roles = Roles(), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(scenario, candidates, min_price, max_price) of the items each request may get;
    requests without any are left out. Totals of the ranges below a budget, plus running
    totals inside its range."""
    requests = cut_lineage(checked_requests(scenarios), "requests")
    kinds = sorted(requests.agg(F.collect_set(_kind(F.col("segment"), F.col("brand")))).first()[0])
    items = cut_lineage(catalog.select(F.col(roles.price).cast("double").alias("price"), F.col(roles.segment).alias("segment"), F.col(roles.brand).alias("brand"))
                        .where(F.col(roles.price).isNotNull() & ~F.isnan("price")), "index_items")
    cuts = _price_cuts(items, rows_per_range)
    asked = _asked(requests, cuts)
    prices = _ranged(_posted(items, kinds or [0]), "price", cuts).groupBy(*CELL, "price").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("double")
    events = (prices.select(*CELL, "price", "n", F.col("price").alias("at"), F.lit(None).cast(asked.schema["scenario"].dataType).alias("scenario"))
              .unionByName(asked.select(*CELL, none.alias("price"), F.lit(0).cast("long").alias("n"), F.col("budget").alias("at"), "scenario")))
    ranges = events.groupBy(*CELL).agg(F.sum("n").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"))
    before = Window.partitionBy(*GROUP).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = ranges.select(*CELL, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.min("lo").over(before).alias("lo0"), F.max("hi").over(before).alias("hi0"))
    so_far = Window.partitionBy(*CELL).orderBy("at", F.col("scenario").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = events.select(*CELL, "scenario", F.sum("n").over(so_far).alias("n1"), F.min("price").over(so_far).alias("lo1"), F.max("price").over(so_far).alias("hi1"))
    out = met.where(F.col("scenario").isNotNull()).join(ranges, CELL)
    return out.select("scenario", (F.col("n0") + F.col("n1")).cast("long").alias("candidates"), F.least("lo0", "lo1").alias("min_price"),
                      F.greatest("hi0", "hi1").alias("max_price")).where("candidates > 0")
