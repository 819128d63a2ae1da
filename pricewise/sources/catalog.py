"""Catalogue views over the driver's star-schema tables.

The library's operators work on a *catalogue*: one row per item with an id,
brand, price in EUR, a 0-100 spec score, numeric spec features and a derived
value score. Two bindings exist:

* ``part_catalog``  - one row per part; features from that part's line items.
* ``order_catalog`` - one row per order; features from that order's lines.

Both aggregate ``lineitem`` once, grouped by the join key, so the join to the
item table reuses the aggregate's hash partitioning (one shuffle per side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.clean import ppr_ratio, price_tier
from pricewise.sources.tables import read_table

DEFAULT_AS_OF_YEAR = 2026

# Numeric feature columns every catalogue carries (besides price and spec).
CATALOG_FEATURES = ["size", "n_lines", "avg_quantity", "avg_discount", "avg_extendedprice", "item_age"]


def _line_stats(lineitem: DataFrame, key: str) -> DataFrame:
    return (lineitem.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum("l_quantity").alias("sum_quantity"),
                 F.avg("l_quantity").alias("avg_quantity"),
                 F.avg("l_discount").alias("avg_discount"),
                 F.avg("l_extendedprice").alias("avg_extendedprice"),
                 F.min("l_shipdate").alias("first_shipdate")))


def _finish(df: DataFrame) -> DataFrame:
    return (df.withColumn("value_score", F.lit(100.0) * ppr_ratio("spec_score_0_100", "price_eur"))
              .withColumn("price_tier", price_tier("price_eur")))


def part_catalog(spark: SparkSession, source: str, as_of_year: int = DEFAULT_AS_OF_YEAR) -> DataFrame:
    part = read_table(spark, source, "part")
    lines = read_table(spark, source, "lineitem").select(
        "l_partkey", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate")
    stats = _line_stats(lines, "l_partkey")
    cat = part.join(stats, part.p_partkey == stats.l_partkey, "left")
    return _finish(cat.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("oem"),
        F.col("p_name").alias("model"),
        F.col("p_brand").alias("brand_group"),
        F.col("p_type").alias("item_type"),
        F.col("p_retailprice").cast("double").alias("price_eur"),
        (F.lit(100.0) * (F.col("p_size") - 1) / F.lit(49.0)).alias("spec_score_0_100"),
        F.col("p_size").cast("double").alias("size"),
        F.col("n_lines").cast("double").alias("n_lines"),
        F.col("avg_quantity"),
        F.col("avg_discount"),
        F.col("avg_extendedprice"),
        (F.lit(float(as_of_year)) - F.year("first_shipdate")).cast("double").alias("item_age"),
    ))


def order_catalog(spark: SparkSession, source: str, as_of_year: int = DEFAULT_AS_OF_YEAR,
                  materialize: bool = False) -> DataFrame:
    """Large catalogue: one row per order. The spec score is the order's total
    quantity scaled to 0-100 by the largest total (a one-row aggregate joined
    back by broadcast). With ``materialize`` the per-order line statistics are
    written once, so the join and the maximum do not aggregate ``lineitem``
    twice."""
    orders = read_table(spark, source, "orders")
    lines = read_table(spark, source, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate")
    stats = _line_stats(lines, "l_orderkey")
    if materialize:
        from pricewise.session import cut_lineage
        stats = cut_lineage(stats)
    top = stats.agg(F.max("sum_quantity").alias("max_quantity"))
    cat = orders.join(stats, orders.o_orderkey == stats.l_orderkey, "left").crossJoin(F.broadcast(top))
    return _finish(cat.select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderpriority").alias("oem"),
        F.col("o_orderstatus").alias("model"),
        F.col("o_orderpriority").alias("brand_group"),
        F.col("o_orderstatus").alias("item_type"),
        F.col("o_totalprice").cast("double").alias("price_eur"),
        F.try_divide(F.lit(100.0) * F.col("sum_quantity"), F.col("max_quantity")).alias("spec_score_0_100"),
        F.col("sum_quantity").cast("double").alias("size"),
        F.col("n_lines").cast("double").alias("n_lines"),
        F.col("avg_quantity"),
        F.col("avg_discount"),
        F.col("avg_extendedprice"),
        (F.lit(float(as_of_year)) - F.year("o_orderdate")).cast("double").alias("item_age"),
    ))


CATALOGS = {"part": part_catalog, "orders": order_catalog}


def catalog(spark: SparkSession, source: str, kind: str = "part",
            as_of_year: int = DEFAULT_AS_OF_YEAR) -> DataFrame:
    return CATALOGS[kind](spark, source, as_of_year)


def catalog_table(spark: SparkSession, source: str, kind: str = "part",
                  as_of_year: int = DEFAULT_AS_OF_YEAR) -> DataFrame:
    """The catalogue computed once and written to the shared checkpoint folder.

    Every statistic of the value pipeline (cuts, fold sums, segment means,
    medians and spreads) is an aggregate over the catalogue; without this
    each of them would re-scan and re-aggregate ``lineitem`` (their column
    sets differ, so Spark cannot reuse one exchange for all of them).
    """
    from pricewise.session import cut_lineage
    if kind == "orders":
        return cut_lineage(order_catalog(spark, source, as_of_year, materialize=True))
    return cut_lineage(catalog(spark, source, kind, as_of_year))


def messy_price_text(spark: SparkSession, source: str) -> DataFrame:
    """Price text in several currencies and dirty forms, derived from ``part``
    (one form per ``p_partkey % 8``), for the cleaning functions."""
    part = read_table(spark, source, "part").select("p_partkey", "p_retailprice")
    p = F.col("p_retailprice").cast("string")
    k = F.col("p_partkey") % 8
    text = (F.when(k == 0, F.concat(F.lit("About "), p, F.lit(" EUR")))
            .when(k == 1, F.concat(F.lit("$ "), p))
            .when(k == 2, F.concat(F.lit("<c2><a3>"), p))
            .when(k == 3, F.concat(F.lit("  "), p, F.lit(" inr  ")))
            .when(k == 4, F.lit(" - "))
            .when(k == 5, F.concat(F.lit("<e2><82><ac>1,"), p, F.lit(" / "), p, F.lit(" USD")))
            .when(k == 6, F.concat(p, F.lit("EURO")))
            .otherwise(F.lit("N/A")))
    return part.select(F.col("p_partkey").alias("item_id"), text.alias("misc_price"))
