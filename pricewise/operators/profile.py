"""Table profiling: every statistic for every column in one pass.

Columns are unpivoted to (column, value) rows and aggregated by column, so an
86-column table costs one scan and one small exchange instead of 86 jobs.
Distinct counts go through a (column, value) aggregate first, which spreads
high-cardinality columns across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.functions.clean import TIER_ORDER, price_tier, to_numeric_lenient
from pricewise.sources.tables import quote

# Profile thresholds and defaults.
EXTREME_RATIO = 0.9
TOP_K = 15
NUMERIC_MIN_COUNT = 50
NUMERIC_MIN_SHARE = 0.3
COLUMN_BINS = 30
PRICE_BINS = 60


def long_values(df: DataFrame, cols=None) -> DataFrame:
    """(column, value) rows, every value cast to text; column order kept in ``pos``."""
    cols = cols or df.columns
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                               F.col(quote(c)).cast("string").alias("value")) for i, c in enumerate(cols)])
    return df.select(F.inline(pairs))


def column_profile(df: DataFrame, cols=None, approx: bool = False, with_dtype: bool = True) -> DataFrame:
    """Per column: missing, missing ratio, distinct non-null, distinct / non-missing."""
    cols = cols or df.columns
    n = F.count(F.lit(1))
    longv = long_values(df, cols)
    if approx:
        per = longv.groupBy("pos", "column").agg(
            n.alias("n"), F.count_if(F.col("value").isNull()).alias("missing"),
            F.approx_count_distinct("value").alias("unique"))
    else:
        # distinct first on (column, value): spreads wide columns over tasks; of long
        # texts only a 256-bit digest is shuffled, marked apart from short values
        key = F.when(F.length("value") > 64, F.concat(F.lit("#"), F.sha2(F.col("value").cast("binary"), 256))).otherwise(F.concat(F.lit("="), F.col("value")))
        longv = longv.withColumn("value", key)
        dv = longv.groupBy("pos", "column", "value").agg(n.alias("c"))
        per = dv.groupBy("pos", "column").agg(
            F.sum("c").alias("n"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("missing"),
            F.count("value").alias("unique"))
    out = per.select(
        "pos", "column",
        F.col("missing").cast("bigint").alias("missing"),
        F.when(F.col("n") > 0, F.col("missing") / F.col("n")).otherwise(0.0).alias("missing_ratio"),
        F.col("unique").cast("bigint").alias("unique"),
        F.when(F.col("n") - F.col("missing") > 0, F.col("unique") / (F.col("n") - F.col("missing")))
         .otherwise(0.0).alias("unique_ratio_non_missing"))
    if with_dtype:
        types = df.sparkSession.createDataFrame(
            [(c, df.schema[c].dataType.simpleString()) for c in cols], "column string, dtype string")
        out = out.join(F.broadcast(types), "column", "left")
    return out.orderBy("pos").drop("pos")


def profile_extremes(profile: DataFrame, ratio: float = EXTREME_RATIO) -> DataFrame:
    return profile.filter((F.col("missing_ratio") > ratio) | (F.col("unique_ratio_non_missing") > ratio))


def duplicate_group_sizes(df: DataFrame, keys) -> DataFrame:
    """Rows with every key present, grouped by key; then number of groups per size."""
    sizes = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"))
    return (sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("number_of_groups"))
            .orderBy("group_size"))


def top_k_values(df: DataFrame, cols=None, k: int = TOP_K) -> DataFrame:
    """Most frequent non-null values of every column (ties: value ascending)."""
    from pricewise.operators.heavy import top_k
    return top_k(df, cols, k)


def numeric_like(df: DataFrame, cols=None) -> DataFrame:
    """A text column is numeric-like when its parsed count reaches
    max(50, int(0.3 * non_missing))."""
    longv = long_values(df, cols)
    per = longv.groupBy("pos", "column").agg(
        F.count("value").alias("non_missing"),
        F.count(to_numeric_lenient(F.col("value"))).alias("numeric_count"))
    thr = F.greatest(F.lit(NUMERIC_MIN_COUNT).cast("bigint"),
                     F.floor(F.col("non_missing") * F.lit(NUMERIC_MIN_SHARE)).cast("bigint"))
    return (per.withColumn("threshold", thr)
            .withColumn("is_numeric_like", F.col("numeric_count") >= F.col("threshold"))
            .orderBy("pos").drop("pos"))


def histogram(df: DataFrame, col: str, bins: int = COLUMN_BINS) -> DataFrame:
    """Equal-width bins over [min, max] with the edge corrections of
    ``numpy.histogram``; every bin is reported, empty ones with 0. A constant
    column is widened by 0.5 on both sides."""
    x = F.col(quote(col)).cast("double")
    vals = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    rng = vals.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    rng = rng.select(
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    n = float(bins)

    def edge(i):
        return F.when(i >= bins, F.col("hi")).otherwise(i * ((F.col("hi") - F.col("lo")) / F.lit(n)) + F.col("lo"))

    raw = F.floor((F.col("x") - F.col("lo")) * (F.lit(n) / (F.col("hi") - F.col("lo")))).cast("int")
    raw = F.when(raw >= bins, bins - 1).otherwise(raw)
    fixed = (F.when(F.col("x") < edge(F.col("_i")), F.col("_i") - 1)
             .when((F.col("x") >= edge(F.col("_i") + 1)) & (F.col("_i") != bins - 1), F.col("_i") + 1)
             .otherwise(F.col("_i")))
    binned = (vals.crossJoin(F.broadcast(rng)).withColumn("_i", raw).withColumn("bin", fixed)
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .crossJoin(F.broadcast(rng))
            .select("bin", edge(F.col("bin")).alias("bin_left"), edge(F.col("bin") + 1).alias("bin_right")))
    return (grid.join(binned, "bin", "left")
            .select("bin", "bin_left", "bin_right", F.coalesce(F.col("count"), F.lit(0)).alias("count"))
            .orderBy("bin"))


def tier_counts(df: DataFrame, price_col: str) -> DataFrame:
    """Rows per price tier; all four tiers are reported (0 when empty)."""
    spark = df.sparkSession
    tiers = spark.createDataFrame([(i, t) for i, t in enumerate(TIER_ORDER)], "tier_order int, tier string")
    counts = (df.select(price_tier(price_col).alias("tier")).filter(F.col("tier").isNotNull())
              .groupBy("tier").agg(F.count(F.lit(1)).alias("count")))
    return (tiers.join(counts, "tier", "left")
            .select("tier_order", "tier", F.coalesce(F.col("count"), F.lit(0)).alias("count"))
            .orderBy("tier_order"))


def input_summary(tables: dict) -> DataFrame:
    """Per table: rows, columns, total nulls, number of text columns."""
    parts = []
    for name, df in tables.items():
        nulls = [F.count_if(F.col(quote(c)).isNull()) for c in df.columns]
        total = nulls[0]
        for e in nulls[1:]:
            total = total + e
        text_cols = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("null_total"))
                     .select(F.lit(name).alias("file"), "rows", F.lit(len(df.columns)).alias("cols"),
                             "null_total", F.lit(text_cols).alias("object_cols")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sorted_index_curve(df: DataFrame, col: str, points: int = 101) -> DataFrame:
    """The sorted-value curve as a percentile grid (q = 0, 1/(points-1), ..., 1).
    A global row position would need one task over the whole column."""
    from pricewise.operators.quantiles import exact_quantiles
    qs = [i / (points - 1) for i in range(points)]
    q = exact_quantiles(df, col, qs)
    return q.select(F.col("qi").alias("point"), (F.col("qi") / F.lit(float(points - 1))).alias("quantile"), "value")
