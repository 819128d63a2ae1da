"""Feature transforms with exact (pandas-equal) statistics.

MLlib's ``Imputer`` median is approximate and ``StandardScaler`` divides by
the sample std, so both are written as one aggregate (exact median, mean,
population std) broadcast back onto the rows: one row of statistics, no
shuffle of the data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.operators.common import Roles
from pricewise.sources.tables import TARGET_COL, quote

BRAND_PREFIX = "cat__brand_group_"
NUM_PREFIX = "num__"
OTHER = "Other"
MAX_CATEGORIES = 1000


def column_medians(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """One row: the exact median of each column (NULLs skipped)."""
    if approx:
        return df.agg(*[F.percentile_approx(quote(c), 0.5, 100000).cast("double").alias(c) for c in cols])
    from pricewise.operators.quantiles import column_medians_exact
    return column_medians_exact(df, cols)


def median_impute(df: DataFrame, cols, medians: DataFrame | None = None, approx: bool = False) -> DataFrame:
    """Fill NULLs with the column median (fitted on ``df`` unless given)."""
    med = medians if medians is not None else column_medians(df, cols, approx)
    med = med.select(*[F.col(quote(c)).alias(f"_med_{i}") for i, c in enumerate(cols)])
    out = df.crossJoin(F.broadcast(med))
    for i, c in enumerate(cols):
        out = out.withColumn(c, F.coalesce(F.col(quote(c)).cast("double"), F.col(f"_med_{i}")))
    return out.drop(*[f"_med_{i}" for i in range(len(cols))])


def scaler_stats(df: DataFrame, cols) -> DataFrame:
    """One row: mean and population std of each column; a std of 0 becomes 1."""
    aggs = []
    for i, c in enumerate(cols):
        sd = F.stddev_pop(quote(c))
        aggs += [F.avg(quote(c)).alias(f"_mu_{i}"),
                 F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd).alias(f"_sd_{i}")]
    return df.agg(*aggs)


def standardize(df: DataFrame, cols, stats: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """(x - mean) / std_pop for each column (statistics fitted on ``df`` unless given)."""
    st = stats if stats is not None else scaler_stats(df, cols)
    out = df.crossJoin(F.broadcast(st))
    for i, c in enumerate(cols):
        out = out.withColumn(prefix + c, (F.col(quote(c)) - F.col(f"_mu_{i}")) / F.col(f"_sd_{i}"))
    return out.drop(*[f"_{p}_{i}" for i in range(len(cols)) for p in ("mu", "sd")])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values (the category vocabulary)."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def vocabulary(df: DataFrame, col: str, most: int = MAX_CATEGORIES) -> list:
    """Category list for one-hot columns; more than ``most`` values are refused, as each
    becomes a column."""
    found = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} different values, too many for one column each")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, col: str, values, prefix: str, other: str | None = OTHER) -> DataFrame:
    """0/1 indicator per known value; an unknown value goes to ``other`` when that
    column exists; NULL gives all zeros."""
    values = list(values)
    known = F.col(col).isin(values)
    out = df
    for v in values:
        hit = F.col(col) == F.lit(v)
        if other is not None and v == other:
            hit = hit | (F.col(col).isNotNull() & ~known)
        out = out.withColumn(f"{prefix}{v}", F.when(F.coalesce(hit, F.lit(False)), 1.0).otherwise(0.0))
    return out


def readable_price_table(cat: DataFrame, roles: Roles, numeric_cols) -> DataFrame:
    """The "readable" price table: price, brand, premium flag, raw numerics.
    A brand is premium when its mean price is above the catalogue mean (brand
    means are one row per brand; broadcast after a size check)."""
    from pricewise.operators.common import join_small
    brand_mean = cat.groupBy(roles.brand).agg(F.avg(roles.price).alias("_bm"))
    overall = cat.agg(F.avg(roles.price).alias("_om"))
    prem = brand_mean.crossJoin(F.broadcast(overall)).select(
        roles.brand, F.when(F.col("_bm") > F.col("_om"), 1.0).otherwise(0.0).alias("is_premium_brand"))
    out = join_small(cat, prem, roles.brand, "left")
    return out.select(roles.item_id, roles.price, roles.brand, "item_type", "is_premium_brand", *numeric_cols)


def encoded_price_table(readable: DataFrame, roles: Roles, numeric_cols, brands, types=None) -> DataFrame:
    """The "encoded" price table: row_id, ``num__*`` (median-imputed then
    standardised), ``cat__brand_group_*`` and ``cat__item_type_*`` one-hots,
    and the target. Column names follow the reference's encoder."""
    num = ["is_premium_brand"] + list(numeric_cols)
    imp = median_impute(readable, num)
    std = standardize(imp, num, prefix=NUM_PREFIX)
    enc = one_hot(std, roles.brand, brands, BRAND_PREFIX, other=None)
    if types is not None:
        enc = one_hot(enc, "item_type", types, "cat__item_type_", other=None)
    feats = ([NUM_PREFIX + c for c in num] + [BRAND_PREFIX + b for b in brands]
             + (["cat__item_type_" + t for t in types] if types is not None else []))
    return enc.select(F.col(roles.item_id).alias("row_id"), *[F.col(quote(f)) for f in feats],
                      F.col(roles.price).cast("double").alias(TARGET_COL))


def feature_columns(encoded: DataFrame) -> list[str]:
    return [c for c in encoded.columns if c not in ("row_id", TARGET_COL, "fold", "label")]
