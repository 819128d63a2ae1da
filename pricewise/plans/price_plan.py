"""Price tables for the modelling jobs, bound to the part catalogue.

readable: one row per item with price, brand, premium flag and raw numerics.
encoded : row_id, standardised ``num__*``, brand and type one-hots, target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.clean import log_target
from pricewise.operators.common import CATALOG_ROLES, Roles
from pricewise.operators.features import encoded_price_table, feature_columns, readable_price_table, vocabulary
from pricewise.operators.folds import kfold_assign
from pricewise.operators.reports import univariate_importance
from pricewise.session import cut_lineage
from pricewise.sources.catalog import catalog, catalog_table
from pricewise.sources.tables import TARGET_COL

NUMERIC_COLS = ["size", "n_lines", "avg_quantity", "avg_discount", "avg_extendedprice", "item_age"]


def readable(spark: SparkSession, src: str, kind: str = "part", roles: Roles = CATALOG_ROLES) -> DataFrame:
    return cut_lineage(readable_price_table(catalog_table(spark, src, kind), roles, NUMERIC_COLS))


def encoded(spark: SparkSession, src: str, kind: str = "part", roles: Roles = CATALOG_ROLES) -> DataFrame:
    """Encoded table, materialised once: model fits scan it many times."""
    r = readable(spark, src, kind, roles)
    return cut_lineage(encoded_price_table(r, roles, NUMERIC_COLS, vocabulary(r, roles.brand),
                                           vocabulary(r, "item_type")))


def encoded_with_folds(spark: SparkSession, src: str, kind: str = "part") -> DataFrame:
    return kfold_assign(encoded(spark, src, kind), "row_id")


def importance_by_correlation(spark: SparkSession, src: str, kind: str = "part") -> DataFrame:
    """Two model-free importance tables (|corr| with price and with log price)
    stacked long, the shape the importance reports consume."""
    enc = encoded(spark, src, kind)
    feats = feature_columns(enc)
    a = univariate_importance(enc, feats, TARGET_COL, "abs_corr (price_eur)")
    b = univariate_importance(enc.withColumn("_logy", log_target(TARGET_COL, "log_price_eur")), feats, "_logy",
                              "abs_corr (log_price_eur)")
    return a.unionByName(b)
