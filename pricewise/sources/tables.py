"""Reading named input tables (parquet or CSV) and the encoded price table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that must never enter price regression features.
LEAKAGE_COLUMNS = [
    "price_tier",
    "value_score",
    "spec_score_0_100",
    "price_per_ram_gb",
    "price_per_storage_gb",
    "battery_per_eur",
    "oem",
    "model",
]

TARGET_COL = "target_price_eur"


def require_columns(df: DataFrame, cols) -> None:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def quote(name: str) -> str:
    """Back-tick a column name (names such as ``battery_stand.by`` contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def read_table(spark: SparkSession, source: str, name: str, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read one named input table from a folder.

    Parquet is the default; ``.csv`` files are read with the options a
    spreadsheet export needs (header, RFC-4180 quote escaping, multi-line cells).
    """
    path = name if os.path.isabs(name) or "://" in name else os.path.join(source, name)
    if fmt is None:
        fmt = "csv" if path.endswith(".csv") else "parquet"
        if fmt == "parquet" and not path.endswith(".parquet") and not os.path.isdir(path):
            path = path + ".parquet"
    if fmt == "csv":
        return read_csv(spark, path, schema=schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """``multi_line`` allows line feeds inside quoted cells, but makes each file one
    task; switch it off for large files without such cells."""
    reader = (spark.read.option("header", "true")
              .option("escape", '"')
              .option("multiLine", str(multi_line).lower())
              .option("encoding", encoding))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        # Every raw column stays text; typing is an explicit later step.
        reader = reader.option("inferSchema", "false")
    return reader.csv(path)


def detect_encoding(spark: SparkSession, path: str) -> str:
    """Pick the first encoding that decodes the whole file: UTF-8 (a BOM is
    stripped by the reader), then CP949 (which needs the session's legacy
    charsets; they are switched on), else ISO-8859-1, which decodes every byte.

    The test is one distributed aggregate over the raw lines; nothing is
    collected but a single boolean.
    """
    lines = spark.read.text(path)
    valid = lines.agg(F.coalesce(F.bool_and(F.is_valid_utf8("value")), F.lit(True))).first()[0]
    if valid:
        return "UTF-8"
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    probe = spark.read.option("encoding", "cp949").option("header", "false").csv(path)
    bad = F.lit(False)
    for c in probe.columns:
        bad = bad | F.coalesce(F.col(quote(c)).contains("\ufffd"), F.lit(False))
    if not probe.agg(F.coalesce(F.bool_or(bad), F.lit(False))).first()[0]:
        return "cp949"
    return "ISO-8859-1"


def read_csv_fallback(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      multi_line: bool = True) -> DataFrame:
    """Read a CSV whose encoding is unknown (see :func:`detect_encoding`)."""
    return read_csv(spark, path, schema=schema, encoding=detect_encoding(spark, path), multi_line=multi_line)


def leakage_report(df: DataFrame, leak_cols=LEAKAGE_COLUMNS) -> DataFrame:
    """Which forbidden columns occur in ``df`` (one row per listed column)."""
    spark = df.sparkSession
    present = set(df.columns)
    rows = [(c, c in present) for c in leak_cols]
    return spark.createDataFrame(rows, "column string, present_in_price_model boolean")


def drop_leakage(df: DataFrame, leak_cols=LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in leak_cols if c in df.columns])


def load_price_features(df: DataFrame, target: str = TARGET_COL, id_col: str | None = "row_id") -> DataFrame:
    """Encoded price table -> (id, features..., label) with leakage removed and
    every feature cast to double."""
    require_columns(df, [target])
    df = drop_leakage(df)
    feats = [c for c in df.columns if c not in (target, id_col)]
    cols = ([F.col(id_col)] if id_col and id_col in df.columns else [])
    cols += [F.col(quote(c)).cast("double").alias(c) for c in feats]
    cols += [F.col(target).cast("double").alias("label")]
    return df.select(*cols)
