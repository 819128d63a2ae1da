"""Writing results: tables, JSON documents and the model package.

Everything goes through Spark writers into a shared folder (never a
machine-local path on a cluster); each result is written once.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators.forest import ForestModel, read_forest
from pricewise.operators.gram import LinearModel


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> str:
    """Overwrite ``path`` with ``df``. CSV gets a header and no index column.
    ``single_file`` is only for small report tables (it funnels one task)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w = w.options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    w.format(fmt).save(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    return write_table(df, path, "csv", single_file)


def write_json(df: DataFrame, path: str) -> str:
    return write_table(df, path, "json")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def write_model(model, path: str, meta: dict) -> str:
    """Model package: the fitted model plus a JSON sidecar with what serving needs (target
    mode, model name, feature names). A linear model is a table of its coefficients, a deep
    forest one of its subtrees, any other a pipeline in MLlib's own format."""
    spark = SparkSession.getActiveSession()
    linear, forest = isinstance(model, LinearModel), isinstance(model, ForestModel)
    if linear:
        rows = [(-1, None, model.intercept), *((i, f, float(w)) for i, (f, w) in enumerate(zip(model.features, model.coefficients.toArray())))]
        spark.createDataFrame(rows, "place int, feature string, coefficient double").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "model"))
    elif forest:
        meta = {**meta, "forest": model.write(os.path.join(path, "model"))}
    else:
        model.write().overwrite().save(os.path.join(path, "model"))
    sidecar = {**meta, "kind": "linear" if linear else "forest" if forest else "pipeline"}
    spark.createDataFrame([(json.dumps(sidecar, sort_keys=True),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "meta"))
    return path


def load_model(path: str) -> tuple:
    """(model, sidecar) of a package."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    if meta.get("kind") == "linear":
        rows = spark.read.parquet(os.path.join(path, "model")).orderBy("place").collect()  # one row per feature
        return LinearModel([r.feature for r in rows[1:]], [r.coefficient for r in rows[1:]], rows[0].coefficient), meta
    if meta.get("kind") == "forest":
        return read_forest(spark.read.parquet(os.path.join(path, "model")), meta.pop("forest")), meta
    return PipelineModel.load(os.path.join(path, "model")), meta


def blend_weights_json(weights: DataFrame) -> DataFrame:
    """Blend weights as one JSON object {model: weight} (one row)."""
    return weights.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("model", "weight")))).alias("blend_weights"))
