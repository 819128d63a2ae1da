"""Serving requests as a stream.

The reference answers one request at a time from a command line. Here
requests arrive as files in a folder (any Structured Streaming source works)
and every micro-batch is answered by the same batch jobs: recommendations for
budget scenarios, or fair-price guides for planned products. Results are
appended to a sink table; the checkpoint folder makes the query restartable
after executor or driver loss (each batch is written exactly once per epoch
through ``foreachBatch`` + an idempotent, epoch-keyed write).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.operators.common import Roles
from pricewise.operators.recommend import SCENARIO_SCHEMA, scenario_topn


def scenario_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Scenario requests (the scenario table schema) from JSON files."""
    return spark.readStream.schema(SCENARIO_SCHEMA).json(folder)


def serve_recommendations(requests: DataFrame, catalog: DataFrame, out_path: str, checkpoint: str,
                          roles: Roles = Roles(), trigger_once: bool = False):
    """Start a streaming query answering every batch of scenario requests
    against ``catalog`` (a static, ideally persisted, value frame). Each batch
    writes to ``out_path/epoch=<id>`` with overwrite, so a replayed epoch
    replaces its own output instead of duplicating it."""
    def answer(batch: DataFrame, epoch: int):
        if batch.isEmpty():
            return
        recs = scenario_topn(catalog, batch, roles).withColumn("epoch", F.lit(epoch))
        recs.write.mode("overwrite").parquet(os.path.join(out_path, f"epoch={epoch}"))

    w = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def serve_price_guides(requests: DataFrame, guide_fn, out_path: str, checkpoint: str, trigger_once: bool = False):
    """Same for planned-product requests; ``guide_fn(batch) -> DataFrame``
    closes over the fitted model and reference tables."""
    def answer(batch: DataFrame, epoch: int):
        if batch.isEmpty():
            return
        guide_fn(batch).withColumn("epoch", F.lit(epoch)).write.mode("overwrite") \
            .parquet(os.path.join(out_path, f"epoch={epoch}"))

    w = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()
