"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for correctness (UTC, ANSI) and for scale (AQE, skew join).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pricewise", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster (only read at JVM start)
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and we use it as is. Only when it is
    unset and the master is local (tests) do we create one of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="pricewise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    One job computes it (an unpersisted RDD checkpoint would compute it twice),
    the copy survives executor loss, and later scans of it get column pruning
    and filter push-down, which a checkpointed RDD does not offer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
