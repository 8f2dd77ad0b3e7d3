"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # state of the streaming operators; needed by transformWithStateInPandas
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session that was built elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(key, SETTINGS[key])
    # Python workers on this machine find the package where the driver did; on a cluster it is installed or sent
    here = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [here, *paths]))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; in local mode a fresh one when that is unset."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def lookup(side: DataFrame) -> DataFrame:
    """Compute a join side that is used twice once, by a reliable checkpoint; AQE measures it and picks the join."""
    shared_dir(side.sparkSession)
    return side.checkpoint()


def written(rows: DataFrame, label: str) -> DataFrame:
    """Compute rows that are read twice once, by a table in the shared folder; it is smaller than a checkpoint."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
