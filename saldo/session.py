"""Session defaults and the shared folder for materialised intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
TABLES_SETTING = "spark.saldo.tables.dir"


def build_session(master: str | None = None, app: str = "saldo", **settings: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    AQE re-plans joins from measured shuffle sizes and splits skewed
    partitions; ``forceOptimizeSkewedJoin`` keeps that split even where it
    costs one more shuffle further up the plan.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and work tables, as named by the session.

    Only a local session without the setting gets a folder of its own. On a
    cluster a missing setting is an error: executors could not reach a folder
    on the driver's disk.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    chosen = configured or spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not is_local(spark):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="saldo-")
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set(CHECKPOINT_SETTING, own)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so never overwritten."""
    return f"{shared_dir(spark)}/{name}/run={uuid.uuid4().hex}"


def tables_dir(spark: SparkSession) -> str:
    """The folder of stored result tables, apart from checkpoints and kept by nobody else.

    ``spark.saldo.tables.dir`` if set, else the session's warehouse. Only a local
    session without the setting gets a folder of its own.
    """
    chosen = spark.conf.get(TABLES_SETTING, None)
    if chosen is None and is_local(spark):
        chosen = tempfile.mkdtemp(prefix="saldo-tables-")
        spark.conf.set(TABLES_SETTING, chosen)
    return (chosen or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
