"""Session settings every plan relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Naive local times must not move with the session zone, and wide expression
# trees (about 60 output columns) must stay inside generated code.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "slotcast", **conf) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to a session made elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by driver and executors: the cluster's own ``spark.checkpoint.dir``.

    Only a session whose executors are the driver process itself may fall back to a folder of this machine.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            shared = tempfile.mkdtemp(prefix="slotcast-checkpoint-")
        spark.sparkContext.setCheckpointDir(shared)
        current = spark.sparkContext.getCheckpointDir()
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Writes an intermediate table to the shared checkpoint folder and reads it back.

    For tables that several later jobs read: their plans start from a column-pruned
    scan instead of repeating windows, and a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/slotcast-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
