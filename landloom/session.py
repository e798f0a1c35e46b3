"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "landloom", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local data would otherwise end in one task after every shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # call-site capture costs several JVM round trips per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  A temporary folder is
    used only on a local master without that setting.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    made = tempfile.mkdtemp(prefix="landloom-ckpt-")
    sc.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read again, for tables whose size a checkpoint would multiply.

    Columns are compressed, and the size of the files is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
