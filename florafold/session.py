"""Session helper and table loader.

Everything else in the package takes a ``SparkSession`` or ``DataFrame`` and
never builds its own session, so jobs run unchanged on a cluster session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "florafold",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session: AQE on, UI off, UTC, small shuffle width.

    On a cluster, use the cluster's own session; nothing here is required.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("FLORAFOLD_SHUFFLE_PARTITIONS", str(cpus)))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FLORAFOLD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names; set one only when unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is (without one a cluster session is refused). Only a local session
    without one (tests) gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            # a driver-local folder is not visible to executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (object store / HDFS)")
        conf_dir = tempfile.mkdtemp(prefix="florafold-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the checkpoint folder.

    The checkpoint folder is the shared location the cluster names, so written
    tables survive executor loss and are visible to every executor.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/florafold-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the checkpoint folder as Parquet, and read back.

    Like a checkpoint, but compressed by column, computed once, and with the
    size of its files as its size: a checkpoint keeps the size estimated for
    the plan it cuts off, which loops of joins multiply without end."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
