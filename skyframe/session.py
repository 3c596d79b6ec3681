"""Session helpers: one place for the Spark settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every skyframe job expects. Local time is kept as TIMESTAMP_NTZ and the
# session zone is pinned to UTC so that no implicit zone shift happens anywhere.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "skyframe",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Set ``fallback`` as checkpoint folder only when the session names none
    (tests and local runs). On a cluster the configured folder always wins."""
    d = checkpoint_dir(spark)
    if d:
        return d
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return checkpoint_dir(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``. A session
    that names none may run only in a single process (master ``local[...]``),
    where one folder is made for it; on a cluster this raises, because a
    machine-local folder would lose rows."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="skyframe-local-"))
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def exchange_parts(spark: SparkSession) -> int:
    """Partitions of an exchange whose rows expand or compress strongly. Adaptive
    execution packs partitions by their compressed size, and millions of grid rows
    compress to a few MB; a count that is given is kept, so that a task's share of
    the rows stays the same however well they compress."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder
    (:func:`shared_dir`) and continue from the written table, so later stages
    and lost executors do not recompute the whole plan."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/skyframe-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

