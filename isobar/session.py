"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE coalesces from the high initial partition count, splits skewed join
# partitions and turns joins with a small measured side into broadcasts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Fair tasks and files of a useful size on large inputs.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Row counts from ANALYZE, where a table has them, order the joins.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.orc.filterPushdown": "true",
}


def builder(app: str = "isobar") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local_session(cpus: int | str = 8, memory: str = "8g", app: str = "isobar") -> SparkSession:
    """A session for tests and the local benchmark."""
    spark = (
        builder(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="isobar-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting a session on one machine uses a folder in its warehouse; a
    cluster is refused.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one; no two calls share it."""
    return f"{shared_dir(spark).rstrip('/')}/isobar/{name}-{uuid.uuid4().hex}"


def work_table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"
