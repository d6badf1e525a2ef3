"""Session helpers.

Library code never creates its own session; it takes the one it is given.
``get_spark`` is for tests, the bench and examples only.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A session configured the way the library expects (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(master or os.environ.get("TIDEMARK_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    event_dir = os.environ.get("TIDEMARK_EVENT_LOG_DIR")
    if event_dir:  # the bench reads stage metrics from the event log, never from the UI
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir).config(
            "spark.eventLog.compress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local master may leave it unset (tests): then a folder is chosen and
    set.  Any other master must name a folder that all executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = spark.sparkContext.master
        if not master.split("[")[0] == "local":
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder below the shared checkpoint dir for written intermediates."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that Python workers can import it wherever they start."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tidemark", os.path.relpath(path, root)))
    context.addPyFile(target)
    context._tidemark_shipped = True
