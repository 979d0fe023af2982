"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    ``spark.checkpoint.dir`` of the session names it; else the folder set on the context, if any.
    Only a local master may have neither, as in tests: there, and only there, driver and executors
    are one process, and a folder beside the warehouse is set on the context.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-checkpoints"
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    return "/".join([checkpoint_root(spark), "tessera", *parts, uuid.uuid4().hex])
