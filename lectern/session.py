"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot join key, and a hot write partition, at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # small sides are known by the size of their files, so no job has to measure them
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(app: str = "lectern", master: str | None = None, **extra: str) -> SparkSession:
    """A session for the jobs; on a cluster the submit command gives the master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared folder the cluster names in spark.checkpoint.dir.

    Where that is unset, as in tests, it lies in the warehouse. On a cluster a warehouse
    in a local folder is one of each machine, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.conf.get("spark.master", "local")
        if urlparse(warehouse).scheme in ("", "file") and not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = warehouse.rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"
