"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "steadyline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Adaptive execution sizes shuffle partitions and splits skewed joins; the UTC zone keeps
    wall-clock text and absolute ingest times comparable. ``conf`` overrides any of them.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    On a cluster that setting names storage every executor reaches, and it is required there. In one
    process (tests) a temporary folder stands in where it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="steadyline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
