"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting, a local session (as in tests) gets a folder of its own and a cluster is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
