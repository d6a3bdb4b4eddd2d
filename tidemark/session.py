"""A session with the settings that the library counts on, and the folder that a cluster shares."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Times are UTC; AQE may merge, split and re-plan, and splits what a hot key makes large in a join. Everything else is the cluster's own setting."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from spark.checkpoint.dir.

    Where that is unset, a local folder if driver and executors are one process, as in tests; a cluster gets an error.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not found and not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found or _own_folder()


def scratch(spark: SparkSession, name: str = "t") -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
