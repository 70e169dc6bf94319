"""Session helpers: settings the engine wants, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app_name: str = "textwarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session may go without ``spark.checkpoint.dir``: a machine-local
    folder is of no use to executors on other machines.
    """
    base = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="textwarden-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/textwarden-{uuid.uuid4().hex}"
