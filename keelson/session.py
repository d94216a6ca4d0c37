"""Session settings and the scratch folder jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "keelson", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Write partitioned tables without sorting each task's rows by partition first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Batch ids, load times and dates are all UTC, so timestamps must be read as UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine: executors on
    other machines would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
