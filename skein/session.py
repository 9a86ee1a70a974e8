"""Session settings: adaptive execution, UTC, Arrow, and partitions sized for the cluster at hand."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Applied to a new session; a cluster's own settings win where they are given.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def session(name: str = "skein", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use __ for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for k, v in (CONF | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per application: workers need it wherever they are started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver's own folder: its file server hands the archive to the executors
    archive = os.path.join(tempfile.mkdtemp(prefix="skein-"), "skein_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "skein")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
