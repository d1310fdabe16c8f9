"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Recommended, never required: operators give the same rows under other settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Archive records are tens of kilobytes, so a batch of 10,000 would be hundreds of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(master: str | None = None, app: str = "webcorpus", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Bound what a Python worker is handed at once, by rows and by bytes: documents differ in length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A session without one gets a temporary folder, but only where driver and executors are one
    process: elsewhere each machine would see a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            master = context.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="webcorpus-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for tables that cut lineage."""
    return f"{checkpoint_dir(spark).rstrip('/')}/webcorpus/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Python workers need the package for the Arrow functions, wherever they were started from;
    ship it once per application."""
    context = spark.sparkContext
    if getattr(context, "_webcorpus_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="webcorpus-"), "webcorpus.zip")
    with zipfile.ZipFile(archive, "w") as package:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                package.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    context._webcorpus_shipped = True
