"""Session settings used by tests and the benchmark.

On a cluster the submitter's settings win: every value below is only a default for a local run.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "dailypanel") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables should still use all cores; on a cluster the default of 1 MB is right.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DAILYPANEL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a scratch folder on a local run only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="dailypanel-checkpoint-"))


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "dailypanel_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="dailypanel-")) / "dailypanel_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context.dailypanel_shipped = True
