"""Session construction and the shared working folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}

# Bytes of one Arrow batch: a worker holds whole batches and several copies of them as
# Python objects, and a number of rows alone does not bound long texts.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(
    app_name: str = "threadloom", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the settings every job here relies on.

    UTC keeps timestamps comparable, AQE re-plans joins and splits skewed
    partitions, and the Arrow batch sizes bound what one Python call holds.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        _BATCH_SETTING: str(BATCH_BYTES),
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` in a caller's session; a smaller bound is kept."""
    given = int(spark.conf.get(_BATCH_SETTING).rstrip("b"))
    if given <= 0 or given > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="threadloom-")
    return _LOCAL_FALLBACK[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/threadloom/{uuid.uuid4().hex}/{name}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, and bound the batches that reach Python.

    Functions that run in tasks are pickled by reference, so every Python worker
    has to be able to import the package, from whatever folder the driver runs.
    """
    bound_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    target = os.path.join(tempfile.mkdtemp(prefix="threadloom-"), "threadloom-package.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
