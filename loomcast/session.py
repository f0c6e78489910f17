"""Session set-up shared by tests, the benchmark and scripts."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loomcast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers.

    Not needed where it is installed on every node.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="loomcast-")
    archive = shutil.make_archive(
        f"{folder}/loomcast_package", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for results in the shared folder the cluster names."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomcast-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
