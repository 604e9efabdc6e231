"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of whole texts that a task sends to its Python worker at a time; a longer one goes alone.
TEXT_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # each column expression would otherwise record its Python call site
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks can then import it wherever the driver found it; an installed package needs no shipping.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="riskloom-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "riskloom.zip", "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(folder / "riskloom.zip"))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="riskloom-")
        # a local session's tables go with the process; a cluster's folder is the cluster's
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
        context.setCheckpointDir(folder)
    return _local_folders[context.applicationId]


@contextmanager
def _batches_of(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Bound the bytes of the batches that go to Python for a while, unless the session does.

    10,000 rows, Spark's own bound, are many MB of whole texts; they stand several times over in
    the executor's buffers and in its workers, and workers keep what they once took.
    """
    if most is None or spark.conf.get(_BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_SETTING)


def stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes read the written columns only, and a lost executor re-reads files instead of
    recomputing the plan.  The folder is the cluster's to expire, like any checkpoint folder.
    ``batch_bytes`` bounds what Python tasks of the plan get at a time; it changes no row.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"
    with _batches_of(spark, batch_bytes):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
