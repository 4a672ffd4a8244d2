"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    ANSI mode stays on; the code uses ``try_*`` functions where dirt is expected.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, which is one process, without ``spark.checkpoint.dir`` gets a temporary folder of its own, removed at its end.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app], ignore_errors=True)
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Whether Spark drops what a query shuffled when the query ends, rather than when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes that adaptive execution gathers into one task, and what layers are written with. A task sorts the rows it reads several times over
#: (both sides of a join, what is to be deduplicated), each some ten times as large as in the shuffle: 64 MB, the default, spill.
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
LAYER_TASK_BYTES = 16 * 1024 * 1024


def _given(spark: SparkSession, key: str) -> str | None:
    """What a setting was set to; nothing where Spark goes by its default."""
    return spark.conf.getAll.get(key)


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = _given(spark, key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block leave no shuffle files. For those whose result is written: nothing reads their shuffles again."""
    with _set(spark, DROP_SHUFFLES, "true"):
        yield


@contextlib.contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block gather no more than ``LAYER_TASK_BYTES`` into a task, less where the session asks for less."""
    asked = _given(spark, TASK_BYTES)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(asked) if asked else LAYER_TASK_BYTES
    with _set(spark, TASK_BYTES, str(min(size, LAYER_TASK_BYTES))):
        yield
