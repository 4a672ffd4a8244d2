"""File output on any Hadoop path (local, s3a, abfs, gs), with a check of what was written."""

from __future__ import annotations

import logging
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shuffles_dropped, small_tasks
from tidemark.sources.layers import POINTER, current_path, read_table, table_path

log = logging.getLogger(__name__)

# What becomes of a table once it is defined: given its name, the table to go on with.
Store = Callable[[str, DataFrame], DataFrame]

FORMATS = ("parquet", "csv")

# Left to itself, Spark trims values when it writes CSV and escapes quotes with a backslash.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(
    df: DataFrame, path: str, delimiter: str = ",", encoding: str = "UTF-8", mode: str = "overwrite"
) -> int | None:
    """With a header in each file, values as they are, quotes doubled. Overwriting goes by :func:`_replaced` and returns the rows."""
    writer = lambda rows: rows.write.format("csv").options(**CSV_OPTIONS, sep=delimiter, encoding=encoding)
    if mode == "overwrite":
        return _replaced(df, path, "csv", writer)
    writer(df).mode(mode).save(path)
    return None


def write_json(df: DataFrame, path: str) -> int:
    """JSON Lines, which can be split and appended to. Returns the rows."""
    return _replaced(df, path, "json", lambda rows: rows.write.format("json"))


def write_layer(tables: Mapping[str, DataFrame], base: str, layer: str) -> dict[str, int]:
    """Write each table as Snappy Parquet under ``base/layer/name``; returns the rows per table.

    The rows are counted while writing. An empty table leaves a version with its schema, so that
    reading the layer works, unless an earlier version is there: that one stays. ``layers.read_layer`` reads the current versions.
    """
    rows = {}
    for name, df in tables.items():
        rows[name] = _write_counted(df, table_path(base, layer, name), "parquet")
        if rows[name] == 0:
            log.warning("%s/%s is empty; what was there before stays", layer, name)
    return rows


def leave(name: str, df: DataFrame) -> DataFrame:
    """Go on with the plan itself."""
    return df


def layer_store(base: str, layer: str) -> Store:
    """Write each table and go on with what was written.

    Later steps then read only the columns they need, never repeat the cleaning, and survive the loss of
    an executor without going back to bronze. Where nothing was written, they go on with no rows, not with those of an earlier run.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        if write_layer({name: df}, base, layer)[name] == 0:
            return df.sparkSession.createDataFrame([], df.schema)
        return read_table(df.sparkSession, table_path(base, layer, name))

    return store


def publish_layer(tables: Mapping[str, DataFrame], base: str, layer: str) -> dict[str, bool]:
    """Write a layer to its place in the store and verify each table."""
    return {name: write_object_store(df, table_path(base, layer, name)) for name, df in tables.items()}


def write_object_store(df: DataFrame, path: str, data_format: str = "parquet") -> bool:
    """Write and verify. False for an unknown format, an empty table (what was there stays) or a failed check."""
    data_format = data_format.lower()
    if data_format not in FORMATS:
        log.error("unsupported format %s", data_format)
        return False
    rows = _write_counted(df, path, data_format)
    return rows > 0 and verify_write(df.sparkSession, path, rows, data_format)


# Rows of the table versions written in this session and bytes of each of their text columns, the longest first, by folder (see
# ``written_bytes``). A version is written once, so a size holds for good.
_WRITTEN: dict[str, tuple[int, list[int]]] = {}


def _write_counted(df: DataFrame, path: str, data_format: str) -> int:
    """Write a version of its own under ``path`` and let the pointer name it; returns the rows.

    No data file is moved or overwritten: readers see the version before until the pointer, one small file, is replaced. A failed
    write leaves it as it is, as does one of no rows where there is a version with rows. The version before the last one goes.
    """
    spark, version = df.sparkSession, f"version-{uuid.uuid4().hex}"
    place, seen = f"{path.rstrip('/')}/{version}", Observation()
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).alias(f"text{k}") for k, c in enumerate(strings)]
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *texts).write.format(data_format)
    if data_format == "parquet":
        writer = writer.option("compression", "snappy")
    else:
        writer = writer.options(**CSV_OPTIONS)
    with small_tasks(spark), shuffles_dropped(spark):
        writer.save(place)
    counted, before = _counted(spark, seen, place, data_format), current_path(spark, path)
    rows = counted["rows"]
    if rows == 0 and before != path:
        _remove(spark, place)
        return 0
    _point(spark, path, version)
    _WRITTEN[_plain(place)] = rows, sorted((counted[f"text{k}"] for k in range(len(strings))), reverse=True) if rows else []
    for folder in _folders(spark, path):
        if folder not in (version, before.rsplit("/", 1)[-1]):
            _remove(spark, f"{path.rstrip('/')}/{folder}")
    return rows


def _counted(spark: SparkSession, seen: Observation, place: str, data_format: str) -> Mapping[str, int]:
    """What a write counted. A plan that Spark knows to give no rows may be run without counting; then the files are asked."""
    try:
        return seen.get
    except Py4JJavaError:
        try:
            rows = spark.read.format(data_format).load(place).count()
        except AnalysisException:  # no file at all
            rows = 0
        return defaultdict(int, rows=rows)


def _point(spark: SparkSession, path: str, version: str) -> None:
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    stream = pointer.getFileSystem(spark._jsc.hadoopConfiguration()).create(pointer, True)
    stream.write(bytearray(version, "utf-8"))
    stream.close()


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The versions under ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder) if f.getPath().getName().startswith("version-")]


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _replaced(df: DataFrame, path: str, data_format: str, writer: Callable[[DataFrame], DataFrameWriter]) -> int:
    """Write beside ``path`` and take its place; returns the rows. A failed write leaves what was there, as does one of no rows.

    For plain folders that others read by their path; layers and tables are switched by pointers instead.
    """
    seen, place = Observation(), f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    written = writer(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    written.save(place)
    rows = _counted(df.sparkSession, seen, place, data_format)["rows"]
    _move(df.sparkSession, place, path, replace=rows > 0)
    return rows


def _move(spark: SparkSession, source: str, target: str, replace: bool) -> bool:
    """Put ``source`` in the place of ``target``; if that exists and is not to be replaced, drop ``source``."""
    jvm = spark._jvm.org.apache.hadoop.fs
    new, old, place = (jvm.Path(p) for p in (source, f"{source}-before", target))
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(place):
        if not replace:
            system.delete(new, True)
            return False
        if not system.rename(place, old):
            raise OSError(f"{target} cannot be moved")
    if not system.rename(new, place):
        raise OSError(f"{source} cannot be moved to {target}")
    system.delete(old, True)
    spark.catalog.refreshByPath(target)
    return True


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def written_bytes(df: DataFrame) -> int | None:
    """An upper bound of the bytes of ``df``, if it is columns and rows of one table version written in this session: fixed widths, and
    the bytes counted then of as many text columns as it has, the longest.

    The folder is taken from the plan, without a list of its files.
    """
    known = _WRITTEN.get(_plain(_folder(df) or ""))
    if known is None:
        return None
    strings = sum(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema.fields)
    return known[0] * 16 * len(df.columns) + sum(known[1][:strings])


def _folder(df: DataFrame) -> str | None:
    """The folder of files that ``df`` is columns and rows of, if it is one."""
    plan = df._jdf.queryExecution().analyzed()
    while (kind := plan.getClass().getSimpleName()) in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    if kind != "LogicalRelation":
        return None
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.location().rootPaths().length() != 1:
        return None
    return relation.location().rootPaths().apply(0).toString()


def discard(df: DataFrame) -> None:
    """Remove a table that a :func:`layer_store` of this session wrote, once what was built on it is written too; any other table stays."""
    folder = _folder(df) or ""
    if _WRITTEN.pop(_plain(folder), None) is not None:
        _remove(df.sparkSession, folder.rsplit("/", 1)[0])


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Hive directories ``col=value``. Rows without a value go to the default partition. Returns the rows; no rows replace none.

    The rebalance hint gathers each value in few files and splits a value that is too large for one
    task, where a plain ``repartition`` by value would not.
    """

    def writer(rows: DataFrame) -> DataFrameWriter:
        balanced = rows.hint("rebalance", *[F.col(c) for c in columns])
        return balanced.write.format("parquet").option("compression", "snappy").partitionBy(*columns)

    return _replaced(df, path, "parquet", writer)


def list_dataset_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of change of every file below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    )
    return files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("last_modified"))


def verify_write(spark: SparkSession, path: str, rows: int, data_format: str = "parquet") -> bool:
    """The files are there, none is empty, and they hold ``rows`` rows."""
    path = current_path(spark, path)
    size = list_dataset_files(spark, path, f"*.{data_format}").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("size_bytes") == 0).alias("empty")
    ).first()
    if size["files"] == 0 or size["empty"] > 0:
        return False
    reader = spark.read.options(**CSV_OPTIONS, multiLine="true") if data_format == "csv" else spark.read
    return reader.format(data_format).load(path).count() == rows
