"""Delimited text with unknown encoding and delimiter."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import nan_to_null

log = logging.getLogger(__name__)

# The delimiters tried, in this order, and the encodings told apart.
DELIMITERS = (",", ";", "\t")
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"


def sniff_csv_dialect(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file: encoding, delimiter, header line and number of lines.

    The files are read as text, so they stay splittable and only counters per file are shuffled. The
    whole file decides about the encoding: it is UTF-8 if every line is, otherwise Latin-1. A file of
    ASCII alone, such as one of a header without rows, reads the same in both and goes with the others
    of its delimiter if these agree. The delimiter is the first of ``DELIMITERS`` in the header outside
    quotes, a comma if there is none.
    """
    lines = _text(spark, path, pattern).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        # Ids rise within a task, and the start of a file is read by exactly one task.
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("position"),
    )
    files = lines.groupBy("file_path", "file_name").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"),
        F.bool_and(F.octet_length("value") == F.char_length("value")).alias("is_ascii"),
        F.min_by("value", "position").alias("header"),
        F.count(F.lit(1)).alias("lines"),
    )
    unquoted = F.regexp_replace("header", r'"[^"]*"', "")
    delimiter = F.lit(DELIMITERS[0])
    for candidate in reversed(DELIMITERS):
        delimiter = F.when(F.contains(unquoted, F.lit(candidate)), candidate).otherwise(delimiter)
    telling = files.filter("NOT (is_ascii AND is_utf8)").groupBy(delimiter.alias("_delimiter")).agg(F.bool_or("is_utf8").alias("_utf8"))
    files = files.withColumn("delimiter", delimiter).join(F.broadcast(telling), F.col("delimiter") == F.col("_delimiter"), "left")
    return files.select(
        "file_path",
        "file_name",
        F.when(F.col("is_utf8") & ~(F.col("is_ascii") & ~F.coalesce("_utf8", F.lit(True))), UTF8).otherwise(LATIN1).alias("encoding"),
        "delimiter",
        # A Latin-1 header is decoded as such, so that the text is well formed.
        F.when(F.col("is_utf8"), F.col("header"))
        .otherwise(F.decode(F.col("header").cast("binary"), LATIN1))
        .alias("header"),
        "lines",
    )


def _text(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", pattern).text(path)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    expected_columns: Sequence[str] | None = None,
    delimiter: str | None = None,
    encoding: str | None = None,
    pattern: str = "*",
    multiline: bool = False,
) -> DataFrame:
    """A CSV file, or a directory of files of one dialect, with a header line.

    Give ``schema``, ``delimiter`` and ``encoding`` in regular jobs: what is missing costs a pass over
    the data each. A missing path raises; missing expected columns are logged. ``multiline`` allows line
    breaks inside quotes, but then a file is read by one task.
    """
    if delimiter is None or encoding is None:
        dialects = sniff_csv_dialect(spark, path, pattern).select("encoding", "delimiter").distinct().collect()
        if len(dialects) > 1:
            raise ValueError(f"{path} mixes dialects; use read_csv_directory")
        found = dialects[0] if dialects else {"encoding": UTF8, "delimiter": DELIMITERS[0]}
        delimiter, encoding = delimiter or found["delimiter"], encoding or found["encoding"]
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("multiLine", multiline)
        .option("pathGlobFilter", pattern)
    )
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
        header = df.columns
    else:
        header = reader.csv(path).columns  # reads the first line only
        df = by_name(reader.option("enforceSchema", False).schema(in_file_order(schema, header)).csv(path), schema)
    absent = [c for c in expected_columns or [] if c not in header]
    if absent:
        log.warning("%s lacks the columns %s", path, absent)
    return nan_to_null(df)


def in_file_order(schema: T.StructType, header: Sequence[str]) -> T.StructType:
    """The types of ``schema`` in the order of a file's header; columns the schema does not know are text."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in header])


def by_name(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """The columns of ``schema``, NULL where ``df`` has none."""
    here = set(df.columns)
    wanted = [F.col(f.name) if f.name in here else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*wanted, *more)


def exact_path(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\{}\[\]*?,^])", r"\\\1", path)


def read_csv_directory(
    spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.csv"
) -> DataFrame:
    """All files of a directory as one table, tagged with ``source_file``.

    Files are grouped by dialect and header, and each group is one scan of its own files, whose names the driver has from listing
    the directory anyway. Columns are found by their names in the header; those a file lacks are NULL. A malformed line does
    not fail the read: its text is kept in ``_corrupt_record``.
    """
    found = sniff_csv_dialect(spark, directory, pattern)
    groups = found.groupBy("encoding", "delimiter", "header").agg(F.array_sort(F.collect_list("file_path")).alias("files")).collect()
    tolerant = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    if not groups:
        return spark.createDataFrame([], tolerant.add("source_file", T.StringType()))
    whole = None
    for group in sorted(groups, key=lambda g: (g["encoding"], g["delimiter"], g["header"])):
        reader = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("sep", group["delimiter"])
            .option("encoding", group["encoding"])
        )
        files = [exact_path(unquote(f)) for f in group["files"]]  # scans report encoded paths
        header = reader.csv(files[0]).columns
        ordered = in_file_order(schema, header).add("_corrupt_record", T.StringType())
        reader = reader.schema(ordered).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        df = reader.csv(files).select("*", F.col("_metadata.file_name").alias("source_file"))
        part = nan_to_null(by_name(df, tolerant, "source_file"))
        whole = part if whole is None else whole.unionByName(part)
    return whole


def read_csv_tables(
    spark: SparkSession, directory: str, schemas: Mapping[str, T.StructType]
) -> dict[str, DataFrame]:
    """``<name>.csv`` of a directory for each known name. A file that cannot be read is logged and left out."""
    tables = {}
    for name, schema in schemas.items():
        try:
            tables[name] = read_csv(spark, f"{directory.rstrip('/')}/{name}.csv", schema)
        except Exception as problem:  # one bad file must not stop the others
            log.error("%s.csv was skipped: %s", name, problem)
    return tables


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row: number of rows, whether all expected columns are there, and which are missing."""
    absent = missing_columns(df, expected)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(not absent).alias("is_valid"),
        F.array(*[F.lit(c) for c in absent]).cast("array<string>").alias("missing"),
        "row_count",
    )


def file_profile(df: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Name, size, time of change, rows, columns and types of each file behind a file-based table.

    A file without rows shows only if ``listed`` names it (see ``files.list_dataset_files``).
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    plain = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # scans report encoded names
    per_file = df.groupBy(
        plain.alias("file_name"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
    if listed is not None:
        name = F.substring_index("path", "/", -1)
        counts = per_file.select("file_name", "row_count")
        every = listed.select(name.alias("file_name"), "size_bytes", "last_modified").join(counts, "file_name", "left")
        per_file = every.withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    return per_file.withColumns({"column_count": F.lit(len(df.columns)), "data_types": F.lit(kinds)})


def profile_files(listed: DataFrame, read: Callable[[DataFrameReader, list[str]], DataFrame]) -> DataFrame:
    """:func:`file_profile` of the ``listed`` files (see ``files.list_dataset_files``), with -1 rows for one that cannot be read.

    ``read`` makes a table of a reader and paths; it should give a schema. All files are read at once, leaving out those that Spark cannot
    read; only files that gave no row are tried again, to tell empty from broken, one by one if together they fail. A file that breaks off in the
    middle counts as far as it can be read.
    """
    spark = listed.sparkSession
    paths = [exact_path(r["path"]) for r in listed.select("path").collect()]  # the driver has listed them already
    whole = read(spark.read.option("ignoreCorruptFiles", True), paths)
    profile = file_profile(whole, listed)
    silent = {r["path"] for r in listed.join(profile.filter("row_count = 0").select("file_name"), F.substring_index("path", "/", -1) == F.col("file_name")).collect()}

    def readable(some: list[str]) -> bool:
        try:
            read(spark.read, [exact_path(p) for p in some]).write.format("noop").mode("overwrite").save()
        except Exception as problem:
            log.warning("%s cannot be read: %s", some[0] if len(some) == 1 else f"one of {len(some)} files", str(problem).split("\n", 1)[0])
            return False
        return True

    broken = [] if not silent or readable(sorted(silent)) else [p for p in sorted(silent) if not readable([p])]
    names = [(p.rsplit("/", 1)[-1],) for p in broken]
    bad = spark.createDataFrame(names, "file_name string").withColumn("_broken", F.lit(True))
    marked = profile.join(F.broadcast(bad), "file_name", "left")
    return marked.withColumn("row_count", F.when(F.col("_broken"), F.lit(-1)).otherwise(F.col("row_count"))).drop("_broken")
