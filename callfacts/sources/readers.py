"""Readers: catalog table, CSV calls, JSON chats, text lines.

Fact folders are Hive-style: ``<root>/date=<yyyy-MM-dd>/part-*``.  Reading one
date reads that folder directly with ``basePath`` set to the root, so

* a missing date fails at once (PATH_NOT_FOUND) instead of silently giving an
  empty table that would then overwrite the target, and
* the ``date`` column is kept (it is lost without ``basePath``).

Reading the root instead (``partition=None``) reads every date; a filter on
``date`` is then pushed into the listing as a partition filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import schemas as S

# Text format in which the fixtures write times (microseconds kept).  Readers need no
# format: without one Spark reads ISO times by its cast rules, with a space or a T and
# with or without a fraction of a second.  A time that names a zone does not parse: a
# fact's zone is fixed, so such a cell is unreadable (NULL, raw record kept), not shifted.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

Partition = str | Sequence[str] | None


def partition_paths(root: str, partition: Partition) -> list[str]:
    root = root.rstrip("/")
    if partition is None:
        return [root]
    dates = [partition] if isinstance(partition, str) else list(partition)
    if not dates:
        raise ValueError("empty partition list")
    return [f"{root}/{S.PARTITION_COLUMN}={d}/" for d in dates]


def _fact_reader(
    spark: SparkSession, root: str, schema: T.StructType, corrupt_column: str | None, timestamp_format: str | None
):
    read_schema = S.with_partition(schema)
    reader = spark.read.option("basePath", root.rstrip("/"))
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if corrupt_column:
        read_schema = T.StructType(read_schema.fields + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(read_schema)


def _keep(corrupt_column: str | None) -> tuple[str, ...]:
    return (S.PARTITION_COLUMN,) + ((corrupt_column,) if corrupt_column else ())


def read_table(spark: SparkSession, name: str, schema: T.StructType = S.CLIENT) -> DataFrame:
    """A catalog table (or view) bound to its record type."""
    return S.conform(spark.read.table(name), schema)


def read_calls_csv(
    spark: SparkSession,
    root: str,
    partition: Partition = None,
    *,
    schema: T.StructType = S.CALL,
    corrupt_column: str | None = None,
    timestamp_format: str | None = None,
    header: bool = False,
) -> DataFrame:
    """S2 + S5: CSV call facts, columns by position (header-less by default;
    ``header=True`` skips a first line, columns still bound by position).

    A cell that does not parse becomes NULL; with ``corrupt_column`` the raw
    line of such a row is kept in that column.  An empty cell reads as NULL
    (CSV has no separate empty string; for the key both mean "no client").
    Times are read by the ISO rules, or by ``timestamp_format`` if one is given.
    """
    reader = _fact_reader(spark, root, schema, corrupt_column, timestamp_format)
    reader = reader.option("header", str(header).lower()).option("enforceSchema", "true")
    df = reader.csv(partition_paths(root, partition))
    return S.conform(df, schema, keep=_keep(corrupt_column))


def read_chats_json(
    spark: SparkSession,
    root: str,
    partition: Partition = None,
    *,
    schema: T.StructType = S.CHAT_RAW,
    corrupt_column: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """S3 + S5: JSON-lines chat facts with a nested message list.

    Lines are read permissively with partial results: a field of the wrong
    type becomes NULL while the others are kept, and with ``corrupt_column``
    the raw line is kept too.  A chat whose ``messages`` is one object rather
    than a list therefore reads with NULL messages; for data shaped like that
    throughout, pass a ``schema`` whose ``messages`` is a struct -- the nested
    rewrite handles both forms.
    """
    reader = _fact_reader(spark, root, schema, corrupt_column, timestamp_format)
    df = reader.json(partition_paths(root, partition))
    return S.conform(df, schema, keep=_keep(corrupt_column))


def _read_lines(
    spark: SparkSession, root: str, partition: Partition, schema: T.StructType, parse, raw_column: str, corrupt_column: str
) -> DataFrame:
    lines = spark.read.option("basePath", root.rstrip("/")).schema(S.with_partition(T.StructType([T.StructField("value", T.StringType())])))
    lines = lines.text(partition_paths(root, partition)).where(F.trim("value") != "")
    fields = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
    parsed = lines.withColumn("fact", parse(F.col("value"), fields))
    return parsed.select(*[F.col(f"fact.{f}") for f in fields.names], F.col("value").alias(raw_column), S.PARTITION_COLUMN)


def read_call_lines(
    spark: SparkSession,
    root: str,
    partition: Partition = None,
    *,
    raw_column: str,
    corrupt_column: str,
    timestamp_format: str | None = None,
) -> DataFrame:
    """S2 with the whole line of every call beside its fields, whether it could be read or not.

    ``corrupt_column`` is NULL where the record was read whole, as with ``read_calls_csv``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    options |= {"timestampNTZFormat": timestamp_format} if timestamp_format else {}
    ddl = lambda f: ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in f)
    parse = lambda c, f: F.from_csv(c, ddl(f), options)
    return _read_lines(spark, root, partition, S.CALL, parse, raw_column, corrupt_column)


def read_chat_lines(
    spark: SparkSession,
    root: str,
    partition: Partition = None,
    *,
    raw_column: str,
    corrupt_column: str,
    schema: T.StructType = S.CHAT_RAW,
    timestamp_format: str | None = None,
) -> DataFrame:
    """S3 with the whole line of every chat beside its fields."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    options |= {"timestampNTZFormat": timestamp_format} if timestamp_format else {}
    parse = lambda c, f: F.from_json(c, f, options)
    return _read_lines(spark, root, partition, schema, parse, raw_column, corrupt_column)


class EmptyInputError(ValueError):
    """A requested fact folder holds no record; nothing was written."""


def require_files(df: DataFrame, root: str, partition: Partition = None) -> None:
    """Fail when a requested date folder exists but holds no record.

    ``df`` is the read of ``partition``.  With a declared schema Spark reads such a folder as
    zero rows, and a whole-table overwrite would then empty the target.  (Without a schema the
    read itself fails, as it cannot infer one.)  Sizes do not tell: hidden files, blank lines
    and an empty compressed file have bytes.  One row of each named date is asked for, or one
    of the root.
    """
    dates = [None] if partition is None else [partition] if isinstance(partition, str) else list(partition)
    of = lambda d: df if d is None else df.where(F.col(S.PARTITION_COLUMN) == F.lit(d).cast("date"))
    empty = [p for d in dates if of(d).isEmpty() for p in partition_paths(root, d)]
    if empty:
        raise EmptyInputError(f"no data in {empty}; nothing was written")


LEDGER = "kind STRING, date STRING, path STRING, size BIGINT, changed TIMESTAMP"


def input_files(spark: SparkSession, kind: str, root: str) -> DataFrame:
    """The files below a fact root as Spark lists them (``LEDGER``); no content is read."""
    files = spark.read.format("binaryFile").option("basePath", root.rstrip("/")).load(root.rstrip("/"))
    date = F.col(S.PARTITION_COLUMN).cast("string") if S.PARTITION_COLUMN in files.columns else F.lit("")
    return files.select(F.lit(kind).alias("kind"), F.coalesce(date, F.lit("")).alias("date"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def changed_dates(before: DataFrame, now: DataFrame) -> DataFrame:
    """``(kind, date, files)``: dates with a new, changed or vanished file, and their files now.

    An outer join on the path; what comes out has one row per changed date.
    """
    key, a, b = ["kind", "date", "path"], before.alias("a"), now.alias("b")
    same = (F.col("a.size") == F.col("b.size")) & (F.col("a.changed") == F.col("b.changed"))
    both = a.join(b, key, "full_outer").select(*key, F.coalesce(same, F.lit(False)).alias("same"), F.col("b.size").alias("size"))
    dates = both.groupBy("kind", "date").agg(F.bool_and("same").alias("same"), F.count("size").alias("files"))
    return dates.where(~F.col("same")).drop("same")


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path if isinstance(path, str) else list(path))
