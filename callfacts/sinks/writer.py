"""Generic table writer (K1-K3).

The original job writes through a warehouse connector class given as a format
name plus settings (host, user, db, password, staging folder, table).  Here the
format is a parameter: file formats get the target as a path, connector
formats get it as an option (``target_option``, e.g. ``"table"`` or
``"dbtable"``), and catalog tables go through ``saveAsTable``.

Overwrite replaces the whole target by default.  ``partition_overwrite``
writes partitioned by date instead: ``"dynamic"`` replaces only the dates
present in the new data (a rerun of one date is idempotent and keeps the
others), ``"static"`` replaces every date.  Spark's commit protocol makes each
single write all-or-nothing; two writes in a row are not one transaction.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from callfacts.schemas import PARTITION_COLUMN

SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")

# Fixed connector setting names: the five settings the warehouse sink needs,
# and the option key each one is passed as.
WAREHOUSE_SETTINGS = {
    "host": "host",
    "user": "user",
    "db": "db",
    "password": "password",
    "stagingFsUrl": "staging_fs_url",
}


def missing_settings(settings: Mapping[str, str], required: Mapping[str, str] = WAREHOUSE_SETTINGS) -> list[str]:
    """Every required setting that is absent, all at once (not just the first)."""
    return [f"sink setting {name!r} is missing" for name in required if not settings.get(name)]


def connector_options(settings: Mapping[str, str], required: Mapping[str, str] = WAREHOUSE_SETTINGS) -> dict[str, str]:
    missing = missing_settings(settings, required)
    if missing:
        raise ValueError("; ".join(missing))
    return {option: settings[name] for name, option in required.items()}


class SelfOverwriteError(ValueError):
    """An overwrite would delete files the written DataFrame still reads."""


def qualified(spark: SparkSession, uri: str) -> str:
    """The whole address of a folder: scheme, authority and absolute path.

    The Hadoop file system resolves relative and scheme-less paths.  An address
    whose file system is not on the class path is compared as it is written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    try:
        path = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    except Py4JJavaError:
        pass
    at = path.toUri()
    return f"{at.getScheme() or ''}://{at.getAuthority() or ''}{at.getPath()}".rstrip("/")


def _inside(path: str, root: str) -> bool:
    return path == root or path.startswith(root.rstrip("/") + "/")


def overlap(a: str, b: str) -> bool:
    """One of two qualified folders is, or lies in, the other."""
    return _inside(a, b) or _inside(b, a)


def table_name(spark: SparkSession, name: str) -> str:
    """``catalog.database.table`` of a name, whatever parts of it are written out."""
    parts = [p[1:-1].replace("``", "`") if p[:1] == "`" else p for p in re.findall(r"`(?:[^`]|``)*`|[^.]+", name)]
    if len(parts) == 1 and any(v.name.lower() == parts[0].lower() and v.isTemporary for v in spark.catalog.listTables(pattern=parts[0])):
        return parts[0].lower()
    if len(parts) < 3:
        parts = [spark.catalog.currentCatalog(), *([spark.catalog.currentDatabase()] if len(parts) == 1 else []), *parts]
    return ".".join(parts).lower()


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog table's files; None for a view or a table that does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    quoted = ".".join(f"`{p}`" if p[:1] != "`" else p for p in re.findall(r"`(?:[^`]|``)*`|[^.]+", name))
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def guard_self_overwrite(df: DataFrame, target: str, read_roots: Sequence[str] | None = None) -> None:
    """Refuse to overwrite a folder that ``df`` reads from.

    A path-based overwrite deletes the target before the job reads its input,
    so reading and overwriting the same folder loses the data (Spark guards
    catalog tables, not plain paths).  With ``read_roots`` (the folders the
    caller read from) the check compares folders only; without, it walks the
    scan's own file listing.  Whole addresses are compared: relative paths are
    resolved, and equal paths in different buckets are different folders.
    """
    spark = df.sparkSession
    root = qualified(spark, target)
    if read_roots is not None:
        for r in (qualified(spark, x) for x in read_roots):
            if _inside(r, root) or _inside(root, r):
                raise SelfOverwriteError(f"refusing to overwrite {target}: the written data is read from {r}")
        return
    for f in df.inputFiles():
        if _inside(qualified(spark, f), root):
            raise SelfOverwriteError(f"refusing to overwrite {target}: the written data reads {f}")


def write_table(
    df: DataFrame,
    target: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
    target_option: str | None = None,
    catalog: bool = False,
    partition_by: Sequence[str] | None = None,
    partition_overwrite: str | None = None,
    read_roots: Sequence[str] | None = None,
) -> None:
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    opts = dict(options or {})
    if partition_overwrite is not None:
        if partition_overwrite not in ("static", "dynamic"):
            raise ValueError("partition_overwrite is 'static' or 'dynamic'")
        opts["partitionOverwriteMode"] = partition_overwrite
        partition_by = partition_by or [PARTITION_COLUMN]
    if mode == "overwrite" and not catalog:
        guard_self_overwrite(df, opts.get("path", target) if target_option else target, read_roots)
    dynamic_insert = catalog and partition_overwrite == "dynamic" and mode == "overwrite"
    if dynamic_insert and df.sparkSession.catalog.tableExists(target):
        # saveAsTable would replace the whole table; an insert replaces only the
        # dates present in ``df``.  insertInto binds by position: use the table's order.
        # The table's own partition columns decide the folders, so they decide the exchange.
        order = df.sparkSession.table(target).columns
        folders = [c.name for c in df.sparkSession.catalog.listColumns(target) if c.isPartition]
        df = df.hint("rebalance", *folders) if folders else df
        df.select(*order).write.options(**opts).insertInto(target, overwrite=True)
        return
    if partition_by:
        # one exchange by date: small dates become one file each instead of one per task,
        # and AQE cuts a large date into pieces of the advisory size
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if catalog:
        writer.options(**opts).saveAsTable(target)
    elif target_option:
        writer.options(**opts, **{target_option: target}).save()
    else:
        writer.options(**opts).save(target)


def target_name(stem: str, suffix: str = "") -> str:
    """K5: a fixed stem plus a per-run suffix (``calls`` + ``_stg``)."""
    return f"{stem}{suffix}"
