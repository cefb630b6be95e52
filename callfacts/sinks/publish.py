"""Staged publish of several catalog tables (the sink's staging folder, K1).

A whole-table overwrite removes the old files when its write starts, so a
failure in the middle of a run -- or between the calls and the chats write --
leaves targets empty or out of step.  Staged publish writes every output to a
new versioned folder below ``staging_root`` first; only when all of them are
written are the tables pointed at their new folders, one catalog call each.
A failure while computing or writing leaves every table as it was, readers
that already listed the old files keep reading them (old versions are never
deleted here), and a rerun simply publishes a newer version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _quote(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    """``db.table`` -> ```db`.`table```: each part quoted as an identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def new_version() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def publish_staged(
    spark: SparkSession,
    outputs: Mapping[str, DataFrame],
    *,
    staging_root: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    version: str | None = None,
) -> dict[str, str]:
    """Write each ``table -> DataFrame`` to ``<staging_root>/<table>/v=<version>``,
    then point every table at its new folder.  Returns the new locations.

    Existing tables are repointed with ``ALTER TABLE ... SET LOCATION`` and
    must already have the output's columns (checked before anything is
    written); missing ones are created as external tables over the folder.
    """
    for table, df in outputs.items():  # 0. refuse before writing anything
        if spark.catalog.tableExists(table):
            have = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
            want = [(f.name, f.dataType) for f in df.schema.fields]
            if have != want:
                raise ValueError(f"{table} has columns {have}, the new output {want}; nothing was written")
    version = version or new_version()
    root = staging_root.rstrip("/")
    locations: dict[str, str] = {}
    for table, df in outputs.items():  # 1. every output written, nothing published yet
        location = f"{root}/{table}/v={version}"
        df.write.format(fmt).options(**dict(options or {})).mode("error").save(location)
        locations[table] = location
    for table, location in locations.items():  # 2. publish: catalog calls only
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {_ident(table)} SET LOCATION {_quote(location)}")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=location, source=fmt)
    return locations
