"""The warehouse sink as a Spark data source (K1): staged files, one commit, abort.

``spark.dataSource.register(StagedTable)`` gives the format ``callfacts_staged``.  It takes the
five connector settings as options, and the table's name::

    df.write.format("callfacts_staged").options(**connector_options(settings), table="calls_stg")

Each task writes one Parquet file below ``staging_fs_url``, batch by batch; the driver's commit
then names the files of the tasks that succeeded in a new version of the table::

    <staging_fs_url>/<db>/<table>/data/<write>/part-<uuid>.parquet
    <staging_fs_url>/<db>/<table>/versions/00000007-<write>.json

A version file is moved into place whole, and the last one counts; so a failed write, or a
failed commit, leaves the table as it was, and what a failed attempt of a task has left is in
no version.  One writer at a time may append to a table.  Host, user and password belong to a
warehouse that loads the files; they are required and never stored.

Files go through Arrow's file systems: local paths, HDFS or object stores.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from callfacts.sinks.writer import WAREHOUSE_SETTINGS

NAME = "callfacts_staged"


class SinkSettingsError(ValueError):
    """Options that the sink needs are missing."""


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


@dataclass
class FilePart(InputPartition):
    path: str


class Folder:
    """One table below the staging address."""

    def __init__(self, options: dict):
        need = [*WAREHOUSE_SETTINGS.values(), "table"]
        missing = [f"option {n!r} is missing" for n in need if not options.get(n)]
        if missing:
            raise SinkSettingsError("; ".join(missing))
        url = options["staging_fs_url"].rstrip("/")
        self.fs, base = fs.FileSystem.from_uri(url) if ":" in url.split("/")[0] else (fs.LocalFileSystem(), url)
        for part in (options["db"], options["table"]):
            if part in (".", "..") or "/" in part:
                raise SinkSettingsError(f"not a name: {part!r}")
        self.base = f"{base}/{options['db']}/{options['table']}"

    def versions(self) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.base}/versions", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def current(self) -> dict:
        """Number, schema and files of the last version."""
        names = self.versions()
        if not names:
            return {"number": 0, "schema": None, "files": []}
        with self.fs.open_input_stream(f"{self.base}/versions/{names[-1]}") as f:
            return json.loads(f.read())

    def commit(self, write: str, schema: StructType, files: Sequence[str], append: bool) -> None:
        last = self.current()
        if append and last["schema"] and StructType.fromJson(last["schema"]).simpleString() != schema.simpleString():
            raise ValueError(f"the table has {StructType.fromJson(last['schema']).simpleString()}, the rows {schema.simpleString()}")
        new = {
            "number": last["number"] + 1,
            "schema": schema.jsonValue(),
            "files": [*(last["files"] if append else []), *sorted(files)],
        }
        self.fs.create_dir(f"{self.base}/versions", recursive=True)
        draft = f"{self.base}/versions/.{write}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(new).encode())
        self.fs.move(draft, f"{self.base}/versions/{new['number']:08d}-{write}.json")


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.options, self.schema, self.overwrite = options, schema, overwrite
        self.write_id = uuid.uuid4().hex
        Folder(options)  # settings are checked before a task starts

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, out, rows = Folder(self.options), None, 0
        path = f"data/{self.write_id}/part-{uuid.uuid4().hex}.parquet"
        try:
            for batch in iterator:
                if out is None:
                    folder.fs.create_dir(f"{folder.base}/data/{self.write_id}", recursive=True)
                    out = pq.ParquetWriter(f"{folder.base}/{path}", batch.schema, filesystem=folder.fs)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(path if out is not None else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        files = [m.path for m in messages if m is not None and m.rows]
        Folder(self.options).commit(self.write_id, self.schema, files, append=not self.overwrite)

    def abort(self, messages: list[Written | None]) -> None:
        """Drop this write's files, those of failed tasks too; the table's version stays.

        A task that is killed may still end a file afterwards; no version names it.
        """
        folder = Folder(self.options)
        if folder.fs.get_file_info(f"{folder.base}/data/{self.write_id}").type == fs.FileType.Directory:
            folder.fs.delete_dir(f"{folder.base}/data/{self.write_id}")


class StagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[FilePart]:
        return [FilePart(p) for p in Folder(self.options).current()["files"]]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a table without a file
            return
        folder = Folder(self.options)
        with folder.fs.open_input_file(f"{folder.base}/{partition.path}") as f:
            yield from pq.ParquetFile(f).iter_batches()


class StagedTable(DataSource):
    """The format ``callfacts_staged``; modes ``overwrite`` and ``append``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        schema = Folder(dict(self.options)).current()["schema"]
        if schema is None:
            raise ValueError(f"there is no table {self.options.get('table')!r} to read")
        return StructType.fromJson(schema)

    def reader(self, schema: StructType) -> StagedReader:
        return StagedReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(dict(self.options), schema, overwrite)
