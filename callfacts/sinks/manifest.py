"""Versioned publish of several outputs with one commit (K4).

Below one root stand the outputs of every attempt and a row of manifests::

    <root>/data/<attempt>/<write>/...      files, written by Spark, never changed
    <root>/manifests/00000007.json         version 7: which folders make up each output

A manifest names all outputs together, so a reader, who takes one manifest, sees either all
old or all new ones.  A version is published by renaming a finished file to the next number,
which only one publisher can do: the file system refuses a name that exists.  Whatever fails
before the rename leaves the last version as it was; its files are found by ``orphans``.

An output is a map from part (a date, or ``"all"``) to folders.  A publish may replace some
parts and keep others, so a rerun of one date costs one date; ``expect`` then makes sure that
no one else has published meanwhile.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS, DATA, FORMAT = "manifests", "data", 1
WHOLE = "all"  # the part of an output that is not kept by date
MIN_AGE_S = 24 * 3600.0

Parts = dict[str, list[str]]


class PublishConflict(RuntimeError):
    """Another publisher was first; nothing of this attempt can be seen."""


@dataclass(frozen=True)
class Output:
    """Schema, format and folders (relative to the root) of one output."""

    schema: T.StructType
    parts: Parts
    fmt: str = "parquet"

    def folders(self) -> list[str]:
        return [f for p in sorted(self.parts) for f in self.parts[p]]


@dataclass(frozen=True)
class Manifest:
    version: int
    outputs: Mapping[str, Output] = field(default_factory=dict)
    facts: Mapping[str, str] = field(default_factory=dict)  # what a job wants to find again next time

    def to_json(self) -> str:
        outputs = {
            n: {"schema": o.schema.jsonValue(), "format": o.fmt, "parts": o.parts} for n, o in sorted(self.outputs.items())
        }
        return json.dumps({"format": FORMAT, "version": self.version, "outputs": outputs, "facts": dict(self.facts)})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        if raw["format"] != FORMAT:
            raise ValueError(f"manifest format {raw['format']} is not {FORMAT}")
        outputs = {n: Output(T.StructType.fromJson(o["schema"]), o["parts"], o["format"]) for n, o in raw["outputs"].items()}
        return Manifest(raw["version"], outputs, raw["facts"])


class Files:
    """The few calls of Hadoop's file system that a publish needs, for one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path().getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def names(self, *parts: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        at = self.path(*parts)
        if not self.fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at))

    def age_s(self, *parts: str) -> float:
        """Seconds since a file, or anything below a folder, changed by the file system's times."""
        newest = self.fs.getFileStatus(self.path(*parts)).getModificationTime()
        statuses = list(self.fs.listStatus(self.path(*parts)))
        while statuses:
            s = statuses.pop()
            newest = max(newest, s.getModificationTime())
            if s.isDirectory():
                statuses += list(self.fs.listStatus(s.getPath()))
        return time.time() - newest / 1000

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *parts: str) -> None:
        """A new file, whole when this returns."""
        stream = self.fs.create(self.path(*parts), False)
        try:
            stream.write(bytearray(text.encode()))
            stream.hflush()
        finally:
            stream.close()

    def rename_new(self, source: Sequence[str], target: Sequence[str]) -> bool:
        """Rename, unless the target exists: then nothing happens and the answer is False."""
        fc = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path().toUri(), self.conf)
        none = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.jvm.java.lang.reflect.Array.newInstance(none.getDeclaringClass(), 1)
        options[0] = none
        try:
            fc.rename(self.path(*source), self.path(*target), options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def versions(files: Files) -> list[int]:
    return [int(n[:-5]) for n in files.names(MANIFESTS) if n.endswith(".json") and n[:-5].isdigit()]


def current(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The last published version, or the one asked for; version 0 has no outputs."""
    files = Files(spark, root)
    if version is None:
        version = max(versions(files), default=0)
    return Manifest.from_json(files.read(MANIFESTS, f"{version:08d}.json")) if version else Manifest(0)


def read_output(spark: SparkSession, root: str, name: str, manifest: Manifest | None = None) -> DataFrame:
    """One published output.  Pass one ``manifest`` to read several outputs of the same version."""
    manifest = manifest or current(spark, root)
    if name not in manifest.outputs:
        raise KeyError(f"version {manifest.version} of {root} has no output {name!r}; it has {sorted(manifest.outputs)}")
    out = manifest.outputs[name]
    folders = [f"{root.rstrip('/')}/{f}" for f in out.folders()]
    if not folders:
        return spark.createDataFrame([], out.schema)
    return spark.read.schema(out.schema).format(out.fmt).load(folders)


def new_attempt() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


class Attempt:
    """Writes that no reader sees until ``publish``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.name = spark, root.rstrip("/"), new_attempt()
        self.files = Files(spark, root)

    def folder(self, write: str) -> str:
        """Where a write goes, relative to the root."""
        return f"{DATA}/{self.name}/{write}"

    def save(self, df: DataFrame, write: str, by: Sequence[str] = (), fmt: str = "parquet", options: Mapping[str, str] | None = None) -> str:
        """Write ``df`` in folders by the columns ``by``, which the files then do not hold."""
        if by:
            df = df.hint("rebalance", *by)  # one exchange: few files a folder, a large one cut by AQE
        writer = df.write.format(fmt).options(**dict(options or {})).mode("error")
        (writer.partitionBy(*by) if by else writer).save(f"{self.root}/{self.folder(write)}")
        return self.folder(write)

    def parts(self, folder: str, prefix: str) -> Parts:
        """The sub-folders ``<prefix><part>`` of a write, by part."""
        found = [n for n in self.files.names(folder) if n.startswith(prefix)]
        return {n[len(prefix) :]: [f"{folder}/{n}"] for n in found}

    def publish(
        self, outputs: Mapping[str, Output], facts: Mapping[str, str] | None = None, expect: int | None = None, keep: bool = True
    ) -> Manifest:
        """Make ``outputs`` the next version; with ``keep`` outputs not named stay as they are.

        ``expect`` is the version that this one was made from: if another one came since,
        ``PublishConflict``.  Without it the outputs replace whatever is there.
        """
        draft = f".draft-{self.name}.json"
        while True:
            last = current(self.spark, self.root)
            if expect is not None and last.version != expect:
                raise PublishConflict(f"version {last.version} was published after version {expect}")
            held = {n: o for n, o in last.outputs.items() if keep}
            version = last.version + 1
            new = Manifest(version, {**held, **outputs}, dict(facts if facts is not None else last.facts))
            self.files.write(new.to_json(), MANIFESTS, draft)
            if self.files.rename_new((MANIFESTS, draft), (MANIFESTS, f"{version:08d}.json")):
                return new
            self.files.delete(MANIFESTS, draft)


def orphans(spark: SparkSession, root: str, min_age_s: float = MIN_AGE_S) -> list[str]:
    """Attempts and drafts that no manifest names and that nothing has changed for ``min_age_s``.

    A publisher at work looks the same as one that died, hence the age.
    """
    files = Files(spark, root)
    named: set[str] = set()
    for m in (current(spark, root, v) for v in versions(files)):
        named.update(f for o in m.outputs.values() for f in o.folders())
        named.update(x for x in m.facts.values() if x.startswith(f"{DATA}/"))
    held = {x.split("/")[1] for x in named}
    dead = [(DATA, n) for n in files.names(DATA) if n not in held]
    dead += [(MANIFESTS, n) for n in files.names(MANIFESTS) if n.startswith(".draft-")]
    return ["/".join(d) for d in dead if files.age_s(*d) >= min_age_s]


def expire(spark: SparkSession, root: str, keep_versions: int, min_age_s: float = MIN_AGE_S) -> list[str]:
    """Drop all but the last ``keep_versions`` manifests, then everything that no manifest names."""
    if keep_versions < 1:
        raise ValueError("keep at least the current version")
    files = Files(spark, root)
    for v in versions(files)[:-keep_versions]:
        files.delete(MANIFESTS, f"{v:08d}.json")
    return recover(spark, root, min_age_s)


def recover(spark: SparkSession, root: str, min_age_s: float = MIN_AGE_S) -> list[str]:
    """Delete what publishers that died have left; returns what was deleted.  Safe to repeat."""
    files, dead = Files(spark, root), orphans(spark, root, min_age_s)
    for d in dead:
        files.delete(*d.split("/"))
    return dead
