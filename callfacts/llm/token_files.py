"""Token ids in Arrow stream files of fixed-size lists, with random access.

Documents are put in ascending id order by a range shuffle; each partition is one
shard.  A shard is an Arrow IPC file whose record batches hold ``ROWS`` sequences
of ``seq_len`` ids and a mask (true: a real id), so sequence ``i`` of a shard is row
``i % ROWS`` of batch ``i // ROWS`` and is read as a view of the mapped file, without
a copy.  Ids take the narrowest unsigned type that holds the vocabulary.  Beside it
stands a small Arrow file of the shard's documents: id, first id, number of ids.

Every attempt of a task writes files of its own name; the manifest, a table of
the files that successful attempts reported, says which of them count.

Defined results: a null or empty text is the end id alone; null ids come first;
repeated ids stand next to each other, ordered by the hash of their texts; an
empty table gives an empty manifest.  Nothing holds more than a batch of ids and
one Arrow batch of texts at a time.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged
from callfacts.llm.tokens import encoder
from callfacts.scratch import fresh_folder
from callfacts.sinks.writer import qualified

SEQ_LEN = 2048
ROWS = 64
INDEX_ROWS = 65_536
MANIFEST = "shard int, ids_path string, docs_path string, n_docs long, n_ids long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a URI or an absolute path."""
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def shared_address(spark, root: str) -> str:
    """The whole address of a folder: without a scheme it is in Hadoop's default file system, as for Spark."""
    whole = qualified(spark, root)
    return whole.removeprefix("file://") if whole.startswith("file://") else whole


class ShardWriter:
    """Writes ids as they come; holds at most one record batch of them."""

    def __init__(self, root: str, stem: str, dtype: np.dtype, seq_len: int):
        self.files, path = file_system(root)
        self.files.create_dir(path, recursive=True)
        self.root, self.ids_path, self.docs_path = root, f"{stem}.ids.arrow", f"{stem}.docs.arrow"
        self.seq_len, self.dtype = seq_len, dtype
        self.schema = pa.schema(
            [("input_ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))],
            metadata={"layout": json.dumps({"seq_len": seq_len, "rows": ROWS})},
        )
        self.sinks = [self.files.open_output_stream(f"{path}/{x}") for x in (self.ids_path, self.docs_path)]
        self.ids = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], INDEX)
        self.held, self.size, self.full = [], 0, ROWS * seq_len
        self.rows, self.n_docs, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.n_ids, len(ids)))
        self.n_docs, self.n_ids = self.n_docs + 1, self.n_ids + len(ids)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.full:
            flat = np.concatenate(self.held)
            cut = len(flat) - len(flat) % self.full
            for at in range(0, cut, self.full):
                self._batch(flat[at : at + self.full], self.full)
            self.held, self.size = [flat[cut:].copy()], len(flat) - cut
        if len(self.rows) >= INDEX_ROWS:
            self._index()

    def _batch(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), type=t)
            for x, t in zip((flat, mask), self.schema.types)
        ]
        self.ids.write_batch(pa.record_batch(lists, schema=self.schema))

    def _index(self) -> None:
        cols = list(zip(*self.rows))
        self.docs.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in cols], schema=INDEX))
        self.rows = []

    def close(self) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.dtype)
        if len(flat):
            padded = np.zeros(-(-len(flat) // self.seq_len) * self.seq_len, self.dtype)
            padded[: len(flat)] = flat
            self._batch(padded, len(flat))
        if self.rows:
            self._index()
        for x in (self.ids, self.docs, *self.sinks):
            x.close()


class ShardReader:
    """Random access to the sequences of one shard; views of the mapped file where it is local."""

    def __init__(self, root: str, ids_path: str):
        self.files, path = file_system(root)
        full = f"{path}/{ids_path}"
        self.source = pa.memory_map(full) if isinstance(self.files, fs.LocalFileSystem) else self.files.open_input_file(full)
        self.file = pa.ipc.open_file(self.source)
        layout = json.loads(self.file.schema.metadata[b"layout"])
        self.seq_len, self.rows = layout["seq_len"], layout["rows"]
        self.at, self.batch = -1, None

    def _load(self, k: int) -> pa.RecordBatch:
        if k != self.at:
            self.at, self.batch = k, self.file.get_batch(k)
        return self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask of sequence ``i``."""
        batch, at = self._load(i // self.rows), (i % self.rows) * self.seq_len
        ids, mask = (batch.column(c).values for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True)[at : at + self.seq_len], mask.slice(at, self.seq_len)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids ``start`` to ``start + n`` of the shard's stream, as views of one batch each."""
        per = self.rows * self.seq_len
        while n:
            flat = self._load(start // per).column(0).values.to_numpy(zero_copy_only=True)
            got = flat[start % per : start % per + n]
            yield got
            start, n = start + len(got), n - len(got)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    root: str,
    end_id: int = 0,
    seq_len: int = SEQ_LEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts and write the shards below ``root``; returns the manifest.

    The manifest has one row per shard with ``first_id``, the number of ids in
    all shards before it.
    """

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = encoder(tokenizer), None
        end = np.asarray([end_id], encode.dtype)
        pid = TaskContext.get().partitionId()
        for whole in batches:
            for cut in range(0, whole.num_rows, 1000):
                b = whole.slice(cut, 1000)
                for doc_id, packed in zip(b.column(0).to_pylist(), encode.encode_all(b.column(1).to_pylist())):
                    writer = writer or ShardWriter(root, f"shard-{pid:06d}-{uuid.uuid4().hex}", encode.dtype, seq_len)
                    writer.add(doc_id, np.concatenate([np.frombuffer(packed, encode.dtype), end]))
        if writer:
            writer.close()
            row = ([pid], [writer.ids_path], [writer.docs_path], [writer.n_docs], [writer.n_ids])
            types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(x, t) for x, t in zip(row, types)], names=["shard", "ids_path", "docs_path", "n_docs", "n_ids"])

    ship(docs.sparkSession)
    root = shared_address(docs.sparkSession, root)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    tie = F.xxhash64("_text")
    ordered = rows.repartitionByRange("_id", tie).sortWithinPartitions("_id", tie)
    shards = staged(ordered.mapInArrow(shard, MANIFEST), "token_shards")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row a shard
    return shards.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("root", F.lit(root))


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                reader = ShardReader(m["root"], m["ids_path"])
                files, path = file_system(m["root"])
                with files.open_input_file(f"{path}/{m['docs_path']}") as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        sums = []
                        for start, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                            crc = 0
                            for ids in reader.ids(start, n):
                                crc = zlib.crc32(ids.astype("<u4"), crc)
                            sums.append(crc)
                        starts = pa.array(part.column(1).to_numpy() + m["first_id"], pa.int64())
                        cols = [part.column(0), starts, part.column(2), pa.array(sums, pa.int64())]
                        yield pa.record_batch(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    ship(spark)
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return manifest.repartition(spread, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder below the shared checkpoint folder and read them back."""
    root = fresh_folder(docs.sparkSession, "llm", "tokens")
    return read_documents(write_tokens(docs, tokenizer, root, **options))
