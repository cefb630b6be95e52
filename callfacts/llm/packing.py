"""Packing by lexical retrieval: BM25 neighbours of a seed document fill its window.

Documents are dealt by content, wherever they were read from, to shards of at most
``shard_tokens`` ids: by their leading term (most occurrences times idf), then by
their heaviest BM25 term, with document frequencies of the whole corpus; what one pair
of terms holds beyond a shard is dealt by hash.  Each shard has an inverted BM25 index
over token ids.  A seed document asks the index for its best unused neighbours, and
they fill the window greedily; the last one is cut to fit and its rest stays available.
Texts over a window fill windows of their own first.  What is left of a shard at the
end is cut into sequences whose lengths are powers of two, which need no padding.  A
task holds one shard at a time.

Defined results: a null text counts as empty and is the end id alone; repeated rows are
packed as often as they occur; an empty table gives an empty result; equal scores go to
the earlier document of the shard.  Shards and their order come from content and ids
alone, so neither a retry nor another layout of the input packs differently.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged
from callfacts.llm.tokens import encoder

WINDOW = 4096
SHARD_TOKENS = 8_000_000
FILL = 0.75  # of a shard, as terms are dealt by hash and shards come out uneven
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


class Index:
    """BM25 over the token ids of a shard's documents, as postings sorted by term."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        owner, terms, tf = term_counts(docs) if docs else [np.empty(0, np.int64)] * 3
        owner, terms, tf = owner.astype(np.int32), terms.astype(np.uint32), tf.astype(np.float32)
        length = np.fromiter((len(d) for d in docs), np.float32, len(docs))
        norm = k1 * (1 - b + b * length / max(1.0, float(length.mean()) if len(docs) else 1.0))
        weight = tf * (k1 + 1) / (tf + norm[owner])
        self.first = np.searchsorted(owner, np.arange(len(docs) + 1))
        df = np.bincount(terms, minlength=int(terms.max(initial=0)) + 1)
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.terms, self.n = terms, len(docs)  # of each document, for its queries
        value = weight * idf[terms]
        order = np.argsort(terms, kind="stable")
        at = np.concatenate([[0], np.cumsum(df)])
        self.common = {}  # terms of over a quarter of the documents, as whole rows
        for t in np.flatnonzero(df > len(docs) / 4):
            mine = order[at[t] : at[t + 1]]
            self.common[int(t)] = row = np.zeros(len(docs), np.float32)
            row[owner[mine]] = value[mine]
        order = order[~np.isin(terms[order], np.fromiter(self.common, np.int64))]
        self.owner, self.weight = owner[order].astype(np.intp), value[order].astype(float)
        df[list(self.common)] = 0
        self.at = np.concatenate([[0], np.cumsum(df)])

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document for all terms of ``doc``."""
        terms = self.terms[self.first[doc] : self.first[doc + 1]].tolist()
        spans = [(self.at[t], self.at[t + 1]) for t in terms if t not in self.common]
        owners = np.concatenate([self.owner[a:b] for a, b in spans]) if spans else np.empty(0, np.intp)
        weights = np.concatenate([self.weight[a:b] for a, b in spans]) if spans else np.empty(0)
        out = np.zeros(self.n, np.float32)
        for t in terms:
            if t in self.common:
                out += self.common[t]
        return out + np.bincount(owners, weights, minlength=self.n)


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of ``(document, start, length)``; each id lies in exactly one."""
    size = np.fromiter((len(d) for d in docs), np.int64, len(docs))
    start = np.zeros(len(docs), np.int64)
    for d in np.flatnonzero(size >= window):
        for _ in range(size[d] // window):
            yield [(int(d), int(start[d]), window)]
            start[d] += window
    free = start < size
    if not free.any():
        return
    index = Index(docs)
    seed, left = 0, int(free.sum())
    while left:
        while not free[seed]:
            seed += 1
        pieces, room, next_up = [], window, [seed]
        scores, asked = None, False
        while room and left:
            if not next_up and not asked:
                scores, asked = index.scores(seed), True
            if not next_up and scores is not None:
                hits = np.flatnonzero((scores > 0) & free)
                want = min(len(hits), 64)
                if want:
                    some = hits[np.argpartition(-scores[hits], want - 1)[:want]] if len(hits) > want else hits
                    next_up = some[np.lexsort((some, -scores[some]))].tolist()
                else:
                    scores = None
            if not next_up:  # no lexical neighbour is left: go on in the shard's order
                while not free[seed]:
                    seed += 1
                next_up, asked = [seed], False
            d = next_up.pop(0)
            if not free[d]:
                continue
            take = int(min(room, size[d] - start[d]))
            pieces.append((int(d), int(start[d]), take))
            start[d] += take
            room -= take
            if start[d] == size[d]:
                free[d] = False
                left -= 1
        if room:
            yield from _powers(pieces, window - room)
        else:
            yield pieces


def _powers(pieces: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """Cut a short sequence into sequences whose lengths are falling powers of two."""
    pieces = pieces[::-1]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out = []
        while room:
            d, at, n = pieces.pop()
            take = min(n, room)
            out.append((d, at, take))
            room -= take
            if take < n:
                pieces.append((d, at + take, n - take))
        yield out


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _ids)``: the packed ids of each whole text, the end id last."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.asarray([end_id], encode.dtype).tobytes()
        for whole in batches:
            for cut in range(0, whole.num_rows, 1000):
                b = whole.slice(cut, 1000)
                ids = [x + end for x in encode.encode_all(b.column(1).to_pylist())]
                yield pa.record_batch([b.column(0), pa.array(ids, pa.binary())], names=["_id", "_ids"])

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(rows, "_id long, _ids binary")


def term_counts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, term, occurrences)`` of some documents, in this order, by one sort for all of them."""
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    keys = np.repeat(np.arange(len(docs), dtype=np.uint64) << np.uint64(32), size) | np.concatenate(docs).astype(np.uint64)
    keys.sort()
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    first = keys[heads]
    return (first >> np.uint64(32)).astype(np.int64), (first & np.uint64(0xFFFFFFFF)).astype(np.int64), np.diff(heads, append=len(keys))


def _some(column: pa.Array, dtype: np.dtype, ids: int = 1 << 20) -> Iterator[list[np.ndarray]]:
    """The documents of a column, about ``ids`` ids at a time."""
    held, size = [], 0
    for x in column:
        held.append(np.frombuffer(x.as_buffer(), dtype))
        size += len(held[-1])
        if size >= ids:
            yield held
            held, size = [], 0
    if held:
        yield held


def document_frequencies(held: DataFrame, dtype: np.dtype) -> np.ndarray:
    """Of every term, in how many documents of the whole corpus it occurs; one row a term comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for b in batches:
            for docs in _some(b.column(0), dtype):
                here = np.bincount(term_counts(docs)[1], minlength=len(df))
                here[: len(df)] += df
                df = here
        terms = np.flatnonzero(df)
        yield pa.record_batch([pa.array(terms), pa.array(df[terms])], names=["term", "n"])

    rows = held.select("_ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(max(rows["term"].to_pylist(), default=0) + 1, np.int64)
    out[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return out


def best_terms(docs: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75) -> tuple[np.ndarray, np.ndarray]:
    """Per document the term of most occurrences times idf and the heaviest by BM25; the smaller on a tie, -1 for none."""
    doc, term, tf = term_counts(docs)
    length = np.fromiter(map(len, docs), np.int64, len(docs))
    raw = tf * idf[term]
    heads = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    out = []
    for weight in (raw, raw / (tf + k1 * (1 - b + b * length[doc] / mean))):
        top = np.maximum.reduceat(weight, heads)
        best = np.flatnonzero(weight == np.repeat(top, np.diff(heads, append=len(doc))))
        first = best[np.searchsorted(best, heads)]
        out.append(np.where(top > 0, term[first], -1))
    return out[0], np.where(out[0] < 0, -1, out[1])


def with_keys(held: DataFrame, dtype: np.dtype, df: np.ndarray, n_docs: int, mean: float) -> DataFrame:
    """``held`` with the leading and the heaviest term of each document that another one shares (-1: none)."""
    shared = held.sparkSession.sparkContext.broadcast(np.where(df > 1, np.log1p((n_docs - df + 0.5) / (df + 0.5)), 0.0))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        for batch in batches:
            best = [best_terms(docs, idf, mean) for docs in _some(batch.column(1), dtype)]
            lead, heavy = (np.concatenate(x) for x in zip(*best)) if best else [np.empty(0, np.int64)] * 2
            yield pa.record_batch([*batch.columns, pa.array(lead, pa.int64()), pa.array(heavy, pa.int64())], names=["_id", "_ids", "lead", "heavy"])

    return held.mapInArrow(keys, "_id long, _ids binary, lead long, heavy long")


def deal(sizes: dict[int, int], hot: dict[tuple[int, int], int], target: float) -> tuple[dict, dict, int]:
    """First shard and number of shards of each leading term and of each hot pair of terms, and the number of all.

    Leading terms are joined, in their order, until they fill a shard; one that holds
    more than a shard, and each hot pair, gets shards of its own.
    """
    leads, pairs, rest, at = {}, {}, dict(sizes), 0
    for (lead, heavy), n in sorted(hot.items()):
        k = int(-(-n // target))
        pairs[lead, heavy] = (at, k)
        at += k
        rest[lead] -= n
    for t, n in sorted(rest.items()):
        if n > target:
            k = int(-(-n // target))
            leads[t] = (at, k)
            at += k
    room = 0.0
    for t, n in sorted(rest.items()):
        if n <= target:
            if n > room:
                at, room = at + 1, target
            leads[t] = (max(at - 1, 0), 1)
            room -= n
    return leads, pairs, max(at, 1)


def with_shards(held: DataFrame, dtype: np.dtype, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, int]:
    """``held`` with its keys and the number of the shard, and how many shards there are."""
    spark = held.sparkSession
    n_docs, total = held.agg(F.count("*"), F.sum(F.octet_length("_ids") / dtype.itemsize)).first()
    if not n_docs:
        return held.select("*", *[F.lit(0).cast("long").alias(c) for c in ("lead", "heavy", "shard")]), 1
    keyed = with_keys(held, dtype, document_frequencies(held, dtype), n_docs, total / n_docs)
    target = FILL * shard_tokens
    tokens = (F.octet_length("_ids") / dtype.itemsize).cast("long")
    pairs = staged(keyed.groupBy("lead", "heavy").agg(F.sum(tokens).alias("n")), "packing_keys")
    sizes = {r["lead"]: r["n"] for r in pairs.groupBy("lead").agg(F.sum("n").alias("n")).collect()}  # one row a term
    hot = {(r["lead"], r["heavy"]): r["n"] for r in pairs.where(F.col("n") > target).collect()}  # under total / target rows
    leads, own, shards = deal(sizes, hot, target)
    by_lead = spark.createDataFrame([(t, *v) for t, v in leads.items()], "lead long, a long, k long")
    by_pair = spark.createDataFrame([(*t, *v) for t, v in own.items()], "lead long, heavy long, pa long, pk long")
    both = keyed.join(F.broadcast(by_lead), "lead").join(F.broadcast(by_pair), ["lead", "heavy"], "left")
    shard = F.coalesce(
        F.col("pa") + F.pmod(F.xxhash64("_id", "_ids"), "pk"), F.col("a") + F.pmod(F.xxhash64("heavy"), "k")
    )
    return both.select("_id", "_ids", "lead", "heavy", shard.alias("shard")), shards


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents (``PIECES``); sequence ids hold the partition in their upper half."""
    dtype = encoder(tokenizer).dtype

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out = []
            for pieces in pack_shard(held, window):
                at = 0
                for d, start, n in pieces:
                    crc = zlib.crc32(held[d][start : start + n].astype("<u4"))
                    out.append((names[d], start, n, crc, len(held[d]), sequence, at))
                    at += n
                sequence += 1
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=_NAMES)

        names, held, total, current = [], [], 0, None
        for b in batches:
            for doc_id, shard, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if held and (shard != current or total >= shard_tokens):
                    yield from flush()
                    names, held, total = [], [], 0
                current = shard
                names.append(doc_id)
                held.append(np.frombuffer(ids.as_py(), dtype))
                total += len(held[-1])
        if held:
            yield from flush()

    held = staged(token_ids(docs, tokenizer, end_id, id_col, text_col), "packing_ids")
    dealt, shards = with_shards(held, dtype, shard_tokens)
    order = ["shard", "lead", "heavy", F.xxhash64("_ids"), "_id"]
    return dealt.repartition(shards, "shard").sortWithinPartitions(*order).select("_id", "shard", "_ids").mapInArrow(rows, PIECES)
