"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Every text gets a 64-bit fingerprint.  Distinct fingerprints are sorted by their
rank in Gray order, where neighbours differ in few bits, and cut into ranges of
equal size.  The bits that all members of a range share form its pattern (a mask
and values); a fingerprint is sent to the ranges whose pattern it differs from in
at most ``bits`` places.  Within a range the same idea repeats: each upper node
keeps the bits that its members share and its ancestors have not used yet, a search
adds up differences on its way down and drops a node, with all its members, as
soon as they exceed ``bits``.  At a leaf the sum is the exact Hamming distance.

Links found in a range are reduced there to a spanning forest, so a group of n near
copies makes O(n) rows, not n squared; connected components join the forests.
All copies of a text share one fingerprint and are one node.

Defined results: a null or empty text, or one without words, has fingerprint
zero and links as any other; repeated ids are rows of their own, and a component's id is
the smallest non-null id among its rows; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import components, ship, staged
from callfacts.llm.quality_rules import free_name

SHINGLE = 3
MAX_BITS = 2
SEED = 42
RANGE_ROWS = 50_000  # distinct fingerprints that a range is meant to hold
MIN_RANGES = 64  # where there are enough fingerprints, so that small inputs spread too
MAX_RANGES = 4096  # so the table of patterns, 24 bytes a range, stays under 100 KB
FANOUT = 16
FRONTIER = 400_000  # nodes that a search holds at once
_TOP = -(1 << 63)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of a whole text: a bit is set if over half of its shingles' hashes have it."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, seed, join = xxhash.xxh64_intdigest, SEED, b" ".join
    hashes = np.fromiter(
        [digest(join(s), seed) for s in zip(*(words[i:] for i in range(size)))], np.uint64, len(words) - size + 1
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16_384):
        part = hashes[at : at + 16_384].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``(doc_id, hash, fp)``, one row per document: the hash of its text, and the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(t.as_py(), size) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(found.view(np.int64))], names=["doc_id", "hash", "fp"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, hash long, fp long")


def gray_rank(fp: Column) -> Column:
    """Rank of a fingerprint in Gray order; signed longs sort as the unsigned ranks do."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(_TOP))


def _rank(fps: np.ndarray) -> np.ndarray:
    out = fps.view(np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class Tree:
    """Hierarchical index over fingerprints sorted by Gray rank.

    ``masks[k]``, ``values[k]``: per node of level ``k`` (0 is the root level), the bits
    its members share and no ancestor holds, and their values.  The last level are
    the members, with all bits that are left.
    """

    def __init__(self, fps: np.ndarray, fanout: int = FANOUT):
        self.members = fps.view(np.uint64)[np.argsort(_rank(fps), kind="stable")]
        self.fanout = fanout
        all_and, all_or = [self.members], [self.members]
        while len(all_and[-1]) > 1:
            at = np.arange(0, len(all_and[-1]), fanout)
            all_and.append(np.bitwise_and.reduceat(all_and[-1], at))
            all_or.append(np.bitwise_or.reduceat(all_or[-1], at))
        self.masks, self.values, above = [], [], None
        for ones, some in zip(reversed(all_and), reversed(all_or)):
            shared = ~(ones ^ some)
            parent = np.uint64(0) if above is None else above[np.arange(len(ones)) // fanout]
            self.masks.append(shared & ~parent)
            self.values.append(ones)
            above = shared

    def search(self, queries: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (query, member) at most ``bits`` apart, in bounded batches."""
        todo = [(0, np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint8))]
        queries = queries.view(np.uint64)
        while todo:
            level, q, node, so_far = todo.pop()
            if len(q) * self.fanout > FRONTIER and len(q) > 1:
                for part in np.array_split(np.arange(len(q)), 2):
                    todo.append((level, q[part], node[part], so_far[part]))
                continue
            differ = (queries[q] ^ self.values[level][node]) & self.masks[level][node]
            so_far = so_far + np.bitwise_count(differ)
            near = so_far <= bits
            q, node, so_far = q[near], node[near], so_far[near]
            if not len(q):
                continue
            if level == len(self.masks) - 1:
                yield q, node
                continue
            child = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
            inside = child < len(self.values[level + 1])
            q, so_far = np.repeat(q, self.fanout)[inside], np.repeat(so_far, self.fanout)[inside]
            todo.append((level + 1, q, child[inside], so_far))


def forest(n: int, batches) -> np.ndarray:
    """Per node the smallest node it reaches over the links in ``batches`` of (a, b) arrays."""
    root = np.arange(n)
    for a, b in batches:
        while True:
            x, y = root[a], root[b]
            if (x == y).all():
                break
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def links(distinct: DataFrame, bits: int = MAX_BITS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(a, b)``: a forest over the fingerprints of each range that spans all links there.

    ``distinct``: one row per fingerprint, column ``fp``; it is read several times.
    """
    spark = distinct.sparkSession
    ship(spark)
    ranked = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
    n = distinct.count()
    k = max(1, min(MAX_RANGES, max(-(-n // range_rows), min(MIN_RANGES, n // 256))))
    cuts = []
    if k > 1:
        steps = [i / k for i in range(1, k)]
        cuts = sorted(set(ranked.agg(F.percentile_approx("rank", steps, 20 * k)).first()[0]))
    edges = np.array(cuts, np.int64).view(np.uint64) ^ np.uint64(1 << 63)  # as unsigned ranks

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = np.searchsorted(edges, _rank(b.column(0).to_numpy()))
            yield pa.record_batch([b.column(0), pa.array(home, pa.int64())], names=["fp", "home"])

    ranged = distinct.select("fp").mapInArrow(place, "fp long, home long")
    pattern = ranged.groupBy("home").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some")).orderBy("home").collect()
    homes = np.array([p["home"] for p in pattern], np.int64)
    ones = np.array([p["ones"] for p in pattern], np.int64).view(np.uint64)
    mask = ~(ones ^ np.array([p["some"] for p in pattern], np.int64).view(np.uint64))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(64, (1 << 18) // len(homes))
            for at in range(0, whole.num_rows, step):
                fp = whole.slice(at, step).column(0).to_numpy()
                home = np.searchsorted(edges, _rank(fp))  # not from a step before: that would be a second worker a task
                apart = np.bitwise_count((fp.view(np.uint64)[:, None] ^ ones) & mask)
                # a pair is found once: in the later one of its two ranges
                row, to = np.nonzero((apart <= bits) & (homes >= home[:, None]))
                cols = [pa.array(homes[to]), pa.array(fp[row]), pa.array(homes[to] == home[row])]
                yield pa.record_batch(cols, names=["range_id", "fp", "own"])

    def search(key, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["own"].to_numpy()
        members, others = (np.unique(rows["fp"].to_numpy()[x]) for x in (own, ~own))
        tree = Tree(members)
        fps = np.concatenate([tree.members.view(np.int64), others])
        root = forest(len(fps), tree.search(fps, bits))
        moved = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[moved], "b": fps[root[moved]]})

    sent = distinct.select("fp").mapInArrow(probes, "range_id long, fp long, own boolean")
    return sent.groupBy("range_id").applyInPandas(lambda key, rows: search(key, rows), "a long, b long")


def groups(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``(fp, first)``: the first document of the component of each fingerprint.

    ``first`` is the struct of the smallest id (nulls last) and, of its rows, the
    smallest text hash.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    nodes = staged(prints.groupBy("fp").agg(F.min(row).alias("least")), "nodes")
    grouped = components(links(nodes.select("fp"), bits))
    grouped = nodes.join(grouped, nodes.fp == grouped.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = grouped.groupBy("component").agg(F.min("least").alias("first"))
    return grouped.join(named, "component").select("fp", "first")


def near_duplicates(
    docs: DataFrame, bits: int = MAX_BITS, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document."""
    prints = staged(fingerprints(docs, id_col, text_col, size), "fingerprints")
    joined = prints.join(groups(prints, bits), "fp")
    return joined.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_first(
    docs: DataFrame, bits: int = MAX_BITS, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group: the one whose id names the component.

    The first documents are found by id and text hash; only if such a key occurs
    twice are equal rows dropped, which takes a shuffle of its own.
    """
    prints = staged(fingerprints(docs, id_col, text_col, size), "fingerprints")
    i, h = free_name(docs, "_id"), free_name(docs, "_hash")
    at = lambda c: F.coalesce(c, F.lit(_TOP))
    first = groups(prints, bits).select(at(F.col("first.doc_id")).alias(i), F.col("first.hash").alias(h)).distinct()
    keyed = docs.withColumn(i, at(F.col(id_col).cast("long"))).withColumn(h, F.xxhash64(text_col))
    kept = keyed.join(first, [i, h], "left_semi")
    if not prints.groupBy("doc_id", "hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([i, h])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
