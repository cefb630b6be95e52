"""Embedding near-duplicates through a pivot-permutation index.

Reference vectors (pivots) are drawn by a seeded hash and thinned so that no two are
alike.  A vector is described by its ``NEAREST`` pivots, nearest first.  Inverted lists
hold, per label and pivot, the vectors that name the pivot; two vectors are
candidates if they share at least ``SHARED`` pivots, which is counted in the lists, and
a candidate pair becomes a link if its cosine, in double precision, reaches the
threshold.  A pair that shares several pivots is verified in the list of the first.

Equal vectors of a label are one node with a number of copies.  Long lists are cut
into blocks, and each pair of blocks is one group, so no group holds more than two
blocks and a hot list spreads over many tasks.  Groups return link counts and a
spanning forest, not pairs.

Defined results: a vector that is null, zero, or holds a null or non-finite
component, or whose label is null, links with nothing and is its own component;
vectors of different length link with nothing; repeated ids are rows of their own, and
a component's id is the smallest non-null id of its rows; a null id is kept only if
its component has no other.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import components, ship, staged
from callfacts.llm.simhash import forest

THRESHOLD = 0.98
NEAREST = 8
SHARED = 2
MIN_PIVOTS, MAX_PIVOTS = 32, 1024  # so the pivots are at most 1024 vectors
ALIKE = 0.9  # cosine from which a drawn pivot is left out beside an earlier one
BLOCK = 1024
SEED = 5


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares of extreme values stay finite."""
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, node, vec)``; node and vec are null for vectors that link with nothing.

    ``vec``: components as packed doubles; ``node``: a 128-bit hash of label and vec.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, vecs = [], []
            for v, label in zip(b.column(1), b.column(2).to_pylist()):
                x = v.values.to_numpy(zero_copy_only=False).astype("<f8") if v.is_valid and label is not None else np.empty(0)
                # a null component is NaN here; adding 0.0 makes -0.0 and 0.0 equal
                good = len(x) and np.isfinite(x).all() and x.any()
                vecs.append((x + 0.0).tobytes() if good else None)
                nodes.append(xxhash.xxh3_128_digest(str(label).encode() + b"/" + vecs[-1]) if good else None)
            cols = [b.column(0), b.column(2), pa.array(nodes, pa.binary()), pa.array(vecs, pa.binary())]
            yield pa.record_batch(cols, names=["vec_id", "label", "node", "vec"])

    ship(rows.sparkSession)
    slim = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_v"), F.col(label_col).cast("string").alias("_l"))
    return slim.mapInArrow(pack, "vec_id long, label string, node binary, vec binary")


def choose_pivots(nodes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Per length of vector the pivots, as unit rows; about four times the root of n of them."""
    m = min(MAX_PIVOTS, max(MIN_PIVOTS, math.ceil(4 * math.sqrt(n))))
    cut = 1 << 30 if n <= 2 * m else int(2 * m / n * (1 << 30)) + 1
    drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1 << 30)) < cut).orderBy("node").limit(4 * m)
    by_size: dict[int, list[np.ndarray]] = {}
    for r in drawn.select("vec").collect():
        v = _unit(np.frombuffer(r["vec"], "<f8")[None])[0]
        kept = by_size.setdefault(len(v), [])
        if len(kept) < m and (not kept or (np.array(kept) @ v).max() < ALIKE):
            kept.append(v)
    return {d: np.array(p) for d, p in by_size.items()}


def postings(nodes: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """``(label, size, pivot, node, copies, order, vec)``: each node in the lists of its nearest pivots."""
    held = nodes.sparkSession.sparkContext.broadcast(pivots)
    names = ["label", "size", "pivot", "node", "copies", "order", "vec"]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                out = []
                for label, node, copies, vec in zip(*(c.to_pylist() for c in whole.slice(at, 2048).columns)):
                    x = np.frombuffer(vec, "<f8")
                    # a length that no pivot has: one list for all its vectors
                    near = [0]
                    if (p := held.value.get(len(x))) is not None:
                        near = np.argsort(-(p @ _unit(x[None])[0]), kind="stable")[:nearest].tolist()
                    order = np.array(near, "<i4").tobytes()
                    out += [(label, len(x), p, node, copies, order, vec) for p in near]
                types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return nodes.select("label", "node", "copies", "vec").mapInArrow(
        post, "label string, size int, pivot int, node binary, copies long, order binary, vec binary"
    )


def match_blocks(rows: pd.DataFrame, first: np.ndarray, pivot: int, same: bool, threshold: float, shared: int):
    """Link counts and forest of the pairs of two blocks whose first shared pivot is ``pivot``."""
    order = [np.frombuffer(o, "<i4") for o in rows["order"]]
    named = np.unique(np.concatenate(order))
    has = np.zeros((len(rows), len(named)), np.float32)
    for i, o in enumerate(order):
        has[i, np.searchsorted(named, o)] = 1
    x = _unit(np.stack([np.frombuffer(v, "<f8") for v in rows["vec"]]))
    copies = rows["copies"].to_numpy(np.int64)
    before = has[:, : np.searchsorted(named, pivot)]
    a_all, b_all = np.flatnonzero(first), np.flatnonzero(first if same else ~first)
    links, pairs = np.zeros(len(rows), np.int64), []
    need = min(shared, min(map(len, order)))
    for at in range(0, len(a_all), 256):
        a = a_all[at : at + 256]
        # shared pivots, none of them before this list's, so that the pair is met here only
        near = (has[a] @ has[b_all].T >= need) & (before[a] @ before[b_all].T == 0)
        if same:
            near &= a[:, None] < b_all[None]
        i, j = np.nonzero(near)
        for cut in range(0, len(i), 200_000):
            p, q = a[i[cut : cut + 200_000]], b_all[j[cut : cut + 200_000]]
            good = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
            p, q = p[good], q[good]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            pairs.append((p, q))
    return links, forest(len(rows), pairs)


def link_blocks(posted: DataFrame, threshold: float, shared: int, block: int = BLOCK) -> DataFrame:
    """``(node, other, n)``: link counts (other is null) and forest edges of all lists' block pairs."""
    key = ["label", "size", "pivot"]
    sizes = posted.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int")
    spread = posted.join(sizes, key).withColumn("own", own).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = spread.withColumn("lo", F.least("own", "mate")).withColumn("hi", F.greatest("own", "mate"))

    def match(key, rows: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, lo, hi = key
        links, root = match_blocks(rows, (rows["own"] == lo).to_numpy(), int(pivot), lo == hi, threshold, shared)
        node = rows["node"].to_numpy()
        has, moved = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(rows)))
        return pd.DataFrame({
            "node": np.concatenate([node[has], node[moved]]),
            "other": np.concatenate([np.full(len(has), None), node[root[moved]]]),
            "n": np.concatenate([links[has], np.zeros(len(moved), np.int64)]),
        })

    return pairs.groupBy(*key, "lo", "hi").applyInPandas(match, "node binary, other binary, n long")


def near_duplicates(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector."""
    packed = staged(valid_vectors(rows, id_col, vec_col, label_col), "vectors")
    grouped = packed.where("node is not null").groupBy("label", "node", "vec")
    nodes = staged(grouped.agg(F.count("*").alias("copies"), F.min("vec_id").alias("least")), "nodes")
    pivots = choose_pivots(nodes, nodes.count())
    found = staged(link_blocks(postings(nodes, pivots, nearest), threshold, shared, block), "links")
    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("far"))
    joined = components(found.where("other is not null"), "node", "other")
    named = (
        nodes.select("node", "copies", "least")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select("node", "least", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    named = staged(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    info = named.join(least, "component").select("node", "n_links", "component_id")
    out = packed.select("vec_id", "node").join(info, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
