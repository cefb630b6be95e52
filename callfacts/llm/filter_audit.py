"""Filter interaction audit: what each filter removes, in every order of the filters.

Each document gets a mask of the filters it fails.  Copies are found in radix text tries:
a task first inserts its own texts, keeps one row of each text, the one of its smallest id,
and decides all others; what is left is dealt by ranges of text prefixes, and each prefix
has its trie.  A prefix that holds over ``PREFIX_BYTES`` is made longer until it does not;
a whole text that still does is dealt over salts and thinned again until few rows are left.
Tries are compressed: an edge holds a run of bytes, a terminal the smallest id.

Masks are counted per part; every order and step is a sum over at most 32 of those counts.

Defined results: a null text counts as empty, a null part as the empty string; a text that
a row of the same id repeats is no copy; rows with a null id neither are copies nor make
any; repeated rows count each; repeated label rows of an id count once (label 1 wins); an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
PREFIX_BYTES = 8 << 20  # texts that one trie holds
DEPTH = 16  # letters of the shortest prefix
TRIE_BYTES = 32 << 20  # texts that a task's own trie holds before it starts anew
SALT_ROWS = 1000
_CAPITALS, _REST = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"


def mask_of(text: bytes) -> int:
    """The filters A to D that a text fails, one bit each."""
    words = text.split()  # bytes split at ASCII white space only
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _REST)))
    symbols = len(text.translate(None, _SYMBOLS)) < len(text)
    return (n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * capitals > 5 * points) << 2 | symbols << 3


class Trie:
    """A compressed radix trie; terminals are numbered and hold the smallest inserted id."""

    __slots__ = ("root", "least")

    def __init__(self):
        self.root: dict = {}  # first byte -> [label, children, terminal or -1]
        self.least: list[int] = []

    def _terminal(self, doc_id: int) -> int:
        self.least.append(doc_id)
        return len(self.least) - 1

    def insert(self, text: bytes, doc_id: int) -> int:
        """The number of the text's terminal."""
        node, at = [b"", self.root, -1], 0
        if not text:
            text = b"\x00\xff"  # no UTF-8 text has this; stands for the empty one
        while True:
            edge = node[1].get(text[at])
            if edge is None:
                end = self._terminal(doc_id)
                node[1][text[at]] = [text[at:], {}, end]
                return end
            label = edge[0]
            if not text.startswith(label, at):  # split the edge where they part
                low, high = 1, min(len(label), len(text) - at)
                while low < high:
                    half = (low + high + 1) // 2
                    low, high = (half, high) if text.startswith(label[:half], at) else (low, half - 1)
                below = [label[low:], edge[1], edge[2]]
                edge[0], edge[1], edge[2] = label[:low], {label[low]: below}, -1
                label = edge[0]
            at += len(label)
            node = edge
            if at == len(text):
                if edge[2] < 0:
                    edge[2] = self._terminal(doc_id)
                elif doc_id < self.least[edge[2]]:
                    self.least[edge[2]] = doc_id
                return edge[2]


_ROWS = "doc_id long, part string, mask int, text binary, n long"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64())
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=_NAMES)


def _settled(rows: list[tuple], last: bool) -> Iterator[tuple]:
    """Rows of one trie, ``(id, part, mask, text, n)``: decided ones come back without text.

    Rows equal in id, part and text become one that counts them.  A row whose text has a
    smaller id fails the copy filter; the others stay open, with their text, unless this
    is the text's ``last`` trie.
    """
    trie, held = Trie(), {}
    for doc_id, part, mask, text, n in rows:
        row = held.setdefault((trie.insert(text, doc_id), doc_id, part), [mask, text, 0])
        row[2] += n
    for (end, doc_id, part), (mask, text, n) in held.items():
        if doc_id > trie.least[end]:
            yield doc_id, part, mask | 1 << COPY, None, n
        else:
            yield doc_id, part, mask, None if last else text, n


def _own_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of all rows of a task; copies of its own smaller ids are decided."""
    rows, held, out = [], 0, []
    for whole in batches:
        for cut in range(0, whole.num_rows, 500):
            for doc_id, part, text in zip(*(c.to_pylist() for c in whole.slice(cut, 500).columns)):
                text = text or b""
                mask = mask_of(text)
                if doc_id is None:
                    out.append((None, part, mask, None, 1))
                else:
                    rows.append((doc_id, part, mask, text, 1))
                    held += len(text) + 100
            if held > TRIE_BYTES:
                yield _batch(list(_settled(rows, False)))
                rows, held = [], 0
    yield _batch([*out, *_settled(rows, False)])


def _group_tries(last: bool):
    """One trie for each run of equal first columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for whole in batches:
            for cut in range(0, whole.num_rows, 500):
                out = []
                for k, *row in zip(*(c.to_pylist() for c in whole.slice(cut, 500).columns)):
                    if k != key:
                        out += _settled(rows, last)
                        key, rows = k, []
                    rows.append(row)
                if out:
                    yield _batch(out)
        yield _batch(list(_settled(rows, last)))

    return run


def prefixed(texts: DataFrame, prefix_bytes: int, depth: int = DEPTH) -> tuple[DataFrame, DataFrame | None]:
    """``texts`` with the column ``prefix``; rows of whole texts that alone exceed it come second.

    A prefix is ``depth`` letters, or four times as many where those hold too much, and so on.
    """
    rows, done = texts, None
    while True:
        cut = F.substring("text", 1, depth)
        sized = rows.groupBy(cut.alias("prefix")).agg(
            F.sum(F.octet_length("text") + 100).alias("size"), F.max(F.octet_length("text")).alias("longest")
        )
        heavy = staged(sized.where(F.col("size") > prefix_bytes).select("prefix", "longest"), "heavy_prefixes")
        keyed = rows.withColumn("prefix", cut)
        if heavy.isEmpty():
            return (keyed if done is None else done.unionByName(keyed)), None
        light = keyed.join(heavy, "prefix", "left_anti")
        done = light if done is None else done.unionByName(light)
        rows = staged(keyed.join(heavy.select("prefix"), "prefix", "left_semi").drop("prefix"), "heavy_texts")
        if heavy.agg(F.max("longest")).first()[0] <= depth:
            return done, rows
        depth *= 4


def masks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    prefix_bytes: int = PREFIX_BYTES,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """``(doc_id, part, mask, n)`` of every document; bit ``k`` of the mask is filter ``FILTERS[k]``.

    ``n`` is how many rows the document has, over 1 only where rows repeat an id, part and text.
    """
    ship(docs.sparkSession)
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), F.col(text_col).cast("binary").alias("text"))
    first = staged(slim.mapInArrow(_own_tries, _ROWS), "own_tries")
    decided, open_ = [first.where("text is null")], first.where("text is not null")
    size = open_.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    n = 0
    while True:
        texts, hot = prefixed(open_, prefix_bytes)
        shards = max(1, docs.sparkSession.sparkContext.defaultParallelism, size // prefix_bytes + 1)
        dealt = texts.select("prefix", *_NAMES).repartitionByRange(shards, "prefix").sortWithinPartitions("prefix")
        decided.append(dealt.mapInArrow(_group_tries(True), _ROWS))
        if hot is None:
            break
        before, n = n, hot.groupBy(F.xxhash64("text")).count().agg(F.max("count")).first()[0]
        if n <= salt_rows or n == before:  # few rows of very long texts, or nothing left to thin
            dealt = hot.select(F.col("text").alias("prefix"), *_NAMES).repartition(shards, "prefix").sortWithinPartitions("prefix")
            decided.append(dealt.mapInArrow(_group_tries(True), _ROWS))
            break
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(-(-n // salt_rows)))
        key = F.concat_ws(":", F.xxhash64("text"), salt)
        dealt = hot.select(key.alias("prefix"), *_NAMES).repartition(shards, "prefix").sortWithinPartitions("prefix")
        thin = staged(dealt.mapInArrow(_group_tries(False), _ROWS), "salted_tries")
        decided.append(thin.where("text is null"))
        open_ = thin.where("text is not null")
    every = decided[0]
    for d in decided[1:]:
        every = every.unionByName(d)
    return every.select("doc_id", "part", "mask", "n")


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """``(order, step, bit of its filter, bits of the filters before it)`` of every order and step."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append(("".join(filters[i] for i in order), step, 1 << k, before))
            before |= 1 << k
    return out


def audit(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id", filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step with its counts; ``masked`` as from :func:`masks`.

    Ids are counted by mask and part before they meet the labels.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t"))
    known = known.where("doc_id is not null and (g or t)").groupBy("doc_id").agg(F.max("g").alias("g"), F.max("t").alias("t"))
    rows = masked.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(known, "doc_id", "left")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    counts = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("g").alias("good"), of("t").alias("toxic"))
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 2^filters at most
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("before")) for o, s, b, e in orders(filters)])
    one = staged(cells, "mask_counts").select("part", "cells", F.explode(plan).alias("o"))
    bit, before = F.col("o.bit"), F.col("o.before")

    def total(what: str, when) -> F.Column:
        some = F.filter("cells", lambda c: when(c["mask"]))
        return F.aggregate(F.transform(some, lambda c: c[what]), F.lit(0).cast("long"), lambda a, x: a + x)

    fails = lambda m: m.bitwiseAND(bit) != 0
    here = lambda m: fails(m) & (m.bitwiseAND(before) == 0)
    n_orders = factorial(len(filters))  # a mask of k filters meets each of them first in a k-th of the orders
    share = F.aggregate(
        F.filter("cells", lambda c: fails(c["mask"])), F.lit(0).cast("long"),
        lambda a, c: a + c["n"] * (F.lit(n_orders) / F.bit_count(c["mask"])).cast("long"),
    )
    return one.select(
        "part", "o.filter_order", "o.step",
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        share.alias("shapley"),
    )
