"""Line dedup by winnowing: later copies of runs of lines are deleted.

A run is a sequence of lines with words.  Line hashes are joined to grams, the
shortest runs of at least ``GRAM_WORDS`` words; of the grams inside a run of at least
``RUN_WORDS`` words the one with the smallest hash is its fingerprint, so any two
equal runs of that length share a fingerprint, wherever they stand.  Fingerprints
that occur at one position only are dropped.  At the others the match is extended
both ways: the shortest runs of ``RUN_WORDS`` words that start and that end at each
line around the fingerprint are compared, and a run that has an earlier occurrence
marks its lines.  The union of the marked runs is the maximal match, so a line goes
if and only if it lies in a run of ``RUN_WORDS`` words or more that occurs earlier,
by document id, then line.

Groups are only aggregated (first and last position, first occurrence), so a passage
in a third of all documents makes one row per occurrence and no pairs.

Defined results: a null text stays null; lines are compared by their words, white space
apart; lines without words belong to the run around them; rows with equal id and text
are one document, keep the same lines and stay as many rows as they were; null ids
come first in the order; an empty table gives an empty result.  Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged
from callfacts.llm.quality_rules import free_name

RUN_WORDS = 50
GRAM_WORDS = 25
_NO_ID = -(1 << 63)


def runs_of(text: str, run_words: int = RUN_WORDS, gram_words: int = GRAM_WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """``(start, end, position, fingerprint, run)`` of the shortest runs from and to each line.

    Start, end and position are line numbers; the fingerprint is the smallest gram
    hash inside the run and position the line that its gram starts at.
    """
    at, size, key = [], [], []
    for i, line in enumerate(text.split("\n")):
        words = line.split()
        if words:
            at.append(i)
            size.append(len(words))
            key.append(xxhash.xxh3_128_digest(" ".join(words)))
    n = len(at)
    total = [0]
    for s in size:
        total.append(total[-1] + s)
    if total[-1] < run_words:
        return []

    def reach(words: int) -> list[int]:
        """Per line the end (exclusive) of the shortest run from it with so many words; n + 1 if none."""
        out, e = [], 0
        for p in range(n):
            while e <= n and (e <= p or total[e] - total[p] < words):
                e += 1
            out.append(e)
        return out

    gram_end, run_end = reach(gram_words), reach(run_words)
    grams = [xxhash.xxh3_64_intdigest(b"".join(key[p:e])) if e <= n else None for p, e in enumerate(gram_end)]
    spans = {(p, e) for p, e in enumerate(run_end) if e <= n}
    p = 0
    for e in range(1, n + 1):  # the shortest run that ends before line e
        if total[e] < run_words:
            continue
        while total[e] - total[p + 1] >= run_words:
            p += 1
        spans.add((p, e))
    found = []
    for p, e in sorted(spans):
        low, q = min((grams[q], -q) for q in range(p, e) if gram_end[q] <= e)
        found.append((at[p], at[e - 1], at[-q], low - (1 << 63), xxhash.xxh3_128_digest(b"".join(key[p:e]))))
    return found


def runs(docs: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """One row per run; ``docs``: ``_id``, ``_hash`` (of the text) and ``_text``."""
    names = ["_id", "_hash", "start", "end", "position", "print", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for cut in range(0, whole.num_rows, 1000):
                b = whole.slice(cut, 1000)
                rows = []
                for i, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    rows += [(i, h, *r) for r in runs_of(text.as_py(), run_words, gram_words)]
                if rows:
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    ship(docs.sparkSession)
    return docs.where("_text is not null").mapInArrow(
        run, "_id long, _hash long, start int, end int, position int, print long, run binary"
    )


def later_lines(docs: DataFrame, run_words: int = RUN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """``(_id, _hash, spans)``: the line spans to delete in each document that has any.

    A document's spans are collected together, once however many rows repeat it; there
    are at most two a line of it.
    """
    found = staged(runs(docs, run_words, gram_words), "line_runs")
    place = F.struct("_id", "_hash", "position")
    repeated = found.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a < z").select("print")
    near = found.join(repeated, "print", "left_semi")
    own = F.struct("_id", "_hash", "start")
    first = near.groupBy("run").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first < last").select("run", "first")
    later = near.join(first, "run").where(own > F.col("first"))
    return later.groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def without_lines(text: Column, spans: Column) -> Column:
    """The text without the lines of ``spans``; the text itself where there are none."""
    lines = F.split(text, "\n")
    gone = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(spans.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(
    docs: DataFrame,
    run_words: int = RUN_WORDS,
    gram_words: int = GRAM_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    removed_col: str = "removed_lines",
) -> DataFrame:
    """``docs`` with later repeated runs deleted from its texts, and the number of deleted lines last."""
    i, h, s = (free_name(docs, x) for x in ("_id", "_hash", "spans"))
    removed = free_name(docs, removed_col)
    keyed = docs.withColumn(i, F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))).withColumn(h, F.xxhash64(text_col))
    slim = keyed.select(F.col(i).alias("_id"), F.col(h).alias("_hash"), F.col(text_col).alias("_text"))
    spans = later_lines(slim, run_words, gram_words).select(F.col("_id").alias(i), F.col("_hash").alias(h), F.col("spans").alias(s))
    joined = keyed.join(spans, [i, h], "left")
    gone = F.array_distinct(F.flatten(F.transform(F.col(s), lambda x: F.sequence(x["start"], x["end"]))))
    kept = [F.col(f"`{c}`") if c != text_col else without_lines(F.col(text_col), F.col(s)).alias(c) for c in docs.columns]
    return joined.select(*kept, F.when(F.col(s).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(removed))
