"""Spelling variants: words at one edit, and the frequent form that each belongs to.

Two words at one edit agree in half of the shorter word before or behind the edit.  So
each word stands in at most four lists, by length and by its first or last half, and the
pairs of a list differ only in the middle that the list leaves open.  A list of over
``LIST_WORDS`` words is split the same way, by half of its middle; a middle of one
letter ends that, so no list outgrows its alphabet however many words share a half.
Rows come sorted, a task scans one list at a time.

A list is scanned as a sorted vocabulary: for each word the rows of the banded edit
matrix are kept for the prefix that the next word shares with the one before, and where
a prefix is beyond one edit already, all words that begin with it are skipped.

Defined results: null and empty texts have no words; a null id counts as the empty text
in the checksum; repeated rows count each; an empty table gives an empty result; words of
equal count take the smallest near word in code-point order; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged

MIN_LETTERS = 6
MIN_COUNT = 5
FORM_RATIO = 5
DAMAGE = 199  # a run whose checksum this divides loses a letter
LIST_WORDS = 2000
HELD_WORDS = 200_000  # distinct words that a task counts before it passes them on

_LETTERS = bytes(b if chr(b).isalpha() and b < 128 or b >= 0xC0 else 32 for b in range(256)).lower()


def runs_of(text: str) -> list[bytes]:
    """The letter runs of a text as Latin-1, A-Z lower-cased; characters beyond it separate runs."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def words_of(doc_id: int | None, text: str, least: int = MIN_LETTERS) -> Iterator[tuple[bytes, int]]:
    """Distinct words of one document with their counts, damaged runs after their damage."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs_of(text)).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            yield run, n


def count_words(docs: DataFrame, least: int, count: int, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)``: words of at least ``least`` letters and ``count`` occurrences."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.record_batch([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                for word, n in words_of(doc_id.as_py(), text.as_py() or "", least):
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held = Counter()
        yield out()

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(part, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _frames(words: DataFrame, first: bool = False) -> DataFrame:
    """Split every list in two: by the half of its open middle behind or before the edit.

    ``size`` is the length of a list's shorter words, ``left`` and ``right`` how many
    letters its words share at each end.
    """
    if first:
        size = F.explode(F.array(F.length("word"), F.length("word") - 1))
        words = words.select("word", size.alias("size"), F.lit(0).alias("left"), F.lit(0).alias("right"))
    half = F.floor((F.col("size") - F.col("left") - F.col("right")) / 2).cast("int")
    return words.withColumn("half", half).select(
        "word", "size", F.explode(F.array(*[F.struct(a.alias("left"), b.alias("right")) for a, b in (
            (F.col("left") + F.col("half"), F.col("right")), (F.col("left"), F.col("right") + F.col("half")))])).alias("f"),
    ).select("word", "size", "f.left", "f.right")


def _key() -> Column:
    """What the words of a list share; their length is never part of it."""
    ends = F.concat_ws("\n", F.substring("word", F.lit(1), F.col("left")), F.expr("right(word, right)"))
    return F.concat_ws("\n", "size", "left", "right", ends)


def word_lists(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``(key, word, size, left, right)``: the lists that together hold every pair at one edit."""
    rows = _frames(words, first=True)
    done = None
    while True:
        keyed = staged(rows.withColumn("key", _key()), "word_lists")
        long = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.col("size") - F.col("left") - F.col("right")).alias("open"))
        long = staged(long.where((F.col("n") > list_words) & (F.col("open") > 1)).select("key"), "long_lists")
        fit = keyed.join(long, "key", "left_anti")
        done = fit if done is None else done.unionByName(fit)
        if long.isEmpty():
            return done
        rows = _frames(keyed.join(long, "key", "left_semi"))


def scan(words: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Pairs ``(i, j)`` of one sorted list at exactly one edit, ``words[i]`` of length ``size``.

    ``words`` are the open middles.  Row ``d`` of the matrix holds, for the first ``d``
    letters of the scanned word, the edits to the query's first ``d - 1``, ``d`` and ``d + 1``
    letters; a value over one stands for two.
    """
    n = len(words)
    shared = [0] * (n + 1)
    for j in range(1, n):
        a, b = words[j - 1], words[j]
        d, top = 0, min(len(a), len(b))
        while d < top and a[d] == b[d]:
            d += 1
        shared[j] = d
    shared[n] = -1
    jump, open_ = [n] * (n + 1), [n]  # the next word that shares fewer letters with its neighbour
    for j in range(n - 1, -1, -1):
        while shared[open_[-1]] >= shared[j] and open_[-1] != n:
            open_.pop()
        jump[j] = open_[-1]
        open_.append(j)
    for i, q in enumerate(words):
        if len(q) != size:
            continue
        rows = [(2, 0, 1)]
        j = 0
        while j < n:
            w = words[j]
            del rows[shared[j] + 1 :]
            dead = False
            while len(rows) <= len(w):
                d = len(rows)
                low, mid, high = rows[-1]
                c = w[d - 1]
                x = min(2, low + (d - 2 < 0 or d - 2 >= size or q[d - 2] != c), mid + 1) if d - 1 <= size else 2
                y = min(mid + (q[d - 1] != c), x + 1, high + 1) if d <= size else 2
                z = min(high + (q[d] != c), y + 1) if d + 1 <= size else 2
                if x > 1 and y > 1 and z > 1:
                    dead = True
                    break
                rows.append((x, y, z))
            if dead:
                d = len(rows)
                j += 1
                while shared[j] >= d:  # all that begin with these d letters
                    j = jump[j]
                continue
            if i != j and rows[len(w)][size - len(w) + 1] == 1:
                yield i, j
            j += 1


def near_pairs(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``(word, near)``: every ordered pair of words at exactly one edit."""
    rows = word_lists(words, list_words)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, at = None, [], (0, 0, 0)
        found: list[tuple[str, str]] = []

        def close() -> None:
            size, left, right = at
            if len(held) < 2:
                return
            middles = [w[left : len(w) - right] for w in held]
            for i, j in scan(middles, size - left - right):
                found.append((held[i], held[j]))
                if len(held[j]) > size:  # the longer word is no query of this list
                    found.append((held[j], held[i]))

        def out() -> pa.RecordBatch:
            cols = zip(*found) if found else ((), ())
            return pa.record_batch([pa.array(c, pa.string()) for c in cols], names=["word", "near"])

        for b in batches:
            for k, w, *frame in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    close()
                    key, held, at = k, [], frame
                if not held or held[-1] != w:
                    held.append(w)
            if len(found) > 10_000:
                yield out()
                found.clear()
        close()
        yield out()

    ship(words.sparkSession)
    middle = F.expr("substring(word, left + 1, length(word) - left - right)")
    # a list of one word has no pair: drop it before the sort
    sized = rows.withColumn("m", F.count("*").over(W.partitionBy("key"))).where("m > 1")
    lists = sized.withColumn("middle", middle).sortWithinPartitions("key", "middle", "word")
    return lists.select("key", "word", "size", "left", "right").mapInArrow(pairs, "word string, near string").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for words with a form, by doubling: a form has a larger count, so chains end."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        moved = at.join(step, "root", "left")
        if moved.where("up is not null").isEmpty():
            return at
        at = staged(moved.select("word", F.coalesce("up", "root").alias("root")), "roots")


def variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    form_ratio: int = FORM_RATIO,
    list_words: int = LIST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the texts."""
    words = staged(count_words(docs, min_letters, min_count, id_col, text_col), "words")
    pairs = staged(near_pairs(words.select("word"), list_words), "near_words")
    sizes = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    near = pairs.join(sizes, "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    both = words.join(near, "word", "left")
    counts = -F.col("best.m") >= form_ratio * F.col("n")
    formed = staged(
        both.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(counts, F.col("best.near")).alias("form"), F.when(counts, -F.col("best.m")).alias("form_n"),
        ), "forms",
    )
    top = roots(formed.where("form is not null"))
    return formed.join(top, "word", "left").withColumn("root", F.coalesce("root", "word"))
