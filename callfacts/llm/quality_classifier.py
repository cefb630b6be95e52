"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document becomes ``FEATURES`` statistics of its whole text.  Random cosines of the
standardised statistics approximate a Gaussian kernel; the normal equations of
the ridge regression are summed in each partition, one small matrix per fold, and
solved on the driver (its size is the number of cosines, not of rows).  Scores of
held-back folds are calibrated by pooling adjacent violators.

Defined results: a null text counts as empty, and an empty text has statistics of
zero; rows are scored one by one, so repeated rows agree; without labels every
score is 0.5, with one class only it is that class's share; an empty table gives an
empty result.  Of the input only the id and the text are read, so other columns may
have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import label_sample, ship, staged

COSINES = 256
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations of the statistics
RIDGE = 1.0
FOLDS = 4
MAX_LABELLED = 50_000  # labelled rows that the model is fitted on
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#*$%&|<>"
_POINT = b".,;:!?"
FEATURES = (
    "words", "word_chars", "distinct_words", "top_word", "distinct_windows", "upper", "digits",
    "symbols", "bangs", "points", "non_ascii", "repeated_lines", "words_a_line", "long_words", "one_char_words",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode()
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    share = lambda drop: (len(raw) - len(raw.translate(None, drop))) / len(raw)
    counts = Counter(words)
    windows = max(1, n - 2)
    sizes = list(map(len, words))
    chars = sum(sizes)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(n),
        chars / n,
        len(counts) / n,
        max(counts.values()) / n,
        len(set(zip(words, words[1:], words[2:]))) / windows,
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        raw.count(b"!") / n,
        share(_POINT),
        (len(raw) - len(text)) / len(raw),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        sum(s > 12 for s in sizes) / n,
        sizes.count(1) / n,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray  # raw scores and their calibrated values, both rising
    values: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.frequency + self.phase)
        return np.c_[np.ones(len(x)), waves]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.cosines(x) @ self.weight, self.knots, self.values)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function nearest to y: pooled adjacent violators, joined at block centres."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of x
    for a, b in zip(x[order], y[order]):
        blocks.append([float(b), 1.0, float(a)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            for i in range(3):
                blocks[-1][i] += last[i]
    knots = np.array([c / n for _, n, c in blocks])
    # a block of one class keeps a little of the other, so ends rank by raw score
    return knots, np.array([(s + 0.5) / (n + 1) for s, n, _ in blocks])


def features(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``x``, the statistics of each document."""
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py()) for t in b.column(b.num_columns - 1)]
            cols = [*b.columns[:-1], pa.array(x, pa.list_(pa.float64()))]
            yield pa.record_batch(cols, names=[*keep, "x"])

    ship(docs.sparkSession)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return docs.select(*keep, text_col).mapInArrow(run, f"{fields}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy().reshape(-1, len(FEATURES)) if len(column) else np.empty((0, len(FEATURES)))


def fit(docs: DataFrame, labels: DataFrame, keep, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``max_labelled`` labelled rows whose id meets ``keep``."""
    spark = docs.sparkSession
    sample = label_sample(labels, "quality", keep, max_labelled)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    train = rows.join(F.broadcast(sample), F.col("_id") == F.col("_lid"))  # at most max_labelled rows of 12 bytes
    train = train.withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(FOLDS)).cast("int"))
    table = staged(features(train, ["_y", "_fold"], text_col="_text"), "quality_features")
    columns = [F.col("x")[i] for i in range(len(FEATURES))]
    moments = table.agg(F.count("*").alias("n"), F.avg("_y").alias("y"), *[f(c) for c in columns for f in (F.avg, F.stddev_pop)]).first()
    rng = np.random.default_rng(12)
    got = np.array([v or 0.0 for v in moments[2:]], float).reshape(-1, 2)
    model = Model(
        mean=got[:, 0],
        scale=np.maximum(got[:, 1], 1e-6),
        frequency=rng.normal(0, 1 / WIDTH, (len(FEATURES), COSINES)),
        phase=rng.uniform(0, 2 * np.pi, COSINES),
        weight=np.zeros(COSINES + 1),
        knots=np.array([0.0, 1.0]),
        values=np.full(2, 0.5 if moments["y"] is None else moments["y"]),
    )
    if not moments["n"] or moments["y"] in (0.0, 1.0):
        return model
    held = spark.sparkContext.broadcast(model)
    size = COSINES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((FOLDS, size, size)), np.zeros((FOLDS, size))
        for b in batches:
            phi, y, fold = held.value.cosines(_matrix(b.column(2))), b.column(0).to_numpy(), b.column(1).to_numpy()
            for k in range(FOLDS):
                part = phi[fold == k]
                left[k] += part.T @ part
                right[k] += part.T @ y[fold == k]
        yield pa.record_batch([pa.array([left.tobytes()], pa.binary()), pa.array([right.tobytes()], pa.binary())], names=["a", "b"])

    parts = table.coalesce(8).mapInArrow(sums, "a binary, b binary").collect()  # eight rows of 2 MB
    left = sum(np.frombuffer(p["a"]).reshape(FOLDS, size, size) for p in parts)
    right = sum(np.frombuffer(p["b"]).reshape(FOLDS, size) for p in parts)
    ridge = RIDGE * np.eye(size)
    ridge[0, 0] = 1e-9
    solve = lambda a, b: np.linalg.solve(a + ridge, b)
    by_fold = [solve(left.sum(0) - left[k], right.sum(0) - right[k]) for k in range(FOLDS)]
    model.weight = solve(left.sum(0), right.sum(0))
    rows = table.limit(2 * max_labelled).toArrow().combine_chunks()
    x, y, fold = _matrix(rows["x"].combine_chunks()), rows["_y"].to_numpy(), rows["_fold"].to_numpy()
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = model.cosines(x[fold == k]) @ by_fold[k]
    model.knots, model.values = isotonic(raw, y)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every document."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(1)], float).reshape(-1, len(FEATURES))
            yield pa.record_batch([b.column(0), pa.array(held.value.score(x))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, score double")
