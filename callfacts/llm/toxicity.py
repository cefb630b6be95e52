"""Toxic passages by maximum-scoring segments, calibrated by extreme values.

Terms get log-odds between labelled toxic and clean documents.  Dirichlet priors
hold back rare terms: a stem (the first ``STEM`` letters) is drawn towards the
corpus, a word towards its stem, so an unseen form of a known stem has a score.
Terms that are significantly more frequent in toxic documents (a likelihood-ratio
test, its bound raised with the number of terms tested) keep their scores, all other
tokens share one negative background score; the scores are those of a passage model in which
one token of ``1 / DENSITY`` is such a term, so lambda of the extreme-value
distribution is 1.  A linear scan (Ruzzo and Tompa) finds every maximal segment of
a text.  ``E = K n exp(-S)`` is the number of segments of score S expected by chance
in n clean tokens, K by maximum likelihood over clean documents.  A document's
evidence is the sum of ``-ln E`` over its segments with E under 1, and a logistic
curve turns it into a score from 0 to 1.

Defined results: null and empty texts hold no passage and get the score of no
evidence; rows are scored one by one, so repeated rows agree; without labels of
both classes no term is significant and every score is the share of label 1 (0
without labels); an empty table gives an empty result.  Of the input only the id and
the text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import label_sample, ship, staged
from callfacts.llm.tokens import Generations

STEM = 4
DENSITY = 0.2
SIGNIFICANT = 4.0  # a term's likelihood ratio must exceed this plus twice the log of the terms tested
E_VALUE = 0.01  # passages expected by chance in a clean document, for those reported
MAX_LABELLED = 50_000  # labelled rows that the model is fitted on
MAX_TERMS = 100_000  # significant terms that the model keeps, the most significant first
HELD_TERMS = 300_000
_EDGES = ".,;:!?\"'()[]{}*_-#$%&|<>"


def term_of(token: str) -> str:
    return token.lower().strip(_EDGES)


@dataclass
class Model:
    """Scores of words and stems, the background score, ln K and the logistic curve."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    background: float = math.log(1 - DENSITY)
    log_k: float = 0.0
    base: float = 0.0
    slope: float = 0.0

    def token_score(self, token: str) -> float:
        """Score of a token; 0 stands for the background."""
        term = term_of(token)
        found = self.words.get(term)
        return self.stems.get(term[:STEM], 0.0) if found is None else found

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * evidence, -40, 40)))


def maximal_segments(hits: list[tuple[int, float]], background: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` of a text, in linear time.

    ``hits``: position and positive score of the tokens that are not background.
    A candidate keeps the running sums before (low) and after (high) it, and the
    last candidate before it whose low is lower, so each is passed over once.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for position, score in hits:
        total += background * (position - at)
        start, low = position, total
        total, at = total + score, position + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((start, at, low, total, j))
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


class Scanner:
    """Finds the segments of texts; tokens' scores are cached."""

    def __init__(self, model: Model):
        self.model, self.cache = model, Generations(model.token_score, 200_000)

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        tokens, cache = (text or "").split(), self.cache
        hits = [(i, s) for i, t in enumerate(tokens) if (s := cache[t])]
        return len(tokens), maximal_segments(hits, self.model.background) if hits else []


def _evidence(n: int, scores: list[float], log_k: float) -> float:
    floor = log_k + math.log(max(n, 1))
    return sum(max(0.0, s - floor) for s in scores)


def count_terms(train: DataFrame) -> DataFrame:
    """``(kind, term, n1, n0)``: training documents of each class that hold a word (0) or stem (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(k, y): Counter() for k in (0, 1) for y in (0, 1)}

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                toxic, clean = counts[kind, 1], counts[kind, 0]
                terms = list(toxic.keys() | clean.keys())
                cols = [
                    pa.array([kind] * len(terms), pa.int32()),
                    pa.array(terms, pa.string()),
                    pa.array([toxic[t] for t in terms], pa.int64()),
                    pa.array([clean[t] for t in terms], pa.int64()),
                ]
                yield pa.record_batch(cols, names=["kind", "term", "n1", "n0"])
                toxic.clear()
                clean.clear()

        for b in batches:
            for text, y in zip(b.column(0), b.column(1).to_pylist()):
                terms = set(map(term_of, set((text.as_py() or "").split()))) - {""}
                counts[0, y].update(terms)
                counts[1, y].update({t[:STEM] for t in terms})
                if len(counts[0, 0]) + len(counts[0, 1]) > HELD_TERMS:
                    yield from flush()
        yield from flush()

    parts = train.select("_text", "_y").mapInArrow(run, "kind int, term string, n1 long, n0 long")
    return parts.groupBy("kind", "term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def fit_terms(counts: DataFrame) -> Model:
    """The significant words and stems, with the scores of the passage model."""
    counts = staged(counts, "term_counts")
    sums = [F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count("*").alias("terms")]
    totals = {r["kind"]: r for r in counts.groupBy("kind").agg(*sums).collect()}
    if not totals or not totals[0]["n1"] or not totals[0]["n0"]:
        return Model()
    one = {k: float(max(t["n1"], 1)) for k, t in totals.items()}
    zero = {k: float(max(t["n0"], 1)) for k, t in totals.items()}

    def ratio(n1, n0, kind):
        """Likelihood ratio of a term against the shares of the classes; 0 if it is not a toxic one."""
        expected = (n1 + n0) * (one[kind] / (one[kind] + zero[kind]))
        part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
        return F.when(n1 > expected, 2 * (part(n1, expected) + part(n0, n1 + n0 - expected))).otherwise(0.0)

    # a prior of one pseudo-document a class, spread as both classes together
    stems = counts.where("kind = 1").select(
        F.col("term").alias("stem"),
        F.col("n1").alias("s1"),
        F.col("n0").alias("s0"),
        ((F.col("n1") + F.col("n0")) / (one[1] + zero[1])).alias("p"),
    )
    q1 = ((F.col("s1") + F.col("p")) / (one[1] + 1)).alias("q1")
    q0 = ((F.col("s0") + F.col("p")) / (zero[1] + 1)).alias("q0")
    stems = stems.select("*", q1, q0)
    bound = {k: SIGNIFICANT + 2 * math.log(t["terms"]) for k, t in totals.items()}
    toxic_stems = stems.select(F.col("stem").alias("term"), "q1", "q0", ratio(F.col("s1"), F.col("s0"), 1).alias("z")).where(F.col("z") > bound[1])
    words = counts.where("kind = 0").select("term", "n1", "n0", F.substring("term", 1, STEM).alias("stem"))
    words = words.join(stems, "stem")
    share = (F.col("n1") + F.col("n0")) / (F.col("s1") + F.col("s0"))  # of the word in its stem
    w1 = F.col("q1") * (F.col("n1") + share) / (F.col("s1") + 1)
    w0 = F.col("q0") * (F.col("n0") + share) / (F.col("s0") + 1)
    words = words.select("term", w1.alias("q1"), w0.alias("q0"), ratio(F.col("n1"), F.col("n0"), 0).alias("z"), "n0", "n1")
    toxic_words = words.where(F.col("z") > bound[0])
    top = lambda d: d.orderBy(F.desc("z"), "term").limit(MAX_TERMS).select("term", "q1", "q0").collect()
    picked, roots = top(toxic_words), top(toxic_stems)
    if not picked:
        return Model()
    mass1, mass0 = sum(r["q1"] for r in picked), min(0.5, sum(r["q0"] for r in picked))
    lift = math.log(DENSITY / mass1)
    score = lambda r: math.log(r["q1"] / r["q0"]) + lift
    known = {r["term"]: s for r in picked if (s := score(r)) > 0}
    clean = {r["term"] for r in words.where("n0 > n1").join(F.broadcast(toxic_stems.select(F.col("term").alias("stem")).limit(MAX_TERMS)), F.substring("term", 1, STEM) == F.col("stem"), "left_semi").limit(MAX_TERMS).collect()}
    return Model(
        words=known | {t: 0.0 for t in clean},
        stems={r["term"]: s for r in roots if (s := score(r)) > 0},
        background=math.log((1 - DENSITY) / (1 - mass0)),
    )


def calibrate(model: Model, y: np.ndarray, n: np.ndarray, scores: list[list[float]]) -> Model:
    """Set ln K from the clean rows and the logistic curve from all of them."""
    best = np.array([max(s, default=0.0) for s in scores])
    clean = y == 0
    if clean.any():
        total = float((np.maximum(n[clean], 1) * np.exp(-best[clean])).sum())
        model.log_k = math.log(clean.sum() / max(total, 1e-300))
    share = float(y.mean()) if len(y) else 0.0
    model.base = math.log((share + 1e-6) / (1 - share + 1e-6))
    if clean.all() or not clean.any():
        return model
    x = np.array([_evidence(k, s, model.log_k) for k, s in zip(n, scores)])
    beta, design = np.zeros(2), np.c_[np.ones(len(x)), x]
    for _ in range(50):  # Newton with a little ridge, which bounds the slope of separable data
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - np.array([0.0, 0.1]) * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 0.1])
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-7:
            break
    if beta[1] > 0:
        model.base, model.slope = float(beta[0]), float(beta[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, keep, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``max_labelled`` labelled rows whose id meets ``keep``."""
    spark = docs.sparkSession
    ship(spark)
    sample = label_sample(labels, "toxic", keep, max_labelled)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    train = rows.join(F.broadcast(sample), F.col("_id") == F.col("_lid"))  # at most max_labelled rows of 12 bytes
    model = fit_terms(count_terms(train))
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(held.value)
        for b in batches:
            found = [scan.segments(t.as_py()) for t in b.column(0)]
            cols = [b.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array([[s for *_, s in x] for _, x in found], pa.list_(pa.float64()))]
            yield pa.record_batch(cols, names=["y", "n", "s"])

    got = staged(train.select("_text", "_y").mapInArrow(run, "y int, n long, s array<double>"), "toxicity_fit").limit(2 * max_labelled).toArrow()
    return calibrate(model, got["y"].to_numpy(), got["n"].to_numpy(), got["s"].to_pylist())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, passages)``: every significant passage as token span, score and E-value."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        scan = Scanner(model)
        for b in batches:
            evidence, passages = [], []
            for text in b.column(1):
                n, found = scan.segments(text.as_py())
                evidence.append(_evidence(n, [s for *_, s in found], model.log_k))
                floor = model.log_k + math.log(max(n, 1))
                with_e = [(a, z, s, math.exp(min(floor - s, 700.0))) for a, z, s in found]
                passages.append([dict(zip(("start", "end", "score", "e_value"), x)) for x in with_e if x[3] < E_VALUE])
            scores = pa.array(model.probability(np.array(evidence, float)))
            yield pa.record_batch([b.column(0), scores, pa.array(passages, pa.list_(span))], names=["doc_id", "score", "passages"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, score double, passages array<struct<start:int,end:int,score:double,e_value:double>>")
