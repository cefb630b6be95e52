"""Mixing sources to target weights by raking (iterative proportional fitting).

Every cell (source, language, topic) gets a probability, at most 1, such that each margin's
expected kept tokens have its target shares: the cells are raked under that bound, so a cell
that reaches it stays there and the others make up for it.  A document is kept by a seeded
hash of itself, so a retry or a second run keeps the same rows.

``keep`` of all tokens are kept.  Where the targets cannot be met with so many, ``keep`` is
lowered, at most to ``least_keep``; if they cannot be met then, ``UnmetTargets`` says which.
Margins without given targets get those of a mix that can be had: cells in proportion to their
tokens to the power ``TEMPER``, which raises small ones, none beyond all tokens that it has,
raked to the given margins.  (Tempering each margin on its own would ask for shares that no
mix has where, say, a topic occurs in one language only.)

A topic is the nearest of ``TOPICS`` centroids of hashed words.  They are fitted by spherical
k-means over all documents, whose vectors are made once and whose sums per centroid are added
up in Spark; only the first centroids are picked from ``SEEDS`` documents of least hash.

Cells up to ``MAX_CELLS`` are raked on the driver and their probabilities broadcast;
beyond that (many thousand sources) the same sweeps run as joins and sums in Spark.

Tokens are words between ASCII white space, so a text without any has one.

Defined results: null categories are a category of their own; a null text counts as empty
(no tokens, topic 0, kept as its cell says); cells without tokens keep all their
documents; equal rows share their fate; an empty table gives an empty result.  Extra
columns stay, and the new ones take free names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged
from callfacts.llm.quality_rules import free_name

TOPICS = 8
BUCKETS = 512
SEEDS = 256  # documents that the first centroids are picked from
ROUNDS = 10
TEMPER = 0.8
KEEP = 0.7
LEAST_KEEP = 0.35
MAX_CELLS = 100_000
SWEEPS = 500
CLOSE = 1e-5  # relative error of the margins at which raking stops
MET = 1e-3  # and that the worst margin may have
SWEEPS_IN_SPARK = 60
SEED = 17

PIECE = 1 << 20  # bytes of text that are hashed at a time
_ANY_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: a value of each byte; capital letters have those of small ones
_VALUES = np.array([(b + 32 if 65 <= b <= 90 else b) * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9 & (1 << 64) - 1 for b in range(256)], np.uint64)
_held: list[np.ndarray] = []

Targets = Mapping[str, Mapping[str, float]]


class UnmetTargets(ValueError):
    """Target shares that no probabilities up to 1 can give."""


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2^64."""
    if len(_held) < 2 or len(_held[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(max(n, PIECE + 1), base, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _held[:] = out
    return _held[0], _held[1]


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Whole words of the texts, with the numbers of the texts, about ``PIECE`` bytes at a time."""
    owner, held, size = [], [], 0
    for i, text in enumerate(texts):
        text = text or b""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:  # cut a long text at white space, as near behind the limit as there is
                space = _ANY_SPACE.search(text, at + PIECE)
                end = space.start() if space else end
            owner.append(i)
            held.append(text[at:end])
            size += end - at
            at = end
            if size >= PIECE:
                yield owner, held
                owner, held, size = [], [], 0
    if held:
        yield owner, held


def word_counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words by bucket of their hash, and the number of words, of UTF-8 texts.

    Words stand between ASCII white space; A-Z count as a-z.  All words of a piece are hashed at
    once: sums of their bytes' values times the powers of a base.
    """
    counts, sizes = np.zeros(len(texts) * BUCKETS, np.int64), np.zeros(len(texts), np.int64)
    for owner, held in _pieces(texts):
        buf = np.frombuffer(b" ".join(held) + b" ", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
        power, inverse = _powers(len(buf) + 1)
        inside = ~_SPACE[buf]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        start, stop = edge[::2], edge[1::2]
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_VALUES[buf] * inverse[: len(buf)], out=total[1:])
        bucket = ((total[stop] - total[start]) * power[stop] * _SPREAD >> np.uint64(55)).astype(np.int64)
        doc = np.array(owner)[np.searchsorted(ends, start, side="right")]
        counts += np.bincount(doc * BUCKETS + bucket, minlength=len(counts))
        sizes += np.bincount(doc, minlength=len(sizes))
    return counts.reshape(-1, BUCKETS), sizes


def _unit(counts: np.ndarray) -> np.ndarray:
    """Unit vectors of log counts, in half precision as they are staged; zero stays zero."""
    x = np.log1p(counts.astype(np.float32))
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype("<f2")


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x.astype(np.float32) @ centre.T).argmax(1).astype(np.int32)


def vectors(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, a hash of the text, its vector and its number of words, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                counts, sizes = word_counts(b.column(b.num_columns - 1).to_pylist())
                x = pa.array([r.tobytes() for r in _unit(counts)], pa.binary())
                yield pa.record_batch([*b.columns[:-1], x, pa.array(sizes)], names=[*keep, "h", "x", "n"])

    ship(docs.sparkSession)
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(*keep, F.xxhash64(text_col, F.lit(SEED)).alias("h"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(run, f"{fields}{', ' if keep else ''}h long, x binary, n long")


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f2").reshape(-1, BUCKETS)


def first_centroids(x: np.ndarray, topics: int) -> np.ndarray:
    """Centroids far from each other among ``x``: each next one is the farthest from those before."""
    picked = [int((x @ x.sum(0)).argmax())]
    near = x @ x[picked[0]]
    while len(picked) < min(topics, len(x)) and near.min() < 1 - 1e-6:
        picked.append(int(near.argmin()))
        near = np.maximum(near, x @ x[picked[-1]])
    return x[picked]


def fit_topics(held: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by spherical k-means over all documents; ``held``: their staged :func:`vectors`.

    A round is one pass over the vectors; a task gives the sum of each centroid's vectors, eight
    tasks add those up, and eight rows come to the driver whatever the input.
    """
    spark = held.sparkSession
    seeds = held.select("h", "x").dropDuplicates(["h"]).orderBy("h").limit(SEEDS).collect()
    start = _matrix([bytes(r["x"]) for r in seeds]).astype(np.float32)
    start = start[start.any(axis=1)]
    if not len(start):
        return np.zeros((1, BUCKETS), np.float32)
    centre = first_centroids(start, topics).astype(np.float32)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(centre.shape)
        for b in batches:
            for row in b.column(0):
                out += np.frombuffer(row.as_buffer()).reshape(out.shape)
        yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], names=["s"])

    for _ in range(rounds):
        now = spark.sparkContext.broadcast(centre)

        def sums(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            c = now.value
            out = np.zeros(c.shape)
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    x = _matrix(whole.slice(at, 1000).column(0).to_pylist())
                    out += (_nearest(x, c) == np.arange(len(c))[:, None]).astype(np.float32) @ x.astype(np.float32)
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], names=["s"])

        parts = held.select("x").mapInArrow(sums, "s binary").repartition(8).mapInArrow(total, "s binary").collect()
        moved = np.sum([np.frombuffer(r["s"]).reshape(centre.shape) for r in parts], axis=0)
        norm = np.linalg.norm(moved, axis=1, keepdims=True)
        fresh = np.where(norm > 0, moved / np.maximum(norm, 1e-12), centre).astype(np.float32)
        now.destroy()
        still = np.abs(fresh - centre).max() < 1e-4
        centre = fresh
        if still:
            break
    return centre


def topic_of(held: DataFrame, centre: np.ndarray) -> DataFrame:
    """Staged :func:`vectors` with the column ``topic``."""
    now = held.sparkSession.sparkContext.broadcast(centre)

    def assign(x: pa.Array) -> pa.Array:
        near = [_nearest(_matrix(x.slice(at, 1000).to_pylist()), now.value) for at in range(0, len(x), 1000)]
        return pa.array(np.concatenate([np.empty(0, np.int32), *near]))

    return held.withColumn("topic", F.arrow_udf(assign, "int")("x"))


def with_topics(docs: DataFrame, centre: np.ndarray, out: str, text_col: str) -> DataFrame:
    """``docs`` with the struct ``out``: topic and number of words of each whole text."""
    ship(docs.sparkSession)
    now = docs.sparkSession.sparkContext.broadcast(centre)

    def assign(texts: pa.Array) -> pa.Array:
        topic, size = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(texts), 500):
            counts, n = word_counts(texts.slice(at, 500).to_pylist())
            topic.append(_nearest(_unit(counts), now.value))
            size.append(n)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(topic)), pa.array(np.concatenate(size))], ["topic", "tokens"])

    return docs.withColumn(out, F.arrow_udf(assign, "topic int, tokens long")(F.col(text_col).cast("binary")))


def checked_targets(targets: Targets, margins: list[str]) -> None:
    """Refuse targets that no mix can have, whatever the data."""
    if set(targets) - set(margins):
        raise UnmetTargets(f"no margin is called {sorted(set(targets) - set(margins))}; they are {margins}")
    for m, given in targets.items():
        if any(not v >= 0 for v in given.values()) or sum(given.values()) > 1 + 1e-9:
            raise UnmetTargets(f"target shares of {m} must be at least 0 and at most 1 together: {dict(given)}")


def target_shares(observed: dict, given: Mapping[str, float], name: str = "") -> dict:
    """Shares of a margin's categories, which add up to 1.

    Given shares hold for the categories they name; the others divide what is left in
    proportion to what was observed.
    """
    absent = sorted(c for c, v in given.items() if v > 0 and not observed.get(c))
    if absent:
        raise UnmetTargets(f"{name}: no tokens of {absent}")
    left, other = 1 - sum(given.values()), sum(v for c, v in observed.items() if c not in given)
    if left > 1e-9 and not other:
        raise UnmetTargets(f"{name}: the shares of all categories add up to {1 - left:g}")
    return {c: given[c] if c in given else left * v / other if other else 0.0 for c, v in observed.items()}


def tempered(tokens: np.ndarray, keep: float) -> np.ndarray:
    """Tokens to keep of each cell: in proportion to a power of what it has, at most all, ``keep`` of all together."""
    raw, low, high = tokens**TEMPER, 0.0, float(tokens.max(initial=1.0)) ** (1 - TEMPER)
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(tokens, mid * raw).sum() < keep * tokens.sum() else (low, mid)
    return np.minimum(tokens, high * raw)


def rake(
    tokens: np.ndarray, codes: list[np.ndarray], wanted: list[np.ndarray], start: np.ndarray | None = None, sweeps: int = SWEEPS
) -> tuple[np.ndarray, float]:
    """Probabilities of the cells and the largest relative error of a margin.

    ``codes[m]`` numbers each cell's category in margin ``m``, ``wanted[m]`` is what each
    category's kept tokens should be.  A cell's probability is 1 or ``start`` (1 everywhere)
    times its categories' factors; each step solves one margin's factors exactly.
    """
    r, off = np.ones(len(tokens)) if start is None else start.astype(float), np.inf
    for _ in range(sweeps):
        for code, want in zip(codes, wanted):
            r = r * _factors(tokens, r, code, want)[code]
        off = max(_error(tokens, r, code, want) for code, want in zip(codes, wanted))
        if off < CLOSE:
            break
    return np.minimum(1, r), off


def _factors(tokens: np.ndarray, r: np.ndarray, code: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Per category the factor ``f`` with ``sum(tokens * min(1, r * f)) = want``, or of all its tokens."""
    f = np.ones(len(want))
    have = np.bincount(code, tokens * r, len(want))
    f = np.divide(want, have, out=f, where=have > 0)
    for _ in range(50):  # from below: what is over the bound is fixed, the rest makes up for it
        full = r * f[code] >= 1
        fixed, free = (np.bincount(code, x, len(want)) for x in (tokens * full, tokens * r * ~full))
        new = np.divide(want - fixed, free, out=f.copy(), where=free > 0)
        new = np.where((free > 0) & (new > f), new, f)
        if np.allclose(new, f, rtol=1e-12, atol=0):
            break
        f = new
    return f


def _error(tokens: np.ndarray, r: np.ndarray, code: np.ndarray, want: np.ndarray) -> float:
    have = np.bincount(code, tokens * np.minimum(1, r), len(want))
    return float(np.abs(np.divide(have, want, out=np.ones(len(want)), where=want > 0) - 1).max(initial=0))


def solve_cells(tokens: np.ndarray, names: Mapping[str, list], targets: Targets, keep: float, least_keep: float) -> np.ndarray:
    """The cells' probabilities; ``names[m]`` is each cell's category in margin ``m``."""
    total = float(tokens.sum())
    if not total:
        return np.ones(len(tokens))
    code, seen = {}, {}
    for m, values in names.items():
        observed: dict = {}
        for v, n in zip(values, tokens):
            observed[v] = observed.get(v, 0.0) + float(n)
        number = {c: i for i, c in enumerate(observed)}
        code[m], seen[m] = np.array([number[v] for v in values], int), observed

    def attempt(share: float) -> tuple[np.ndarray, float, list[str]]:
        want, beyond = {}, []
        for m, given in targets.items():
            shares = target_shares(seen[m], given, name=m)
            beyond += [f"{m} {c!r}: {v:.4g} wanted, {seen[m][c] / total / share:.4g} there" for c, v in shares.items() if v * share * total > seen[m][c] * (1 + 1e-9)]
            want[m] = np.array([shares[c] for c in seen[m]]) * share * total
        if beyond:
            return np.ones(len(tokens)), np.inf, beyond
        likely = tempered(tokens, share)
        if want:
            first = np.divide(likely, tokens, out=np.ones(len(tokens)), where=tokens > 0)
            p, off = rake(tokens, [code[m] for m in want], list(want.values()), first)
            if off > MET:
                return p, off, []
            likely = p * tokens
        wanted = [want[m] if m in want else np.bincount(code[m], likely, len(seen[m])) for m in seen]
        return *rake(tokens, list(code.values()), wanted), []

    p, off, _ = attempt(keep)
    if off > MET:
        p, off, beyond = attempt(least_keep)
        if off > MET:
            raise UnmetTargets(f"keeping {least_keep:g} of all tokens: {'; '.join(beyond) or f'margins are off by {off:.2g}'}")
        low, high = least_keep, keep
        for _ in range(12):  # the largest share that meets them
            mid = (low + high) / 2
            q, far, _ = attempt(mid)
            low, high, p = (mid, high, q) if far <= MET else (low, mid, p)
    p = p.copy()
    p[tokens == 0] = 1.0
    return p


def _cells_on_driver(cells: DataFrame, margins: list[str], targets: Targets, keep: float, least_keep: float) -> DataFrame:
    spark, rows = cells.sparkSession, sorted(cells.collect())
    names = {m: [r[m] for r in rows] for m in margins}
    p = solve_cells(np.array([r["tokens"] for r in rows], float), names, targets, keep, least_keep)
    fields = ", ".join(f"{m} string" for m in margins)
    return F.broadcast(spark.createDataFrame([(*(r[m] for m in margins), float(x)) for r, x in zip(rows, p)], f"{fields}, p double"))


def _cells_in_spark(cells: DataFrame, margins: list[str], targets: Targets, keep: float, least_keep: float) -> DataFrame:
    """The same raking with sums and joins by margin; categories come to the driver, cells do not.

    A margin's categories are few beside the cells, and their factors are what is solved for.
    """
    spark = cells.sparkSession
    seen = {m: {r[m]: float(r["o"]) for r in cells.groupBy(m).agg(F.sum("tokens").cast("double").alias("o")).collect()} for m in margins}
    total = sum(seen[margins[0]].values()) if margins else 0.0
    if not total:
        return cells.select(*margins, F.lit(1.0).alias("p"))

    def raked(rows: DataFrame, wanted: Targets) -> tuple[DataFrame, float]:
        """``rows`` with ``r`` from their own times factors by category that meet ``wanted``."""
        factor, off = {m: dict.fromkeys(seen[m], 1.0) for m in wanted}, np.inf
        for _ in range(SWEEPS_IN_SPARK):
            off = 0.0
            for m in wanted:
                got = _with_factors(rows, factor).groupBy(m).agg(
                    F.sum(F.when(F.col("r") >= 1, F.col("tokens")).otherwise(0)).cast("double").alias("fixed"),
                    F.sum(F.when(F.col("r") < 1, F.col("tokens") * F.col("r")).otherwise(0.0)).alias("free"),
                ).collect()
                for g in got:
                    want, have = wanted[m][g[m]], g["fixed"] + g["free"]
                    off = max(off, abs(have / want - 1) if want else 0.0)
                    room = (want - g["fixed"]) / g["free"] if g["free"] > 0 else 0.0
                    factor[m][g[m]] *= min(4.0, room) if room > 0.25 else max(0.25, want / have if have else 1.0)
            if off < CLOSE:
                break
        return staged(_with_factors(rows, factor), "raked_cells"), off

    def attempt(share: float) -> tuple[DataFrame, float]:
        want = {}
        for m, given in targets.items():
            shares = target_shares(seen[m], given, name=m)
            if any(v * share * total > seen[m][c] * (1 + 1e-9) for c, v in shares.items()):
                return cells, np.inf
            want[m] = {c: v * share * total for c, v in shares.items()}
        power = F.pow(F.col("tokens").cast("double"), F.lit(TEMPER))
        low, high = 0.0, float(cells.agg(F.max("tokens")).first()[0]) ** (1 - TEMPER)
        for _ in range(40):
            mid = (low + high) / 2
            kept = cells.agg(F.sum(F.least(F.col("tokens").cast("double"), mid * power))).first()[0]
            low, high = (mid, high) if kept < share * total else (low, mid)
        ratio = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), high * power / F.col("tokens"))).otherwise(1.0)
        likely = staged(cells.withColumn("r", ratio), "likely_cells")
        if want:
            likely, off = raked(likely, want)
            if off > MET:
                return likely, off
        for m in margins:
            if m not in want:
                sums = likely.groupBy(m).agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), "r")).alias("w")).collect()
                want[m] = {g[m]: float(g["w"]) for g in sums}
        return raked(cells.withColumn("r", F.lit(1.0)), want)

    done, off = attempt(keep)
    if off > MET:
        done, off = attempt(least_keep)
        if off > MET:
            raise UnmetTargets(f"keeping {least_keep:g} of all tokens, margins are off by {off:.2g}")
        low, high = least_keep, keep
        for _ in range(6):
            mid = (low + high) / 2
            other, far = attempt(mid)
            low, high, done = (mid, high, other) if far <= MET else (low, mid, done)
    return done.select(*margins, F.when(F.col("tokens") > 0, F.least(F.lit(1.0), "r")).otherwise(1.0).alias("p"))


def _with_factors(cells: DataFrame, factor: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``cells`` with ``r`` times their categories' factors."""
    spark, r = cells.sparkSession, F.col("r")
    for i, (m, by) in enumerate(factor.items()):
        table = spark.createDataFrame([(c, float(v)) for c, v in by.items()], f"{m} string, f{i} double")
        cells = cells.join(table, m)
        r = r * F.col(f"f{i}")
    return cells.withColumn("r", r).drop(*[f"f{i}" for i in range(len(factor))])


def mix(
    docs: DataFrame,
    targets: Targets | None = None,
    keep: float = KEEP,
    least_keep: float = LEAST_KEEP,
    source: str = "source",
    lang: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """``docs`` with the struct ``mix`` last: topic, tokens, probability, kept.

    ``targets``: per margin (``source``, ``lang``, ``topic``) the wanted token shares of
    categories, as text.  ``UnmetTargets`` if they name a category without tokens, add up to
    more than 1, or cannot be met by keeping ``least_keep`` of all tokens or more.
    """
    checked_targets(targets or {}, ["source", "lang", "topic"])
    out = free_name(docs, "mix")
    none = "\x00"  # stands for a null category
    text_of = lambda c: F.coalesce(c.cast("string"), F.lit(none))
    named = docs.select(text_of(F.col(source)).alias("source"), text_of(F.col(lang)).alias("lang"), F.col(text_col).alias("text"))
    held = staged(vectors(named, "text", ["source", "lang"]), "topic_vectors")
    centre = fit_topics(held)
    cells = topic_of(held, centre).withColumn("topic", F.col("topic").cast("string"))
    tagged = with_topics(docs, centre, out, text_col)
    parts = {"source": text_of(F.col(source)), "lang": text_of(F.col(lang)), "topic": F.col(out)["topic"].cast("string")}
    margins = list(parts)
    cells = cells.groupBy(*margins).agg(F.sum("n").alias("tokens"))
    cells = staged(cells, "cells")
    solve = _cells_on_driver if cells.count() <= max_cells else _cells_in_spark
    p = solve(cells, margins, targets or {}, keep, min(keep, least_keep))
    names = {m: free_name(tagged, f"{out}_{m}") for m in margins}
    p = p.select(*[F.col(m).alias(names[m]) for m in margins], F.col("p").alias(free_name(tagged, f"{out}_p")))
    # a vector on the line between two centroids may fall to the other side in the second pass
    chance = F.coalesce(F.col(p.columns[-1]), F.lit(keep))
    joined = tagged.withColumns({names[m]: c for m, c in parts.items()}).join(p, list(names.values()), "left")
    draw = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)
    mixed = F.col(out).withField("probability", chance).withField("kept", draw < chance)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], mixed.alias(out))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix keeps, with the columns of ``docs``."""
    mixed = mix(docs, **options)
    return mixed.where(F.col(mixed.columns[-1])["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
