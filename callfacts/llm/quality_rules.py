"""Quality rules as a short-circuit cascade (DataFrame expressions only).

``text_stats`` adds the statistics that rules read; ``cascade`` orders rules by
rejection per cost, both measured on a bounded sample, and evaluates them as one
``CASE WHEN`` chain, which stops at the first rule that rejects a row.  The
verdict does not depend on the order, only the cost does.

Defined results: a null text counts as empty; rows are judged one by one, so
repeated rows get equal verdicts; an empty table gives an empty result; a rule
that evaluates to null does not reject.  Other columns are kept and may have any
name: the statistics live in one struct column whose name is chosen free.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed values: the characters counted as symbols
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 500
SAMPLE_CHARS = 100_000
REPEATS = 20  # evaluations of a rule on each text of the sample, so its cost shows beside a job's own


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes a getter of columns (``text`` and the statistics) and gives a condition."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


def _count_of(text: Column, piece: str) -> Column:
    """How often a one-byte piece occurs: the bytes lost when it is removed."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(piece), F.lit("")))


BASE_RULES = (
    Rule("word_count", lambda c: c("n_words") < MIN_WORDS),
    Rule("repeated_windows", lambda c: 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words")),
)

#: The rules of the method, beside the base ones.  Each is judged against the words of the text.
RULES = (
    Rule("symbols", lambda c: 10 * c("n_symbols") > c("n_words")),
    Rule("exclamations", lambda c: 4 * _count_of(c("text"), "!") > c("n_words")),
    Rule("shouting", lambda c: 10 * F.regexp_count(c("text"), F.lit("[A-Z]")) > 4 * c("word_chars")),
    Rule("repeated_lines", lambda c: 10 * c("n_dup_lines") > 6 * F.size(F.split(c("text"), "\n"))),
    Rule("word_length", lambda c: (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def text_stats(df: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """``df`` with a struct column ``out`` of the statistics of each whole text.

    Three-word windows are compared by the 64-bit hash of their words.  They are
    sorted with their positions, equal neighbours are repeats, and each repeat
    covers its three words; the cost is n log n in the words of one text, with
    no shuffle and nothing gathered across rows.
    """
    t, w, g, p = (free_name(df, f"{out}_{x}") for x in ("t", "w", "g", "p"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn(t, text).withColumn(w, F.filter(F.split(F.col(t), WORD_BREAK), lambda x: x != ""))
    words, n = F.col(w), F.size(w)
    windows = F.transform(
        words, lambda x, i: F.struct(F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))
    )
    df = df.withColumn(
        g, F.when(n > 3, F.sort_array(F.slice(windows, F.lit(1), F.greatest(n - 2, F.lit(1))))).otherwise(F.slice(windows, 1, 0))
    )
    seen = F.col(g)
    repeats = F.filter(
        seen, lambda x, k: (F.get(seen, k - 1)["h"] == x["h"]) | (F.get(seen, k + 1)["h"] == x["h"])
    )
    df = df.withColumn(p, F.sort_array(F.transform(repeats, lambda x: x["i"])))
    at = F.col(p)
    covered = F.aggregate(
        F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = sum((_count_of(F.col(t), s) for s in SYMBOLS[1:]), _count_of(F.col(t), SYMBOLS[0]))
    stats = F.struct(
        F.col(t).alias("text"),
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    # explode of one element: a filter on the result is not pushed below it, where each use of a
    # column inside a lambda would be replaced by the expression that makes it
    return df.withColumn(out, F.explode(F.array(stats))).drop(t, w, g, p)


def measure(sample: DataFrame, stats: str, rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule over the sample; the faster of two runs counts."""
    get = lambda name: F.col(stats)[name]
    n = max(1, sample.count())
    found = []
    for rule in rules:
        hit, took = F.coalesce(rule.rejects(get), F.lit(False)), []
        for _ in range(2):
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(hit)).first()[0]
            took.append(time.perf_counter() - began)
        found.append((rule, min(took), rejected / n))
    return found


def order_rules(measured: Sequence[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, the best first; names break ties."""
    return [r for r, _, _ in sorted(measured, key=lambda x: (-x[2] / max(x[1], 1e-6), x[0].name))]


def cascade(df: DataFrame, stats: str, text_col: str, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> Column:
    """The name of the first rule that rejects a row, null if none does.

    Costs and selectivities are measured on at most ``sample_rows`` texts of up to
    ``SAMPLE_CHARS`` characters, every twentieth of the first partitions that give
    enough, so the whole table is not read for them.  They decide the order of
    evaluation and nothing else.
    """
    texts = df.select(F.col(text_col).alias("text")).where(F.char_length("text") <= SAMPLE_CHARS)
    rows = texts.sample(0.05, seed=11).limit(sample_rows).collect()
    sample = text_stats(df.sparkSession.createDataFrame(rows, "text string"), stats)
    sample = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))).persist()
    try:
        ordered = order_rules(measure(sample, stats, rules))
    finally:
        sample.unpersist()
    return chain(ordered, stats)


def chain(ordered: Sequence[Rule], stats: str) -> Column:
    get = lambda name: F.col(stats)[name]
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(F.coalesce(rule.rejects(get), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def judge(df: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with the struct ``quality``: the statistics, ``base_failed``, ``failed_rule`` and ``kept``.

    The struct takes a free name if ``df`` has a column ``quality``; it is the last column.
    """
    out = free_name(df, "quality")
    get = lambda name: F.col(out)[name]
    with_stats = text_stats(df, out, text_col)
    base = BASE_RULES[0].rejects(get) | BASE_RULES[1].rejects(get)
    failed = F.when(base, chain(BASE_RULES, out)).otherwise(cascade(df, out, text_col, rules, sample_rows))
    return with_stats.withColumn(
        out,
        F.col(out)
        .dropFields("text")
        .withField("base_failed", base)
        .withField("failed_rule", failed),
    ).withColumn(out, F.col(out).withField("kept", F.col(out)["failed_rule"].isNull()))


def keep_good(df: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with the columns of ``df``."""
    judged = judge(df, text_col, rules)
    return judged.where(F.col(judged.columns[-1])["kept"]).select(*[F.col(f"`{c}`") for c in df.columns])
