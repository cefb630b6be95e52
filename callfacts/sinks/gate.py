"""A gate inside the write: rules are counted while the rows pass, publish asks afterwards.

``Gate.watch`` adds counters to a plan (``DataFrame.observe``); the write that runs the plan
fills them, so checking costs no read of its own.  Nothing may become visible before
``require`` has passed, so the gate belongs to writes that publish later (staged, manifest).

A task that is run again may count its rows again: a count of zero is exact, others may be too
high, never too low.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callfacts.functions.rules import Rule
from callfacts.operators.checks import StrictInputError

ROWS = "rows"


class Gate:
    """Counts of the rows that pass and of each rule that they break."""

    def __init__(self, what: str, rules: Sequence[Rule], counts: Sequence[tuple[str, Column]] = ()):
        self.what, self.rules, self.counts = what, list(rules), list(counts)
        self.seen = Observation(f"gate-{what}-{uuid.uuid4().hex[:8]}")

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` with the counters on it."""
        found = [F.count(F.lit(1)).alias(ROWS)]
        found += [F.count_if(cond).alias(f"rule {i}") for i, (cond, _) in enumerate(self.rules)]
        found += [F.count_if(cond).alias(f"count {i}") for i, (_, cond) in enumerate(self.counts)]
        return df.observe(self.seen, *found)

    def report(self) -> dict[str, int]:
        """Rows, and rows by broken rule and by named count; only after the write has ended well."""
        got = self.seen.get
        named = {m: got.get(f"rule {i}") or 0 for i, (_, m) in enumerate(self.rules)}
        named |= {n: got.get(f"count {i}") or 0 for i, (n, _) in enumerate(self.counts)}
        return {ROWS: got.get(ROWS) or 0, **named}

    def require(self, most: float = 0.0) -> dict[str, int]:
        """Raise if more than the share ``most`` of the rows break a rule; the report otherwise."""
        report = self.report()
        broken = [f"{m} ({report[m]} of {report[ROWS]} rows)" for _, m in self.rules if report[m] > most * report[ROWS]]
        if broken:
            refused = StrictInputError(f"{self.what}: {'; '.join(broken)}; nothing was published")
            refused.report = report
            raise refused
        return report
