"""All failed rules of a row, collected together (never stop at the first).

``violations`` builds one ARRAY<STRING> column: each rule contributes its
message when its condition is true; NULL conditions count as passed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from callfacts.functions.times import MESSAGE_DATE_PATTERN

# Fixed rule messages (our own wording).
KEY_MISSING = "clientId is missing"
KEY_NOT_NUMBER = "clientId is not a number"
START_MISSING = "startAt is missing"
END_MISSING = "endAt is missing"
END_BEFORE_START = "endAt is before startAt"
MESSAGE_DATE_UNREADABLE = "message date is unreadable"

Rule = tuple[Column, str]


def violations(rules: Iterable[Rule]) -> Column:
    flagged = [F.when(cond, F.lit(msg)) for cond, msg in rules]
    return F.filter(F.array(*flagged), lambda m: m.isNotNull())


def key_not_number(key: str = "clientId") -> Rule:
    k = F.col(key)
    return (k.isNotNull() & k.try_cast("bigint").isNull(), KEY_NOT_NUMBER)


def fact_rules(key: str = "clientId", start: str = "startAt", end: str = "endAt") -> list[Rule]:
    k = F.col(key)
    return [
        (k.isNull(), KEY_MISSING),
        key_not_number(key),
        (F.col(start).isNull(), START_MISSING),
        (F.col(end).isNull(), END_MISSING),
        (F.col(end) < F.col(start), END_BEFORE_START),
    ]


def unreadable_rules(corrupt: str, fields: Iterable[str]) -> list[Rule]:
    """Fields that are NULL in a record the reader could not read whole.

    ``corrupt`` is the reader's corrupt-record column: it holds the raw record
    when some field of it did not parse, and is NULL otherwise.
    """
    raw = F.col(corrupt)
    return [(raw.isNotNull() & F.col(f).isNull(), f"{f} is unreadable") for f in fields]


def message_rules(messages: str = "messages", field: str = "sendAt", pattern: str = MESSAGE_DATE_PATTERN) -> list[Rule]:
    """Rules over a raw (text-dated) message list."""
    unreadable = F.exists(
        F.col(messages),
        lambda m: m.getField(field).isNotNull() & F.try_to_date(m.getField(field), pattern).isNull(),
    )
    return [(unreadable, MESSAGE_DATE_UNREADABLE)]
