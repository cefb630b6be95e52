"""Column expressions (built-in Spark functions only; no UDFs)."""

from callfacts.functions.keys import numeric_key
from callfacts.functions.rules import fact_rules, message_rules, violations
from callfacts.functions.times import (
    FIXED_OFFSET_HOURS,
    MESSAGE_DATE_PATTERN,
    SOURCE_ZONE,
    add_seconds,
    instant,
    later_utc,
    parse_date_text,
    shift_hours,
    skipped,
    wall_to_utc,
)

__all__ = [
    "FIXED_OFFSET_HOURS",
    "MESSAGE_DATE_PATTERN",
    "SOURCE_ZONE",
    "add_seconds",
    "fact_rules",
    "instant",
    "later_utc",
    "message_rules",
    "numeric_key",
    "parse_date_text",
    "shift_hours",
    "skipped",
    "violations",
    "wall_to_utc",
]
