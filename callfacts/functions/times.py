"""Time expressions.  All inputs and outputs are TIMESTAMP_NTZ holding wall or
UTC time, so no result depends on ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values that the results depend on:
# the zone of the call facts' wall times ("MSK" in the source is not a valid
# region id; the region with the same rules is used), the flat offset of the
# simplified variant, and the text pattern of chat message dates.
SOURCE_ZONE = "Europe/Moscow"
FIXED_OFFSET_HOURS = -3
MESSAGE_DATE_PATTERN = "MM/dd/yyyy"


REPEATED = ("earlier", "later", "null")


def repeat_lengths(zone: str) -> list[int]:
    """By how many seconds clocks of the zone have ever been, or will be, put back; from the zone's own rules."""
    rules = SparkSession.getActiveSession()._jvm.java.time.ZoneId.of(zone).getRules()
    steps = [(t.getOffsetBefore(), t.getOffsetAfter()) for t in [*rules.getTransitions(), *rules.getTransitionRules()]]
    return sorted({a.getTotalSeconds() - b.getTotalSeconds() for a, b in steps if a.getTotalSeconds() > b.getTotalSeconds()})


def later_utc(ts: Column | str, zone: str = SOURCE_ZONE) -> Column:
    """The second UTC time of a wall time that clocks show twice; NULL for any other.

    The first one, put off by a length that the zone's clocks were once put back by, shows the
    same wall time only within a repeated hour.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
    put_off = [first + F.make_dt_interval(secs=F.lit(s)) for s in repeat_lengths(zone)]
    shown = [F.when(F.convert_timezone(F.lit("UTC"), F.lit(zone), u) == c, u) for u in put_off]
    return F.coalesce(*shown, F.lit(None).cast("timestamp_ntz"))


def skipped(ts: Column | str, zone: str = SOURCE_ZONE) -> Column:
    """Whether clocks of the zone never show this wall time, since they were put forward over it."""
    c = F.col(ts) if isinstance(ts, str) else ts
    there = F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), there) != c


def wall_to_utc(ts: Column | str, zone: str = SOURCE_ZONE, repeated: str = "earlier") -> Column:
    """Wall time in ``zone`` -> UTC, by the zone's rules (offset changes, DST).

    ``convert_timezone`` on NTZ input is exact and independent of the session
    zone, unlike ``to_utc_timestamp`` which goes through a session-zone
    TIMESTAMP.  A wall time that clocks show twice is the ``earlier`` or the ``later`` one, or
    ``null``; one that they skip moves on by the length of the gap (see ``skipped``).
    """
    if repeated not in REPEATED:
        raise ValueError(f"repeated is one of {REPEATED}")
    c = F.col(ts) if isinstance(ts, str) else ts
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
    if repeated == "later":
        return F.coalesce(later_utc(c, zone), first)
    return F.when(later_utc(c, zone).isNull(), first) if repeated == "null" else first


def shift_hours(ts: Column | str, hours: int = FIXED_OFFSET_HOURS) -> Column:
    """Add a fixed number of hours; a plain interval add, codegen'd, no lambda."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c + F.make_dt_interval(hours=F.lit(hours))


def instant(utc: Column | str) -> Column:
    """UTC wall time -> the instant (TIMESTAMP), whatever the session's zone.

    A cast would read the wall time in the session's zone, and lose the hour that its clocks
    skip; the parts of the wall time are counted up from 1970 instead.
    """
    c = F.col(utc) if isinstance(utc, str) else utc
    day = F.unix_date(c.cast("date")).cast("long") * 86_400
    seconds = day + F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long"))


def parse_date_text(text: Column | str, pattern: str = MESSAGE_DATE_PATTERN, *, strict: bool = False) -> Column:
    """Date text -> TIMESTAMP_NTZ at midnight.

    Tolerant (default): unreadable text gives NULL under ANSI on and off.
    Strict: unreadable non-NULL text fails the query, also under ANSI off.
    """
    c = F.col(text) if isinstance(text, str) else text
    parsed = F.try_to_date(c, pattern).cast("timestamp_ntz")
    if not strict:
        return parsed
    bad = c.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"date text not in pattern {pattern}: "), c))).otherwise(parsed)


def add_seconds(ts: Column | str, seconds: Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return c + F.make_dt_interval(secs=seconds)
