"""Normalizing operators: times to UTC, nested field rewrite, message dates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts.functions.times import (
    FIXED_OFFSET_HOURS,
    MESSAGE_DATE_PATTERN,
    SOURCE_ZONE,
    instant,
    parse_date_text,
    shift_hours,
    wall_to_utc,
)

TIME_COLUMNS = ("startAt", "endAt")


def to_utc(
    df: DataFrame,
    *,
    rule: str = "zone",
    zone: str = SOURCE_ZONE,
    offset_hours: int = FIXED_OFFSET_HOURS,
    columns: Sequence[str] = TIME_COLUMNS,
    repeated: str = "earlier",
) -> DataFrame:
    """Replace wall-time columns by UTC.

    ``rule="zone"``  -- by the zone's rules (P2, the default);
    ``rule="fixed"`` -- a flat ``offset_hours`` (P3).  The two agree on 2024
    data but not where the zone had another offset (Moscow before 2014-10-26).
    ``repeated`` says which UTC time a wall time has that the zone's clocks show twice.
    """
    if rule == "zone":
        exprs = {c: wall_to_utc(c, zone, repeated) for c in columns}
    elif rule == "fixed":
        exprs = {c: shift_hours(c, offset_hours) for c in columns}
    else:
        raise ValueError(f"unknown time rule {rule!r}; use 'zone' or 'fixed'")
    return df.withColumns(exprs)


def rewrite_nested(df: DataFrame, column: str, field: str, fn: Callable[[Column], Column]) -> DataFrame:
    """Replace ``column.field`` by ``fn(column.field)``.

    Works on a struct column (``withField``) and on a list of structs
    (``transform`` + ``withField`` per element).  A NULL list stays NULL and
    an empty list stays empty; field order is kept.
    """
    dtype = df.schema[column].dataType
    col = F.col(column)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        new = F.transform(col, lambda m: m.withField(field, fn(m.getField(field))))
    elif isinstance(dtype, T.StructType):
        new = col.withField(field, fn(col.getField(field)))
    else:
        raise TypeError(f"{column} is {dtype.simpleString()}, not a struct or a list of structs")
    return df.withColumn(column, new)


def parse_message_times(
    df: DataFrame,
    *,
    column: str = "messages",
    field: str = "sendAt",
    pattern: str = MESSAGE_DATE_PATTERN,
    strict: bool = False,
) -> DataFrame:
    """Message date text -> TIMESTAMP_NTZ inside the nested messages."""
    return rewrite_nested(df, column, field, lambda c: parse_date_text(c, pattern, strict=strict))


def to_instants(df: DataFrame) -> DataFrame:
    """Every UTC wall time (TIMESTAMP_NTZ) of the columns and of message lists as an instant (TIMESTAMP)."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, instant(f"`{f.name}`"))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            row = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
            for g in row.fields if isinstance(row, T.StructType) else ():
                if isinstance(g.dataType, T.TimestampNTZType):
                    df = rewrite_nested(df, f.name, g.name, instant)
    return df
