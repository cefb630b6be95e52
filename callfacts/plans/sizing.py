"""Proven size bounds for broadcast decisions.

A side is broadcast only after its size was *measured*: one aggregate action
(partial counts per task, tiny shuffles) gives the exact row count, the bytes
of its rows in Spark's row format and, per hash partition of the join's
shuffle, the bytes one task would have to hold.  When the side is cached, the same
action also fills the cache, so the scan is not wasted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default ceiling for a broadcast side.  The driver collects it and every
# executor holds a hashed copy, so it must stay small whatever the data grows to.
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_VARIABLE = (T.StringType, T.BinaryType)


def _padded(n: Column) -> Column:
    return ((n + F.lit(7)) / F.lit(8)).cast("long") * F.lit(8)


def row_bytes(schema: T.StructType) -> Column:
    """Size of one row in Spark's binary row layout: a null bitset word per
    64 fields, 8 bytes per field, plus variable data padded to 8 bytes.
    Nested values are counted by their JSON text length (an upper-ish bound)."""
    fixed = 8 * ((len(schema.fields) + 63) // 64) + 8 * len(schema.fields)
    total: Column = F.lit(fixed).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _VARIABLE):
            total = total + F.coalesce(_padded(F.octet_length(c)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(_padded(F.octet_length(F.to_json(c))), F.lit(0))
    return total


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int
    max_partition_bytes: int = 0  # largest share of one hash partition (0: not measured)


def measure(df: DataFrame, key: str | None = None, partitions: int | None = None) -> Size:
    """Exact rows and bytes of ``df``; with ``key`` and ``partitions`` also the
    bytes of its largest hash partition on ``key``.

    The partition id is computed with the function a shuffle on ``key`` uses
    (Murmur3 ``hash`` modulo the partition count), so the maximum is what the
    biggest partition of that shuffle will hold -- duplicate or hot keys
    included.  Rows with a NULL key are left out: an inner join drops them
    before it shuffles or broadcasts.  One action either way; the grouped form
    aggregates to at most ``partitions`` rows before its tiny shuffles.

    Nothing is remembered between calls: a file may be rewritten in place.
    """
    size = row_bytes(df.schema)
    if key is None or not partitions:
        r = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
        return Size(int(r["rows"]), int(r["bytes"] or 0))
    part = F.pmod(F.hash(F.col(key)), F.lit(partitions))
    keyed = df.where(F.col(key).isNotNull())
    per = keyed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    r = per.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("top")).first()
    return Size(int(r["rows"] or 0), int(r["bytes"] or 0), int(r["top"] or 0))


_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def parse_bytes(text: str) -> int:
    """Spark's size strings: ``67108864b``, ``64m``, ``64MB``, ``1g`` ..."""
    m = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower())
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]
