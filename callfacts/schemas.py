"""Declared schemas of the inputs and outputs, and the typed-table contract.

Readers always get a declared schema: no inference pass over the files, and
column types do not depend on what a sample of the data looks like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# -- records ---------------------------------------------------------------
# The field names of the records are fixed values: inputs and targets carry them.

CLIENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)

# One call; both times are Moscow wall time in the raw file.
CALL = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("clientId", T.StringType()),
        T.StructField("startAt", T.TimestampNTZType()),
        T.StructField("endAt", T.TimestampNTZType()),
    ]
)

# A chat message as it is stored: ``sendAt`` is text in a date pattern.
MESSAGE_RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("sendAt", T.StringType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("sendAt", T.TimestampNTZType()),
    ]
)

# One chat; times are UTC already.
CHAT_RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("clientId", T.StringType()),
        T.StructField("startAt", T.TimestampNTZType()),
        T.StructField("endAt", T.TimestampNTZType()),
        T.StructField("messages", T.ArrayType(MESSAGE_RAW)),
    ]
)

CHAT = T.StructType(CHAT_RAW.fields[:4] + [T.StructField("messages", T.ArrayType(MESSAGE))])

CLIENT_CALL = T.StructType(CALL.fields + [T.StructField("name", T.StringType())])

CLIENT_CHAT = T.StructType(CHAT.fields + [T.StructField("name", T.StringType())])

CLIENT_CHAT_MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("clientId", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("message_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("sendAt", T.TimestampNTZType()),
    ]
)

# Hive-style partition column of the fact folders (``name/date=<d>/``).
PARTITION_COLUMN = "date"
PARTITION_FIELD = T.StructField(PARTITION_COLUMN, T.DateType())


def with_partition(schema: T.StructType) -> T.StructType:
    """``schema`` plus the ``date`` partition column, so its type is declared too."""
    return T.StructType(schema.fields + [PARTITION_FIELD])


# -- contract --------------------------------------------------------------


class ContractError(ValueError):
    """A table lacks columns its declared record type needs."""


def conform(df: DataFrame, schema: T.StructType, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bind ``df`` to a record type: every field must exist, types may only widen.

    ``DataFrame.to`` reorders, drops extra columns and refuses narrowing casts
    (string -> bigint), but it would fill a *missing* nullable column with
    NULL; the name check in front of it turns that into an error instead.
    Columns named in ``keep`` (e.g. the partition column) stay at the end.
    """
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ContractError(f"missing columns {missing}; table has {df.columns}")
    extra = [df.schema[c] for c in keep if c in df.columns and c not in schema.fieldNames()]
    target = T.StructType(schema.fields + extra)
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    if all(_same_type(have[f.name.lower()], f.dataType) for f in target.fields):
        # already the right types: a plain projection, no per-element rebuild
        return df.select(*[df[f.name].alias(f.name) for f in target.fields])
    return df.to(target)


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal types, nullability ignored."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return len(a.fields) == len(b.fields) and all(
            x.name == y.name and _same_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)
        )
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _same_type(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return _same_type(a.keyType, b.keyType) and _same_type(a.valueType, b.valueType)
    return a == b
