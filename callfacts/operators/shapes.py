"""Result shapes (P8-P10): explicit projections, never ``select *`` of a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import schemas as S


def client_calls(df: DataFrame) -> DataFrame:
    """Call fields + client name; ``id`` is the call id."""
    return S.conform(df, S.CLIENT_CALL)


def client_chats(df: DataFrame) -> DataFrame:
    """Chat fields, the (parsed) message list and the client name."""
    return S.conform(df, S.CLIENT_CHAT)


def chat_messages(
    df: DataFrame, *, keep_empty: bool = False, send_at: Callable[[Column], Column] | None = None
) -> DataFrame:
    """P10: one row per message.

    ``explode`` drops chats whose list is empty or NULL; ``keep_empty=True``
    keeps them as one row with NULL message fields (``explode_outer``).

    ``send_at`` is applied to each exploded ``sendAt`` value.  Parsing after
    the explode is one scalar expression per row; parsing the list before it
    would be evaluated twice, because Spark infers a non-empty-list filter for
    ``explode`` and pushes it below the list rewrite.
    """
    explode = F.explode_outer if keep_empty else F.explode
    m = F.col("m")
    sent = m.getField("sendAt")
    return df.select("id", "clientId", "name", explode("messages").alias("m")).select(
        "id",
        "clientId",
        "name",
        m.getField("id").alias("message_id"),
        m.getField("text").alias("text"),
        (send_at(sent) if send_at else sent).alias("sendAt"),
    )


def as_message_list(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Chats whose ``messages`` are one object each, as lists of that one message."""
    if not isinstance(df.schema[messages].dataType, T.StructType):
        return df
    m = F.col(messages)
    return df.withColumn(messages, F.when(m.isNotNull(), F.array(m)))
