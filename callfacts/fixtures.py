"""Bindings of the driver's tables to the call-center inputs (see FIXTURES.md).

The job's inputs are a client dimension (catalog table), CSV call facts and
JSON chat facts in date folders.  No such data ships with the original job, so
they are derived by Spark from the given tables:

* clients  <- ``customer``      (id = c_custkey, name = c_name)
* calls    <- ``events``        (every row; times read as Moscow wall time)
* chats    <- ``conversations`` (one chat per conversation, turns as messages)
* lines    <- ``documents.text`` written as text

Folders are written once per process below the shared scratch folder and
reused by every query of that process.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callfacts import scratch
from callfacts.functions.times import MESSAGE_DATE_PATTERN, add_seconds
from callfacts.sources.readers import TIMESTAMP_NTZ_FORMAT

DIM_TABLE = "dim_client"

# Fixed values of the chat binding: chats start on this day (plus conv_id
# minutes), message n is dated this day + n days, chats spread over 7 dates.
# A chat record holds at most CHAT_TURNS consecutive turns of a conversation
# (block b of conversation c is chat c * CHAT_ID_STRIDE + b, so no two chats
# share an id), and every collected message list is bounded whatever one
# conversation holds.
CHAT_EPOCH = "2024-01-01"
CHAT_DATES = 7
CHAT_TURNS = 64
CHAT_ID_STRIDE = 1_000_000

# Dirty-key binding: by event_id % 5 the key becomes
# 0 -> 'x' || key, 1 -> '0' || key, 2 -> ' ' || key || ' ', 3 -> NULL, 4 -> key.
# Dirty-time binding: by event_id % 7 startAt is NULL (4), endAt is NULL (5) or
# endAt is an hour before startAt (6).
# ISO binding: by event_id % 3 both times are written with a space (0), with a T
# (1), or with a T and a fraction (2); by event_id % 11 = 10 startAt names a
# zone, which no fact may.
# Dirty-date binding: message n with n % 4 = 3 gets month 13 ('13/' || its day/year).


# Declared schemas of the driver tables' columns used here (FIXTURES.md §4):
# reading with them skips the schema-inference job of every read.
TABLE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "conversations": "conv_id BIGINT, turn BIGINT, text STRING",
    "documents": "doc_id BIGINT, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clients_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def register_clients(spark: SparkSession, sf_dir: str, name: str = DIM_TABLE) -> str:
    """Expose the clients as the catalog table the job reads (a temp view)."""
    clients_frame(spark, sf_dir).createOrReplaceTempView(name)
    return name


def calls_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call facts with their ``date`` partition value (Moscow wall-time date)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("clientId"),
        F.col("ts").alias("startAt"),
        add_seconds("ts", F.floor("value")).alias("endAt"),
        F.to_date("ts").alias("date"),
    )


def dirty_calls_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = calls_frame(spark, sf_dir)
    k, r = F.col("clientId"), F.pmod(F.col("id"), F.lit(5))
    dirty = (
        F.when(r == 0, F.concat(F.lit("x"), k))
        .when(r == 1, F.concat(F.lit("0"), k))
        .when(r == 2, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(r == 3, F.lit(None).cast("string"))
        .otherwise(k)
    )
    t = F.pmod(F.col("id"), F.lit(7))
    return (
        calls.withColumn("clientId", dirty)
        .withColumn("endAt", F.when(t == 6, add_seconds("startAt", F.lit(-3600))).when(t != 5, F.col("endAt")))
        .withColumn("startAt", F.when(t != 4, F.col("startAt")))
    )


def iso_call_folder(spark: SparkSession, sf_dir: str) -> str:
    """Call facts whose times are ISO text of several forms, some of them unreadable."""

    def form(c):
        n = F.pmod(F.col("id"), F.lit(3))
        text = F.when(n == 0, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).when(n == 1, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
        return text.otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"))

    def write(path: str) -> None:
        calls = calls_frame(spark, sf_dir)
        zoned = F.pmod(F.col("id"), F.lit(11)) == 10
        start = F.concat(form(F.col("startAt")), F.when(zoned, F.lit("Z")).otherwise(F.lit("")))
        calls.select("id", "clientId", start.alias("startAt"), form(F.col("endAt")).alias("endAt"), "date").write.partitionBy(
            "date"
        ).csv(path)

    return _materialize(spark, sf_dir, "fact_call_iso", write)


def chats_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw chats: up to ``CHAT_TURNS`` consecutive turns of a conversation per
    chat, as a sorted message list (the record's own shape: one JSON line per
    chat).  The grouping is a partial-aggregated shuffle on (conversation,
    block), and no group exceeds ``CHAT_TURNS`` messages.
    """
    conv = table(spark, sf_dir, "conversations")
    epoch_day = F.lit(CHAT_EPOCH).cast("date")
    epoch = epoch_day.cast("timestamp_ntz")
    message = F.struct(
        F.col("turn").alias("id"),
        F.col("text").alias("text"),
        F.date_format(F.date_add(epoch_day, F.col("turn").cast("int")), MESSAGE_DATE_PATTERN).alias("sendAt"),
    )
    block = F.floor(F.col("turn") / F.lit(CHAT_TURNS)).alias("block")
    grouped = conv.groupBy("conv_id", block).agg(F.array_sort(F.collect_list(message)).alias("messages"))
    start = add_seconds(epoch, 60 * (F.col("conv_id") + F.col("block") * F.lit(CHAT_TURNS)))
    return grouped.select(
        (F.col("conv_id") * F.lit(CHAT_ID_STRIDE) + F.col("block")).alias("id"),
        F.col("conv_id").cast("string").alias("clientId"),
        start.alias("startAt"),
        add_seconds(start, 60 * F.size("messages")).alias("endAt"),
        "messages",
        F.date_add(epoch_day, F.pmod(F.col("conv_id"), F.lit(CHAT_DATES)).cast("int")).alias("date"),
    )


def dirty_chats_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats where every fourth message date is unreadable (month 13)."""

    def spoil(m):
        sent = m.getField("sendAt")
        bad = F.concat(F.lit("13"), F.substring(sent, 3, 8))
        return m.withField("sendAt", F.when(m.getField("id") % 4 == 3, bad).otherwise(sent))

    return chats_frame(spark, sf_dir).withColumn("messages", F.transform("messages", spoil))


_written: dict[tuple[str, str, str], str] = {}


def _materialize(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    key = (scratch.shared_root(spark), os.path.abspath(sf_dir), kind)
    if key not in _written:
        path = scratch.fresh_folder(spark, "fixtures", kind)
        write(path)
        _written[key] = path
    return _written[key]


def call_folder(spark: SparkSession, sf_dir: str) -> str:
    """``fact_call/date=<d>/*.csv``: header-less CSV, Moscow wall times."""

    def write(path: str) -> None:
        (
            calls_frame(spark, sf_dir)
            .write.partitionBy("date")
            .option("header", "false")
            .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
            .csv(path)
        )

    return _materialize(spark, sf_dir, "fact_call", write)


def chat_folder(spark: SparkSession, sf_dir: str) -> str:
    """``fact_chat/date=<d>/*.json``: one chat per line, message dates as text."""

    def write(path: str) -> None:
        (
            chats_frame(spark, sf_dir)
            .write.partitionBy("date")
            .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
            .json(path)
        )

    return _materialize(spark, sf_dir, "fact_chat", write)


def dirty_call_folder(spark: SparkSession, sf_dir: str) -> str:
    """Dirty calls as they stand in a file, spaces in the key included; an empty cell is NULL."""

    def write(path: str) -> None:
        cell = lambda c: F.coalesce(F.date_format(c, TIMESTAMP_NTZ_FORMAT), F.lit(""))
        line = F.concat_ws(",", "id", F.coalesce("clientId", F.lit("")), cell("startAt"), cell("endAt"))
        dirty_calls_frame(spark, sf_dir).select(line.alias("value"), "date").write.partitionBy("date").text(path)

    return _materialize(spark, sf_dir, "fact_call_dirty", write)


#: The binding of late files: calls and chats with id % LATE = 0 land after the first run.
LATE = 5


def land(spark: SparkSession, sf_dir: str, calls_root: str, chats_root: str, late: bool) -> None:
    """Write the early or the late facts below two roots of the caller's."""
    some = (F.pmod(F.col("id"), F.lit(LATE)) == 0) if late else (F.pmod(F.col("id"), F.lit(LATE)) != 0)
    calls, chats = (f(spark, sf_dir).where(some) for f in (calls_frame, chats_frame))
    form = dict(timestampNTZFormat=TIMESTAMP_NTZ_FORMAT)
    calls.write.mode("append").partitionBy("date").options(**form).csv(calls_root)
    chats.write.mode("append").partitionBy("date").options(**form).json(chats_root)


def dirty_chat_folder(spark: SparkSession, sf_dir: str) -> str:
    """Chats with unreadable message dates, their times written with a T and no fraction."""

    def write(path: str) -> None:
        writer = dirty_chats_frame(spark, sf_dir).write.partitionBy("date")
        writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)

    return _materialize(spark, sf_dir, "fact_chat_dirty", write)


def struct_chat_folder(spark: SparkSession, sf_dir: str) -> str:
    """One chat per message: ``messages`` is one object, not a list."""

    def write(path: str) -> None:
        one = dirty_chats_frame(spark, sf_dir).withColumn("messages", F.explode("messages"))
        one.write.partitionBy("date").json(path)

    return _materialize(spark, sf_dir, "fact_chat_struct", write)


def text_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        table(spark, sf_dir, "documents").select("text").write.text(path)

    return _materialize(spark, sf_dir, "lines", write)
