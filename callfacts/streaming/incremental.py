"""The job's enrichment driven by newly landing date folders (Structured Streaming).

The batch job is run once per date by an outside scheduler.  The same
computation as a stream: a file source over the fact root picks up each new
``date=<d>/`` folder (and late files of old dates) exactly once, joins it to
the static dimension (stream-static inner join) and appends to a partitioned
file sink whose commit log makes the output exactly-once.  Progress lives in a
checkpoint in the shared folder, so a restarted driver resumes where it
stopped and lost executors only cost task retries.

``trigger="available_now"`` processes everything present and stops: a
catch-up/backfill run with the stream's bookkeeping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callfacts import schemas as S
from callfacts.operators.enrich import choose_strategy, client_side
from callfacts.plans.job import JoinOptions, enrich_calls, enrich_chats
from callfacts.sources.readers import read_table

KINDS = ("calls", "chats")
FILES_PER_DATE = 8


def fact_stream(
    spark: SparkSession,
    kind: str,
    root: str,
    *,
    max_files_per_trigger: int | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Streaming read of a fact root under the declared schema (+ ``date``)."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    schema = S.with_partition(S.CALL if kind == "calls" else S.CHAT_RAW)
    reader = spark.readStream.schema(schema)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if kind == "calls":
        return reader.option("header", "false").csv(root)
    return reader.json(root)


def run_available_now(query: StreamingQuery, timeout_s: float = 3600.0) -> None:
    """Wait for an available-now run to finish; stop it and fail past ``timeout_s``."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running after {timeout_s:.0f} s; stopped")
    if query.exception() is not None:
        raise query.exception()


def start(
    spark: SparkSession,
    *,
    kind: str,
    fact_root: str,
    target: str,
    checkpoint: str,
    dim_table: str = "dim_client",
    sink_format: str = "parquet",
    time_rule: str = "zone",
    join: JoinOptions = JoinOptions(),
    trigger: str = "available_now",
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
    timestamp_format: str | None = None,
    files_per_date: int = FILES_PER_DATE,
) -> StreamingQuery:
    """Start the incremental enrichment of one fact kind; returns the running query.

    The join strategy is decided once, from the measured dimension, when the
    query starts.  A query that stays (``processing_time``) therefore never
    broadcasts or hashes the dimension, which may grow meanwhile: it takes the
    sort-merge join.  ``split`` needs statistics of the whole input, which a
    stream never has: it is refused, and so is a session whose AQE would not
    split skewed keys.  The sink is partitioned by ``date``; a batch writes at most
    ``files_per_date`` files of a date, dealt by a hash of the fact's id, instead of one a task.
    """
    facts = fact_stream(
        spark, kind, fact_root, max_files_per_trigger=max_files_per_trigger, timestamp_format=timestamp_format
    )
    dim = read_table(spark, dim_table, S.CLIENT)
    how = choose_strategy(client_side(dim), join.strategy, join.broadcast_max_bytes, join.hash_partition_max_bytes)
    if how == "split":
        raise ValueError(
            "a stream cannot split hot keys: choose another join strategy, or turn on "
            "spark.sql.adaptive.enabled and spark.sql.adaptive.skewJoin.enabled"
        )
    if trigger == "processing_time" and how in ("broadcast", "hash"):
        how = "shuffle"
    fixed = join.fixed(how)
    if kind == "calls":
        out = enrich_calls(facts, dim, time_rule=time_rule, join=fixed, keep_partition=True)
    else:
        out = enrich_chats(facts, dim, join=fixed, keep_partition=True)
    deal = F.pmod(F.xxhash64("id"), F.lit(files_per_date))
    out = out.repartition(F.col(S.PARTITION_COLUMN), deal)
    writer = (
        out.writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(S.PARTITION_COLUMN)
    )
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger == "processing_time":
        writer = writer.trigger(processingTime=processing_time)
    else:
        raise ValueError("trigger is 'available_now' or 'processing_time'")
    return writer.start(target)
