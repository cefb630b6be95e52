"""The batch job (B1): one date (or several) of call and chat facts -> two staging tables.

read dimension (catalog) + calls (CSV) + chats (JSON) under declared schemas
-> calls to UTC, message dates parsed -> inner join to the client dimension
-> ClientCall / ClientChat -> write calls, then chats.

The fact folders are resolved before anything is written, so a missing date
fails with the targets untouched.  A dimension too large to broadcast is cached
for both joins and always released.  The join strategy is chosen once, from the measured
dimension, and used for both joins.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callfacts import schemas as S
from callfacts.operators.enrich import (
    DEFAULT_HASH_PARTITION_MAX_BYTES,
    DEFAULT_HOT_KEY_ROWS,
    choose_strategy,
    client_side,
    join_client,
)
from callfacts.operators.normalize import parse_message_times, to_instants, to_utc
from callfacts.functions.rules import key_not_number, message_rules, unreadable_rules
from callfacts.functions.times import parse_date_text
from callfacts.operators.checks import require_none
from callfacts.operators.shapes import as_message_list, chat_messages
from callfacts.plans.cache import cached
from callfacts.plans.sizing import DEFAULT_BROADCAST_MAX_BYTES
from callfacts.sinks.publish import publish_staged
from callfacts.sinks.writer import SelfOverwriteError, overlap, qualified, table_location, table_name, write_table
from callfacts.sources.readers import Partition, read_calls_csv, read_chats_json, read_table, require_files


@dataclass(frozen=True)
class JoinOptions:
    strategy: str = "auto"
    strict: bool = False
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS
    hash_partition_max_bytes: int = DEFAULT_HASH_PARTITION_MAX_BYTES

    def kwargs(self) -> dict:
        return dict(
            strategy=self.strategy,
            strict=self.strict,
            broadcast_max_bytes=self.broadcast_max_bytes,
            hot_key_rows=self.hot_key_rows,
            hash_partition_max_bytes=self.hash_partition_max_bytes,
        )

    def fixed(self, strategy: str) -> JoinOptions:
        """The same options with a decided strategy."""
        return dataclasses.replace(self, strategy=strategy)


# The reader's column for records it could not read whole.
CORRUPT = "_corrupt_fact"


def _require_apart(
    spark: SparkSession, calls_table: str, chats_table: str, dim_table: str, fact_roots: Sequence[str], catalog: bool
) -> None:
    """Refuse targets that are one another, the dimension or a fact folder, before anything is written.

    Names are resolved by the catalog, so ``t`` and ``default.t`` are one table; tables under
    different names are told apart by the folders that hold their files.
    """
    held = [x for x in [table_location(spark, dim_table)] if x]
    if not held:  # a view: the folders of the files it reads
        held = sorted({f.rsplit("/", 1)[0] for f in spark.table(dim_table).inputFiles()})
    dims, facts = ([qualified(spark, x) for x in xs] for xs in (held, fact_roots))
    if catalog:
        names = [table_name(spark, n) for n in (calls_table, chats_table, dim_table)]
        if len(set(names)) < 3:
            raise SelfOverwriteError(f"the targets and the dimension must be three tables, not {names}")
        at = [qualified(spark, x) if x else None for x in (table_location(spark, t) for t in (calls_table, chats_table))]
    else:
        at = [qualified(spark, t) for t in (calls_table, chats_table)]
    if all(at) and overlap(*at):
        raise SelfOverwriteError(f"the two targets overlap: {at[0]} and {at[1]}")
    for t in filter(None, at):
        for what, folders in (("the dimension is", dims), ("the facts are", facts)):
            for f in folders:
                if overlap(f, t):
                    raise SelfOverwriteError(f"refusing to write to {t}: {what} read from {f}")


def _shape(df: DataFrame, schema, keep_partition: bool) -> DataFrame:
    keep = (S.PARTITION_COLUMN,) if keep_partition else ()
    return S.conform(df, schema, keep=keep)


def enrich_calls(
    calls: DataFrame,
    dim: DataFrame,
    *,
    time_rule: str = "zone",
    join: JoinOptions = JoinOptions(),
    keep_partition: bool = False,
) -> DataFrame:
    """Raw (Moscow wall time) calls -> ClientCall rows, times in UTC.

    Times are converted after the join, so calls the inner join drops are
    never converted."""
    joined = join_client(calls, dim, **join.kwargs())
    return _shape(to_utc(joined, rule=time_rule), S.CLIENT_CALL, keep_partition)


def enrich_chats(
    chats: DataFrame,
    dim: DataFrame,
    *,
    join: JoinOptions = JoinOptions(),
    strict_dates: bool = False,
    keep_partition: bool = False,
) -> DataFrame:
    """Raw chats (text message dates) -> ClientChat rows.

    The message list is rewritten after the join: only matched chats are
    parsed, and scan, filter and join stay one generated-code stage (the list
    rewrite is a higher-order function, which Spark evaluates interpreted).
    """
    joined = join_client(chats, dim, **join.kwargs())
    return _shape(parse_message_times(joined, strict=strict_dates), S.CLIENT_CHAT, keep_partition)


def enrich_chat_messages(
    chats: DataFrame,
    dim: DataFrame,
    *,
    join: JoinOptions = JoinOptions(),
    strict_dates: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """Raw chats -> one ClientChatMessage row per message (dates parsed per row)."""
    joined = join_client(chats, dim, **join.kwargs())
    return chat_messages(joined, keep_empty=keep_empty, send_at=lambda c: parse_date_text(c, strict=strict_dates))


@dataclass(frozen=True)
class JobResult:
    calls_table: str
    chats_table: str
    join_strategy: str


def run(
    spark: SparkSession,
    *,
    partition: Partition,
    calls_table: str,
    chats_table: str,
    calls_root: str,
    chats_root: str,
    dim_table: str = "dim_client",
    sink_format: str = "parquet",
    sink_options: Mapping[str, str] | None = None,
    target_option: str | None = None,
    catalog: bool = False,
    mode: str = "overwrite",
    partition_overwrite: str | None = None,
    time_rule: str = "zone",
    join: JoinOptions = JoinOptions(),
    strict_dates: bool = False,
    publish: str = "overwrite",
    staging_root: str | None = None,
    timestamp_format: str | None = None,
    chat_schema: T.StructType = S.CHAT_RAW,
    allow_empty: bool = False,
    instants: bool = False,
) -> JobResult:
    """Run the job for ``partition`` (a date, a list of dates, or None = all).

    Keyword-only on purpose: the calls and chats targets can never be swapped
    by position.  With ``publish="overwrite"`` the writes happen in order
    calls, then chats; each write is atomic on its own, the pair is not.  With
    ``publish="staged"`` (catalog targets, whole-table) both outputs are
    written below ``staging_root`` first and the two tables are repointed only
    after both writes succeeded.

    Times are read by the ISO rules or by ``timestamp_format``; chats whose
    ``messages`` are one object each are read with a ``chat_schema`` that says
    so, and come out with a list of one message.  Times are written as UTC wall times, or with
    ``instants`` as instants.  With a strict mode a record
    that cannot be read whole fails the job before any write.  A requested
    date without a record fails too, unless ``allow_empty``.
    """
    if publish not in ("overwrite", "staged"):
        raise ValueError("publish is 'overwrite' or 'staged'")
    if publish == "staged" and not (catalog and staging_root and partition_overwrite is None and mode == "overwrite"):
        raise ValueError("staged publish needs catalog targets, a staging_root and whole-table overwrite")
    dim = read_table(spark, dim_table, S.CLIENT)
    _require_apart(spark, calls_table, chats_table, dim_table, [calls_root, chats_root], catalog)
    read = dict(timestamp_format=timestamp_format, corrupt_column=CORRUPT)  # pruned where no rule asks for it
    calls = read_calls_csv(spark, calls_root, partition, **read)  # fails here if a date is missing
    chats = as_message_list(read_chats_json(spark, chats_root, partition, schema=chat_schema, **read))
    if not allow_empty:
        require_files(calls, calls_root, partition)  # ... or holds no record
        require_files(chats, chats_root, partition)
    # Strict modes are checked before any write: an overwrite removes the old
    # target when it starts, so a failure inside it would leave nothing.
    # One pass per fact over all rules.
    keys = [key_not_number()] if join.strict else []
    if join.strict or strict_dates:
        times = ["startAt", "endAt"]
        require_none(calls, keys + unreadable_rules(CORRUPT, times), what="calls", show="clientId")
        dates = message_rules() if strict_dates else []
        require_none(chats, keys + dates + unreadable_rules(CORRUPT, [*times, "messages"]), what="chats", show="clientId")
    calls, chats = calls.drop(CORRUPT), chats.drop(CORRUPT)
    keep = partition_overwrite is not None
    sink = dict(
        fmt=sink_format,
        mode=mode,
        options=sink_options,
        target_option=target_option,
        catalog=catalog,
        partition_overwrite=partition_overwrite,
        read_roots=[calls_root, chats_root],  # compare folders, not every input file
    )
    # measured once, used for both joins
    how = choose_strategy(client_side(dim), join.strategy, join.broadcast_max_bytes, join.hash_partition_max_bytes)
    fixed = join.fixed(how)
    # A dimension small enough to broadcast is read again faster than it is cached.
    with nullcontext(dim) if how == "broadcast" else cached(dim) as shared:
        calls_out = enrich_calls(calls, shared, time_rule=time_rule, join=fixed, keep_partition=keep)
        chats_out = enrich_chats(chats, shared, join=fixed, strict_dates=strict_dates, keep_partition=keep)
        if instants:
            calls_out, chats_out = to_instants(calls_out), to_instants(chats_out)
        if publish == "staged":
            outputs = {calls_table: calls_out, chats_table: chats_out}
            publish_staged(spark, outputs, staging_root=staging_root, fmt=sink_format, options=sink_options)
        else:
            write_table(calls_out, calls_table, **sink)
            write_table(chats_out, chats_table, **sink)
    return JobResult(calls_table, chats_table, how)
