"""Registered queries: one per operator group of the inventory, each with the
SQL a DuckDB oracle runs on the same parquet tables.

Every query reads the driver's tables (or folders Spark derives from them) in
full.  Nested results are flattened and every computed column is aliased the
same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import fixtures, scratch
from callfacts import schemas as S
from callfacts.functions.rules import unreadable_rules
from callfacts.functions.times import later_utc, parse_date_text, skipped
from callfacts.operators.checks import StrictInputError, violation_rows
from callfacts.operators.enrich import join_client, save_bucketed
from callfacts.operators.normalize import rewrite_nested, to_utc
from callfacts.plans.job import JoinOptions, enrich_calls, enrich_chat_messages, enrich_chats, run
from callfacts.plans.published import quarantine_name, run_published
from callfacts.sinks.manifest import current, read_output
from callfacts.sinks.staged_source import StagedTable
from callfacts.sinks.writer import connector_options, target_name, write_table
from callfacts.sources.readers import read_calls_csv, read_chats_json, read_table, read_text

Query = Callable[[SparkSession, str], DataFrame]

# The one date that the single-partition read selects (a date with calls).
ONE_DATE = "2024-01-05"
TARGET_SUFFIX = "_stg"
# Chats whose ``messages`` are one object each.
CHAT_STRUCT = T.StructType(S.CHAT_RAW.fields[:4] + [T.StructField("messages", S.MESSAGE_RAW)])


# -- inputs ------------------------------------------------------------------


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, fixtures.register_clients(spark, sf_dir), S.CLIENT)


def _calls(spark: SparkSession, sf_dir: str, partition=None) -> DataFrame:
    return read_calls_csv(spark, fixtures.call_folder(spark, sf_dir), partition)


def _chats(spark: SparkSession, sf_dir: str, partition=None) -> DataFrame:
    return read_chats_json(spark, fixtures.chat_folder(spark, sf_dir), partition)


def _client_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_calls(_calls(spark, sf_dir), _dim(spark, sf_dir))


def _read_back(spark: SparkSession, path: str, schema) -> DataFrame:
    """Our own output, read with the schema it was written with (no inference job)."""
    return spark.read.schema(schema).parquet(path)


# -- scans -------------------------------------------------------------------


def scan_dim_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim(spark, sf_dir)


def scan_calls_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir)


def calls_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir, ONE_DATE)


def scan_chats_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("m")
    return _chats(spark, sf_dir).select(
        "id", "clientId", "startAt", "endAt", "date", F.explode("messages").alias("m")
    ).select(
        "id",
        "clientId",
        "startAt",
        "endAt",
        "date",
        m.getField("id").alias("message_id"),
        m.getField("text").alias("text"),
        m.getField("sendAt").alias("sendAt"),
    )


def scan_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text(spark, fixtures.text_folder(spark, sf_dir))


# -- expressions -------------------------------------------------------------


def _orders_as_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixtures.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("startAt"))


def times_zone_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_utc(_orders_as_calls(spark, sf_dir), rule="zone", columns=("startAt",))


def times_fixed_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_utc(_orders_as_calls(spark, sf_dir), rule="fixed", columns=("startAt",))


def times_clock_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times in the night hours in which clocks change: both UTC times, and which kind of hour it is."""
    minutes = F.make_dt_interval(mins=(F.pmod(F.col("id"), F.lit(180)) + 60).cast("int"))
    wall = _orders_as_calls(spark, sf_dir).withColumn("startAt", F.to_date("startAt").cast("timestamp_ntz") + minutes)
    late = later_utc("startAt")
    kind = F.when(late.isNotNull(), "repeated").when(skipped("startAt"), "skipped").otherwise("plain")
    both = wall.withColumns({"hour": kind, "endAt": F.col("startAt")})
    return to_utc(to_utc(both, columns=("endAt",), repeated="later"), columns=("startAt",))


def _dirty_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_chats_json(spark, fixtures.dirty_chat_folder(spark, sf_dir))


def message_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message dates read from the nested list, parsed once per message row; some are unreadable."""
    m = F.col("m")
    return _dirty_chats(spark, sf_dir).select("id", F.explode("messages").alias("m")).select(
        "id", m.getField("id").alias("message_id"), parse_date_text(m.getField("sendAt")).alias("sendAt")
    )


def message_time_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The struct form of the nested rewrite, over every message."""
    each = _dirty_chats(spark, sf_dir).select("id", F.explode("messages").alias("message"))
    parsed = rewrite_nested(each, "message", "sendAt", parse_date_text)
    m = F.col("message")
    return parsed.select("id", m.getField("id").alias("message_id"), m.getField("sendAt").alias("sendAt"))


def calls_iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose times are ISO text of several forms; a time that names a zone is unreadable."""
    calls = read_calls_csv(spark, fixtures.iso_call_folder(spark, sf_dir), corrupt_column="raw")
    bad = F.filter(
        F.array(*[F.when(c, F.lit(m)) for c, m in unreadable_rules("raw", ["startAt", "endAt"])]), lambda x: x.isNotNull()
    )
    return calls.select("id", "clientId", "startAt", "endAt", F.array_join(bad, "; ").alias("unreadable"))


def chats_struct_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over chats whose ``messages`` are one object each."""
    root = scratch.fresh_folder(spark, "sinks", "struct")
    _run_job(spark, sf_dir, root, chats_root=fixtures.struct_chat_folder(spark, sf_dir), chat_schema=CHAT_STRUCT)
    return _each_message(_read_back(spark, f"{root}/chats{TARGET_SUFFIX}", S.CLIENT_CHAT))


# -- joins -------------------------------------------------------------------


def client_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _client_calls(spark, sf_dir)


def _each_message(chats: DataFrame) -> DataFrame:
    """Every field of ClientChat rows, one row per message."""
    m = F.col("m")
    return chats.select("id", "clientId", "startAt", "endAt", "name", F.explode("messages").alias("m")).select(
        "id",
        "clientId",
        "startAt",
        "endAt",
        "name",
        m.getField("id").alias("message_id"),
        m.getField("text").alias("text"),
        m.getField("sendAt").alias("sendAt"),
    )


def client_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ClientChat rows, every message of the rewritten list."""
    return _each_message(enrich_chats(_chats(spark, sf_dir), _dim(spark, sf_dir)))


def client_chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_chat_messages(_chats(spark, sf_dir), _dim(spark, sf_dir))


def join_dirty_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_client(fixtures.dirty_calls_frame(spark, sf_dir), _dim(spark, sf_dir))
    return joined.select("id", "clientId", "name")


def join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The salted join: most clients are hot at this bound, none may lose a call."""
    calls = enrich_calls(_calls(spark, sf_dir), _dim(spark, sf_dir), join=JoinOptions(strategy="split", hot_key_rows=2))
    return calls


def join_bucketed_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both joins against a dimension saved in buckets once; some clients are hot at this bound."""
    path = scratch.fresh_folder(spark, "sinks", "bucketed")
    dim = spark.table(save_bucketed(_dim(spark, sf_dir), "dim_client_bucketed", path=path))
    how = JoinOptions(strategy="bucketed", hot_key_rows=20)
    return _both_targets(enrich_calls(_calls(spark, sf_dir), dim, join=how), enrich_chats(_chats(spark, sf_dir), dim, join=how))


def call_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_rows(fixtures.dirty_calls_frame(spark, sf_dir).drop("date"))


def chat_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All failed rules of raw chats, message dates included."""
    return violation_rows(fixtures.dirty_chats_frame(spark, sf_dir).drop("date"))


# -- sinks -------------------------------------------------------------------


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the enriched calls twice with overwrite; the second replaces the first."""
    target = scratch.fresh_folder(spark, "sinks", "overwrite")
    rows = _client_calls(spark, sf_dir)
    write_table(rows, target, mode="overwrite")
    write_table(rows, target, mode="overwrite")
    return _read_back(spark, target, S.CLIENT_CALL)


def sink_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """overwrite -> append -> ignore -> error on one target: two copies remain."""
    target = scratch.fresh_folder(spark, "sinks", "modes")
    rows = _client_calls(spark, sf_dir)
    write_table(rows, target, mode="overwrite")
    write_table(rows, target, mode="append")
    write_table(rows, target, mode="ignore")
    try:
        write_table(rows, target, mode="error")
    except Exception as e:  # the target exists: refused, and left as it was
        if "already exists" not in str(e).lower() and "PATH_ALREADY_EXISTS" not in str(e):
            raise
    else:
        raise AssertionError("mode 'error' wrote over an existing target")
    return _read_back(spark, target, S.CLIENT_CALL)


def _run_job(spark: SparkSession, sf_dir: str, root: str, **options) -> None:
    """The whole job into Parquet folders below ``root``."""
    given = dict(
        partition=None,
        calls_table=f"{root}/{target_name('calls', TARGET_SUFFIX)}",
        chats_table=f"{root}/{target_name('chats', TARGET_SUFFIX)}",
        calls_root=fixtures.call_folder(spark, sf_dir),
        chats_root=options.pop("chats_root", None) or fixtures.chat_folder(spark, sf_dir),
        dim_table=fixtures.register_clients(spark, sf_dir),
    )
    run(spark, **(given | options))


def _both_targets(calls: DataFrame, chats: DataFrame) -> DataFrame:
    """Calls, and every message of the chats, under the names of their targets."""
    cols = ["id", "clientId", "startAt", "endAt", "name"]
    time = chats.schema["messages"].dataType.elementType["sendAt"].dataType
    none = [F.lit(None).cast(t).alias(c) for c, t in (("message_id", "bigint"), ("text", "string"), ("sendAt", time))]
    left = calls.select(F.lit(target_name("calls", TARGET_SUFFIX)).alias("target"), *cols, *none)
    return left.unionByName(_each_message(chats).withColumn("target", F.lit(target_name("chats", TARGET_SUFFIX))))


def _job_output(spark: SparkSession, root: str) -> DataFrame:
    return _both_targets(
        _read_back(spark, f"{root}/{target_name('calls', TARGET_SUFFIX)}", S.CLIENT_CALL),
        _read_back(spark, f"{root}/{target_name('chats', TARGET_SUFFIX)}", S.CLIENT_CHAT),
    )


def two_sinks_shared_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over every date: two targets from one dimension."""
    root = scratch.fresh_folder(spark, "sinks", "job")
    _run_job(spark, sf_dir, root)
    return _job_output(spark, root)


def job_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job for one date, as it is run in production, with every strict check."""
    root = scratch.fresh_folder(spark, "sinks", "date")
    _run_job(spark, sf_dir, root, partition=ONE_DATE, join=JoinOptions(strict=True), strict_dates=True)
    return _job_output(spark, root)


def job_fixed_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with the flat offset instead of the zone's rules."""
    root = scratch.fresh_folder(spark, "sinks", "offset")
    _run_job(spark, sf_dir, root, time_rule="fixed")
    return _job_output(spark, root)


def sink_target_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The connector form of the write: the target is an option of the format."""
    target = scratch.fresh_folder(spark, "sinks", "option")
    write_table(_client_calls(spark, sf_dir), target, fmt="orc", options={"compression": "zlib"}, target_option="path")
    return spark.read.schema(S.CLIENT_CALL).orc(target)


def two_sinks_staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job into catalog tables through a staged publish (outputs first, then repoint)."""
    calls_t = target_name("calls", TARGET_SUFFIX)
    chats_t = target_name("chats", TARGET_SUFFIX)
    staging = scratch.fresh_folder(spark, "sinks", "staged")
    _run_job(spark, sf_dir, "", calls_table=calls_t, chats_table=chats_t, catalog=True, publish="staged", staging_root=staging)
    return _both_targets(spark.read.table(calls_t), spark.read.table(chats_t))


def sink_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job through the warehouse sink with its five settings, then both tables read through it."""
    spark.dataSource.register(StagedTable)
    settings = dict(host="warehouse", user="loader", db="staging", password="-")
    settings["stagingFsUrl"] = scratch.fresh_folder(spark, "sinks", "warehouse")
    options = connector_options(settings)
    tables = [target_name(t, TARGET_SUFFIX) for t in ("calls", "chats")]
    into = dict(sink_format=StagedTable.name(), sink_options=options, target_option="table")
    _run_job(spark, sf_dir, "", calls_table=tables[0], chats_table=tables[1], **into)
    read = lambda t: spark.read.format(StagedTable.name()).options(**options, table=t).load()
    return _both_targets(*map(read, tables))


def two_sinks_cached_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with a dimension over the broadcast bound: cached for both joins, then released."""
    root = scratch.fresh_folder(spark, "sinks", "cached")
    _run_job(spark, sf_dir, root, join=JoinOptions(broadcast_max_bytes=0))
    return _job_output(spark, root)


def job_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with instants in its targets, as microseconds since 1970."""
    root = scratch.fresh_folder(spark, "sinks", "instants")
    _run_job(spark, sf_dir, root, instants=True)
    calls, chats = (spark.read.parquet(f"{root}/{target_name(t, TARGET_SUFFIX)}") for t in ("calls", "chats"))
    both = _both_targets(calls, chats.select("id", "clientId", "startAt", "endAt", "name", "messages"))
    times = [F.unix_micros(c).alias(c) for c in ("startAt", "endAt", "sendAt")]
    return both.select("target", "id", "message_id", *times)


def _published(spark: SparkSession, sf_dir: str, root: str, **options):
    given = dict(
        calls_root=fixtures.call_folder(spark, sf_dir),
        chats_root=fixtures.chat_folder(spark, sf_dir),
        dim_table=fixtures.register_clients(spark, sf_dir),
        calls_table=target_name("calls", TARGET_SUFFIX),
        chats_table=target_name("chats", TARGET_SUFFIX),
    )
    return run_published(spark, root=root, **(given | options))


def _published_output(spark: SparkSession, root: str) -> DataFrame:
    """Both targets of one version."""
    seen = current(spark, root)
    return _both_targets(*[read_output(spark, root, target_name(t, TARGET_SUFFIX), seen) for t in ("calls", "chats")])


def two_sinks_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both targets published by one commit: every date, and then one date of it again."""
    root = scratch.fresh_folder(spark, "sinks", "manifest")
    _published(spark, sf_dir, root)
    _published(spark, sf_dir, root, partition=ONE_DATE)
    return _published_output(spark, root)


def job_changed_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the facts that landed first, then one over the dates that late files changed."""
    root, calls, chats = (scratch.fresh_folder(spark, "sinks", x) for x in ("changed", "landed_calls", "landed_chats"))
    for late in (False, True):
        fixtures.land(spark, sf_dir, calls, chats, late)
        _published(spark, sf_dir, root, calls_root=calls, chats_root=chats, changed_only=True)
    return _published_output(spark, root)


def job_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate of a strict run counted while the refused calls were written."""
    root = scratch.fresh_folder(spark, "sinks", "gate")
    try:
        _published(spark, sf_dir, root, calls_root=fixtures.dirty_call_folder(spark, sf_dir), join=JoinOptions(strict=True))
    except StrictInputError as refused:
        counts = list(refused.report.items())
    else:
        raise AssertionError("a strict run published calls that break its rules")
    if current(spark, root).version:
        raise AssertionError("a refused run must not publish")
    return spark.createDataFrame(counts, "rule string, n long")


def facts_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty calls and chats routed in one pass each: target rows, and quarantined ones with raw line and reasons."""
    root = scratch.fresh_folder(spark, "sinks", "quarantine")
    dirty = dict(calls_root=fixtures.dirty_call_folder(spark, sf_dir), chats_root=fixtures.dirty_chat_folder(spark, sf_dir))
    _published(spark, sf_dir, root, quarantine=True, **dirty)
    seen, parts = current(spark, root), []
    for kind in ("calls", "chats"):
        target = target_name(kind, TARGET_SUFFIX)
        kept, held = (read_output(spark, root, n, seen) for n in (target, quarantine_name(target)))
        none = lambda c: F.lit(None).cast("string").alias(c)
        raw = F.col("raw") if kind == "calls" else F.lit(None).cast("string").alias("raw")
        parts.append(kept.select(F.lit(target).alias("output"), "id", "clientId", "name", none("raw"), none("reasons")))
        reasons = F.array_join("reasons", "; ").alias("reasons")
        parts.append(held.select(F.lit(quarantine_name(target)).alias("output"), "id", "clientId", none("name"), raw, reasons))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def stream_client_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls enrichment as a stream over the date folders (available-now run)."""
    from callfacts.streaming import run_available_now, start

    root = scratch.fresh_folder(spark, "streams", "calls")
    q = start(
        spark,
        kind="calls",
        fact_root=fixtures.call_folder(spark, sf_dir),
        target=f"{root}/out",
        checkpoint=f"{root}/checkpoint",
        dim_table=fixtures.register_clients(spark, sf_dir),
    )
    run_available_now(q)
    return _read_back(spark, f"{root}/out", S.with_partition(S.CLIENT_CALL)).select(
        "id", "clientId", "startAt", "endAt", "name"
    )


def stream_client_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chats enrichment as a stream; shaped like ``client_chats`` for the check."""
    from callfacts.streaming import run_available_now, start

    root = scratch.fresh_folder(spark, "streams", "chats")
    q = start(
        spark,
        kind="chats",
        fact_root=fixtures.chat_folder(spark, sf_dir),
        target=f"{root}/out",
        checkpoint=f"{root}/checkpoint",
        dim_table=fixtures.register_clients(spark, sf_dir),
    )
    run_available_now(q)
    return _each_message(_read_back(spark, f"{root}/out", S.with_partition(S.CLIENT_CHAT)))


QUERIES: dict[str, Query] = {
    "client_calls": client_calls,
    "scan_dim_client": scan_dim_client,
    "scan_calls_csv": scan_calls_csv,
    "calls_one_partition": calls_one_partition,
    "scan_chats_json": scan_chats_json,
    "scan_text_lines": scan_text_lines,
    "times_zone_rule": times_zone_rule,
    "times_fixed_offset": times_fixed_offset,
    "message_times": message_times,
    "message_time_struct": message_time_struct,
    "client_chats": client_chats,
    "client_chat_messages": client_chat_messages,
    "join_dirty_keys": join_dirty_keys,
    "call_rule_violations": call_rule_violations,
    "chat_rule_violations": chat_rule_violations,
    "sink_overwrite": sink_overwrite,
    "sink_modes": sink_modes,
    "two_sinks_shared_dim": two_sinks_shared_dim,
    "two_sinks_staged_publish": two_sinks_staged_publish,
    "job_one_date": job_one_date,
    "job_fixed_offset": job_fixed_offset,
    "sink_target_option": sink_target_option,
    "calls_iso_times": calls_iso_times,
    "chats_struct_messages": chats_struct_messages,
    "join_hot_keys": join_hot_keys,
    "stream_client_calls": stream_client_calls,
    "stream_client_chats": stream_client_chats,
    "two_sinks_cached_dim": two_sinks_cached_dim,
    "times_clock_changes": times_clock_changes,
    "join_bucketed_dim": join_bucketed_dim,
    "job_instants": job_instants,
    "sink_warehouse": sink_warehouse,
    "two_sinks_manifest": two_sinks_manifest,
    "job_changed_input": job_changed_input,
    "job_gate_counts": job_gate_counts,
    "facts_quarantine": facts_quarantine,
}


# -- oracle SQL (DuckDB) -----------------------------------------------------

_CALLS = """calls AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS clientId, ts AS startAt,
         ts + to_seconds(CAST(floor(value) AS BIGINT)) AS endAt, CAST(ts AS DATE) AS date
  FROM events)"""

_DIRTY = """dirty AS (
  SELECT event_id AS id,
         CASE event_id % 5
           WHEN 0 THEN 'x' || CAST(user_id AS VARCHAR)
           WHEN 1 THEN '0' || CAST(user_id AS VARCHAR)
           WHEN 2 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
           WHEN 3 THEN NULL
           ELSE CAST(user_id AS VARCHAR) END AS clientId,
         CASE WHEN event_id % 7 <> 4 THEN ts END AS startAt,
         CASE event_id % 7 WHEN 5 THEN NULL WHEN 6 THEN ts - INTERVAL 1 HOUR
           ELSE ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS endAt
  FROM events)"""

_CHATS = """chats AS (
  SELECT conv_id * 1000000 + turn // 64 AS id, CAST(conv_id AS VARCHAR) AS clientId,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id + (turn // 64) * 64) AS startAt,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id + (turn // 64) * 64 + count(*)) AS endAt,
         count(*) AS n_messages, min(turn) AS first_turn, max(turn) AS last_turn,
         DATE '2024-01-01' + CAST(conv_id % 7 AS INTEGER) AS date
  FROM conversations GROUP BY conv_id, turn // 64)"""

_MESSAGES = """messages AS (
  SELECT conv_id * 1000000 + turn // 64 AS id, turn AS message_id, text,
         strftime(DATE '2024-01-01' + CAST(turn AS INTEGER), '%m/%d/%Y') AS sendAtText
  FROM conversations)"""


# every fourth message date has month 13
def _dirty_time(turn: str) -> str:
    return f"CASE WHEN {turn} % 4 <> 3 THEN CAST(DATE '2024-01-01' + CAST({turn} AS INTEGER) AS TIMESTAMP) END"


def _utc(col: str) -> str:
    return f"timezone('UTC', timezone('Europe/Moscow', {col}))"


_CLIENT_CALLS = f"""
SELECT c.id, c.clientId, {_utc('c.startAt')} AS startAt, {_utc('c.endAt')} AS endAt, cu.c_name AS name
FROM calls c JOIN customer cu ON cu.c_custkey = TRY_CAST(c.clientId AS BIGINT)"""

_CLIENT_CHATS = """
SELECT c.id, c.clientId, c.startAt, c.endAt, cu.c_name AS name, m.message_id, m.text,
       CAST(try_strptime(m.sendAtText, '%m/%d/%Y') AS TIMESTAMP) AS sendAt
FROM chats c JOIN customer cu ON cu.c_custkey = TRY_CAST(c.clientId AS BIGINT) JOIN messages m ON m.id = c.id"""


def _two_sinks(calls: str = _CLIENT_CALLS, calls_where: str = "", chats_where: str = "") -> str:
    return f"""WITH {_CALLS}, {_CHATS}, {_MESSAGES}, cc AS ({calls} {calls_where}), ch AS ({_CLIENT_CHATS} {chats_where})
SELECT 'calls{TARGET_SUFFIX}' AS target, id, clientId, startAt, endAt, name,
       CAST(NULL AS BIGINT) AS message_id, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS TIMESTAMP) AS sendAt FROM cc
UNION ALL SELECT 'chats{TARGET_SUFFIX}', id, clientId, startAt, endAt, name, message_id, text, sendAt FROM ch"""


_FIXED_CALLS = _CLIENT_CALLS.replace(_utc("c.startAt"), "c.startAt - INTERVAL 3 HOUR").replace(
    _utc("c.endAt"), "c.endAt - INTERVAL 3 HOUR"
)

ORACLE_SQL: dict[str, str] = {
    "client_calls": f"WITH {_CALLS} {_CLIENT_CALLS}",
    "scan_dim_client": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "scan_calls_csv": f"WITH {_CALLS} SELECT id, clientId, startAt, endAt, date FROM calls",
    "calls_one_partition": f"WITH {_CALLS} SELECT id, clientId, startAt, endAt, date FROM calls "
    f"WHERE date = DATE '{ONE_DATE}'",
    "scan_chats_json": f"""WITH {_CHATS}, {_MESSAGES}
SELECT c.id, c.clientId, c.startAt, c.endAt, c.date, m.message_id, m.text, m.sendAtText AS sendAt
FROM chats c JOIN messages m ON m.id = c.id""",
    "scan_text_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "times_zone_rule": f"SELECT o_orderkey AS id, {_utc('o_orderdate')} AS startAt FROM orders",
    "times_fixed_offset": "SELECT o_orderkey AS id, o_orderdate - INTERVAL 3 HOUR AS startAt FROM orders",
    "message_times": f"""WITH {_MESSAGES}
SELECT id, message_id, {_dirty_time('message_id')} AS sendAt FROM messages""",
    "message_time_struct": f"""WITH {_MESSAGES}
SELECT id, message_id, {_dirty_time('message_id')} AS sendAt FROM messages""",
    "client_chats": f"WITH {_CHATS}, {_MESSAGES} {_CLIENT_CHATS}",
    "client_chat_messages": f"""WITH {_CHATS}, {_MESSAGES}
SELECT c.id, c.clientId, cu.c_name AS name, m.message_id, m.text,
       CAST(try_strptime(m.sendAtText, '%m/%d/%Y') AS TIMESTAMP) AS sendAt
FROM chats c JOIN customer cu ON cu.c_custkey = TRY_CAST(c.clientId AS BIGINT)
JOIN messages m ON m.id = c.id""",
    "join_dirty_keys": f"""WITH {_DIRTY}
SELECT d.id, d.clientId, cu.c_name AS name
FROM dirty d JOIN customer cu ON cu.c_custkey = TRY_CAST(d.clientId AS BIGINT)""",
    "call_rule_violations": f"""WITH {_DIRTY}
SELECT id, 'clientId is missing' AS rule FROM dirty WHERE clientId IS NULL
UNION ALL SELECT id, 'clientId is not a number' FROM dirty
  WHERE clientId IS NOT NULL AND TRY_CAST(clientId AS BIGINT) IS NULL
UNION ALL SELECT id, 'startAt is missing' FROM dirty WHERE startAt IS NULL
UNION ALL SELECT id, 'endAt is missing' FROM dirty WHERE endAt IS NULL
UNION ALL SELECT id, 'endAt is before startAt' FROM dirty WHERE endAt < startAt""",
    "chat_rule_violations": """SELECT conv_id * 1000000 + turn // 64 AS id, 'message date is unreadable' AS rule
FROM conversations GROUP BY conv_id, turn // 64 HAVING bool_or(turn % 4 = 3)""",
    "sink_overwrite": f"WITH {_CALLS} {_CLIENT_CALLS}",
    "stream_client_calls": f"WITH {_CALLS} {_CLIENT_CALLS}",
    "stream_client_chats": f"WITH {_CHATS}, {_MESSAGES} {_CLIENT_CHATS}",
    "sink_modes": f"WITH {_CALLS}, once AS ({_CLIENT_CALLS}) SELECT * FROM once UNION ALL SELECT * FROM once",
    "two_sinks_shared_dim": _two_sinks(),
    "two_sinks_staged_publish": _two_sinks(),
    "job_one_date": _two_sinks(
        calls_where=f"WHERE c.date = DATE '{ONE_DATE}'", chats_where=f"WHERE c.date = DATE '{ONE_DATE}'"
    ),
    "job_fixed_offset": _two_sinks(_FIXED_CALLS),
    "two_sinks_cached_dim": _two_sinks(),
    "join_bucketed_dim": _two_sinks(),
    "times_clock_changes": f"""
WITH walls AS (SELECT o_orderkey AS id, date_trunc('day', o_orderdate) + to_minutes(o_orderkey % 180 + 60) AS t FROM orders),
utc AS (SELECT id, t, {_utc('t')} AS late FROM walls),
kinds AS (  -- the later time an hour before shows the same wall time, or the wall time never shows
  SELECT *, timezone('Europe/Moscow', timezone('UTC', late - INTERVAL 1 HOUR)) = t AS twice,
         timezone('Europe/Moscow', timezone('UTC', late)) <> t AS never FROM utc)
SELECT id, CASE WHEN twice THEN late - INTERVAL 1 HOUR ELSE late END AS startAt, late AS endAt,
       CASE WHEN twice THEN 'repeated' WHEN never THEN 'skipped' ELSE 'plain' END AS hour FROM kinds""",
    "sink_warehouse": _two_sinks(),
    "job_instants": f"SELECT target, id, message_id, epoch_us(startAt) AS startAt, epoch_us(endAt) AS endAt, epoch_us(sendAt) AS sendAt "
    f"FROM ({_two_sinks()})",
    "two_sinks_manifest": _two_sinks(),
    "job_changed_input": _two_sinks(),
    "job_gate_counts": f"""WITH {_DIRTY}
SELECT 'rows' AS rule, count(*) AS n FROM dirty
UNION ALL SELECT 'clientId is not a number', count(*) FILTER (clientId IS NOT NULL AND TRY_CAST(clientId AS BIGINT) IS NULL) FROM dirty
UNION ALL SELECT 'startAt is unreadable', 0 UNION ALL SELECT 'endAt is unreadable', 0""",
    "facts_quarantine": f"""WITH {_DIRTY}, {_CHATS},
checked AS (
  SELECT d.*, cu.c_name AS name, list_filter([
    CASE WHEN clientId IS NULL THEN 'clientId is missing' END,
    CASE WHEN clientId IS NOT NULL AND TRY_CAST(clientId AS BIGINT) IS NULL THEN 'clientId is not a number' END,
    CASE WHEN startAt IS NULL THEN 'startAt is missing' END, CASE WHEN endAt IS NULL THEN 'endAt is missing' END,
    CASE WHEN endAt < startAt THEN 'endAt is before startAt' END,
    CASE WHEN TRY_CAST(clientId AS BIGINT) IS NOT NULL AND cu.c_custkey IS NULL THEN 'no such client' END], lambda x: x IS NOT NULL) AS why
  FROM dirty d LEFT JOIN customer cu ON cu.c_custkey = TRY_CAST(d.clientId AS BIGINT)),
spoiled AS (
  SELECT c.id, c.clientId, cu.c_name AS name, list_filter([
    CASE WHEN EXISTS (SELECT 1 FROM conversations v WHERE v.conv_id * 1000000 + v.turn // 64 = c.id AND v.turn % 4 = 3)
      THEN 'message date is unreadable' END,
    CASE WHEN cu.c_custkey IS NULL THEN 'no such client' END], lambda x: x IS NOT NULL) AS why
  FROM chats c LEFT JOIN customer cu ON cu.c_custkey = TRY_CAST(c.clientId AS BIGINT))
SELECT CASE WHEN len(why) = 0 THEN 'calls{TARGET_SUFFIX}' ELSE 'calls{TARGET_SUFFIX}_quarantine' END AS output, id, clientId,
       CASE WHEN len(why) = 0 THEN name END AS name,
       CASE WHEN len(why) > 0 THEN concat(id, ',', coalesce(clientId, ''), ',', coalesce(strftime(startAt, '%Y-%m-%d %H:%M:%S.%f'), ''),
            ',', coalesce(strftime(endAt, '%Y-%m-%d %H:%M:%S.%f'), '')) END AS raw,
       CASE WHEN len(why) > 0 THEN array_to_string(why, '; ') END AS reasons
FROM checked
UNION ALL
SELECT CASE WHEN len(why) = 0 THEN 'chats{TARGET_SUFFIX}' ELSE 'chats{TARGET_SUFFIX}_quarantine' END, id, clientId,
       CASE WHEN len(why) = 0 THEN name END, NULL, CASE WHEN len(why) > 0 THEN array_to_string(why, '; ') END
FROM spoiled""",
    "sink_target_option": f"WITH {_CALLS} {_CLIENT_CALLS}",
    "join_hot_keys": f"WITH {_CALLS} {_CLIENT_CALLS}",
    "calls_iso_times": f"""WITH {_CALLS},
written AS (  -- only one form in three keeps milliseconds
  SELECT id, clientId, CASE WHEN id % 3 = 2 THEN date_trunc('milliseconds', startAt) ELSE date_trunc('second', startAt) END AS s,
         CASE WHEN id % 3 = 2 THEN date_trunc('milliseconds', endAt) ELSE date_trunc('second', endAt) END AS e
  FROM calls)
SELECT id, clientId, CASE WHEN id % 11 <> 10 THEN s END AS startAt, e AS endAt,
       CASE WHEN id % 11 = 10 THEN 'startAt is unreadable' ELSE '' END AS unreadable FROM written""",
    "chats_struct_messages": f"""WITH {_CHATS}, {_MESSAGES}
SELECT c.id, c.clientId, c.startAt, c.endAt, cu.c_name AS name, m.message_id, m.text, {_dirty_time('m.message_id')} AS sendAt
FROM chats c JOIN customer cu ON cu.c_custkey = TRY_CAST(c.clientId AS BIGINT) JOIN messages m ON m.id = c.id""",
}
