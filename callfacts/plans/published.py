"""The batch job with one commit for all its outputs.

``run_published`` computes the enriched calls and chats by date, writes both below one root
and publishes them together as the next version (``sinks.manifest``).  On top of that:

* ``changed_only`` compares the fact files with those of the last version and recomputes only
  the dates that have a new, changed or vanished file; the other dates' files are kept.  The
  list of files is published with the outputs, so it never runs ahead of them.  A changed
  dimension, or other settings, recompute every date.
* ``strict`` counts the rules inside the write and publishes only if none was broken: each
  fact is read once, and a refused run leaves the last version as it was.
* ``quarantine`` sends every fact that breaks a rule or has no client to outputs of their own,
  in the same pass over the facts and the same version.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import schemas as S
from callfacts.functions.rules import Rule, fact_rules, key_not_number, message_rules, unreadable_rules
from callfacts.operators.enrich import choose_strategy, client_side, join_client
from callfacts.operators.normalize import parse_message_times, to_utc
from callfacts.operators.route import KEPT, NO_CLIENT, QUARANTINE, QUARANTINED, RAW, REASONS, ROUTE, routed
from callfacts.operators.shapes import as_message_list
from callfacts.plans.cache import cached
from callfacts.plans.job import CORRUPT, JoinOptions
from callfacts.sinks.gate import Gate
from callfacts.sinks.manifest import Attempt, Manifest, Output, PublishConflict, current
from callfacts.sources.readers import (
    LEDGER,
    Partition,
    changed_dates,
    input_files,
    read_call_lines,
    read_calls_csv,
    read_chat_lines,
    read_chats_json,
    read_table,
    require_files,
)

KINDS = ("calls", "chats")
PART = "part"  # folder column: the date, as text
DIMENSION, SETTINGS, FILES = "dimension", "settings", "files"  # facts kept in the manifest


def quarantine_name(target: str) -> str:
    return f"{target}_quarantine"


@dataclass(frozen=True)
class PublishedRun:
    version: int
    dates: Mapping[str, list[str]]  # recomputed, by kind
    gone: Mapping[str, list[str]]  # dropped with their input, by kind
    counts: Mapping[str, Mapping[str, int]] = field(default_factory=dict)  # rows and broken rules, by kind
    join_strategy: str | None = None


def dimension_mark(dim: DataFrame) -> str:
    """Rows of the dimension and an order-free checksum of them; changes whenever a row does.

    Sums of hashes count repeated rows, which an exclusive or would cancel.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in dim.columns])
    row = dim.agg(F.count(F.lit(1)), F.sum(hashed.cast("decimal(20,0)")), F.bit_xor(hashed)).first()
    return f"{row[0]}:{row[1]}:{row[2]}"


class _Kind:
    """What differs between calls and chats."""

    def __init__(self, kind: str, root: str, chat_schema: T.StructType, timestamp_format: str | None, time_rule: str):
        self.kind, self.root, self.time_rule = kind, root, time_rule
        self.chat_schema, self.read_options = chat_schema, dict(timestamp_format=timestamp_format, corrupt_column=CORRUPT)
        self.schema = S.CLIENT_CALL if kind == "calls" else S.CLIENT_CHAT

    def read(self, spark: SparkSession, partition: Partition, raw: bool) -> DataFrame:
        with_raw = dict(raw_column=RAW) if raw else {}
        if self.kind == "calls":
            return (read_call_lines if raw else read_calls_csv)(spark, self.root, partition, **with_raw, **self.read_options)
        chats = (read_chat_lines if raw else read_chats_json)(spark, self.root, partition, schema=self.chat_schema, **with_raw, **self.read_options)
        return as_message_list(chats)

    def rules(self) -> list[Rule]:
        """Everything that sends a fact to quarantine."""
        fields = ["startAt", "endAt", *(["messages"] if self.kind == "chats" else [])]
        more = message_rules() if self.kind == "chats" else []
        unread = unreadable_rules(CORRUPT, fields)
        read = F.col(CORRUPT).isNull()
        # a field that could not be read is reported as that, not as missing too
        known = [(c if "is missing" not in m or m.startswith("clientId") else c & read, m) for c, m in fact_rules()]
        return known + unread + more

    def strict_rules(self, keys: bool, dates: bool) -> list[Rule]:
        """What the strict modes refuse."""
        if not keys and not dates:
            return []
        fields = ["startAt", "endAt", *(["messages"] if self.kind == "chats" else [])]
        found = ([key_not_number()] if keys else []) + unreadable_rules(CORRUPT, fields)
        return found + (message_rules() if dates and self.kind == "chats" else [])

    def shaped(self, joined: DataFrame) -> DataFrame:
        """Times in UTC: after the join, so only for facts that stay."""
        return to_utc(joined, rule=self.time_rule) if self.kind == "calls" else parse_message_times(joined)


def _part() -> Column:
    return F.coalesce(F.col(S.PARTITION_COLUMN).cast("string"), F.lit("none")).alias(PART)


def run_published(
    spark: SparkSession,
    *,
    root: str,
    calls_root: str,
    chats_root: str,
    dim_table: str = "dim_client",
    partition: Partition = None,
    changed_only: bool = False,
    calls_table: str = "calls",
    chats_table: str = "chats",
    quarantine: bool = False,
    join: JoinOptions = JoinOptions(),
    strict_dates: bool = False,
    most_quarantined: float = 1.0,
    time_rule: str = "zone",
    timestamp_format: str | None = None,
    chat_schema: T.StructType = S.CHAT_RAW,
    allow_empty: bool = False,
    sink_format: str = "parquet",
    sink_options: Mapping[str, str] | None = None,
) -> PublishedRun:
    """Compute ``partition`` (a date, dates, or None for all) and publish both targets as one version.

    Naming dates replaces those dates and keeps the others of the last version; None replaces
    everything.  ``changed_only`` finds the dates itself.  Both raise ``PublishConflict`` when
    another run has published in between; whoever lost runs again.

    Targets, and with ``quarantine`` ``<target>_quarantine``, are outputs of the manifest; read
    them with ``sinks.read_output``.  ``most_quarantined`` refuses to publish when a larger
    share of a kind's facts would be quarantined.
    """
    if calls_table == chats_table:
        raise ValueError("the two targets must have two names")
    if quarantine and (join.strict or strict_dates):
        raise ValueError("strict runs refuse what quarantine would keep: choose one")
    kinds = {
        calls_table: _Kind("calls", calls_root, chat_schema, timestamp_format, time_rule),
        chats_table: _Kind("chats", chats_root, chat_schema, timestamp_format, time_rule),
    }
    last = current(spark, root)
    dim = read_table(spark, dim_table, S.CLIENT)
    attempt = Attempt(spark, root)
    facts: dict[str, str] = {}
    wanted: dict[str, Partition] = {t: partition for t in kinds}
    gone: dict[str, list[str]] = {t: [] for t in kinds}
    whole = partition is None
    if changed_only:
        if partition is not None:
            raise ValueError("changed_only finds the dates itself")
        settings = dict(
            roots=[calls_root, chats_root], time=[time_rule, timestamp_format], chats=chat_schema.json(),
            quarantine=quarantine, sink=[sink_format, sorted((sink_options or {}).items())],
        )
        facts = {DIMENSION: dimension_mark(dim), SETTINGS: json.dumps(settings)}
        # the list is taken before the facts are read: a file that lands meanwhile is new next time
        now = input_files(spark, "calls", calls_root).unionByName(input_files(spark, "chats", chats_root))
        facts[FILES] = attempt.save(now, FILES)
        now = spark.read.schema(LEDGER).parquet(f"{attempt.root}/{facts[FILES]}")
        same = all(last.facts.get(k) == facts[k] for k in (DIMENSION, SETTINGS)) and FILES in last.facts
        whole = not same
        before = f"{attempt.root}/{last.facts[FILES]}" if same else None
        seen = spark.read.schema(LEDGER).parquet(before) if before else spark.createDataFrame([], LEDGER)
        found = changed_dates(seen, now).collect()  # one row a changed date
        if any(r["date"] == "" for r in found):
            raise ValueError("fact files outside the date folders cannot be recomputed by date")
        for target, k in kinds.items():
            wanted[target] = sorted(r["date"] for r in found if r["kind"] == k.kind and r["files"])
            gone[target] = sorted(r["date"] for r in found if r["kind"] == k.kind and not r["files"])
        if same and not any(wanted.values()) and not any(gone.values()):
            attempt.files.delete("data", attempt.name)
            return PublishedRun(last.version, {t: [] for t in kinds}, gone)

    todo = {t: k for t, k in kinds.items() if wanted[t] is None or wanted[t]}
    how = choose_strategy(client_side(dim), join.strategy, join.broadcast_max_bytes, join.hash_partition_max_bytes)
    given = {**join.fixed(how).kwargs(), "strict": False}  # the gate counts, the join does not raise
    gates: dict[str, Gate] = {}
    outputs: dict[str, Output] = {}
    reads = {t: k.read(spark, wanted[t], quarantine) for t, k in todo.items()}  # a missing date fails here
    if not allow_empty and not changed_only:
        for t, k in todo.items():
            require_files(reads[t], k.root, wanted[t])
    with nullcontext(dim) if how == "broadcast" else cached(dim) as shared:
        for target, k in todo.items():
            if quarantine:
                rows = routed(reads[target], shared, k.rules(), **given)
                reasons = [*(m for _, m in k.rules()), NO_CLIENT]
                each = [(m, F.array_contains(REASONS, m)) for m in reasons]
                gates[target] = Gate(target, [(F.col(ROUTE) == QUARANTINED, "quarantined")], each)
                rows = gates[target].watch(rows)
                columns = [*k.schema.fieldNames(), RAW, REASONS]
                folder = attempt.save(k.shaped(rows).select(*columns, ROUTE, _part()), target, (ROUTE, PART), sink_format, sink_options)
                for name, route, schema in ((target, KEPT, k.schema), (quarantine_name(target), QUARANTINED, QUARANTINE)):
                    parts = attempt.parts(f"{folder}/{ROUTE}={route}", f"{PART}=")
                    outputs[name] = Output(schema, parts, sink_format)
            else:
                gates[target] = Gate(target, k.strict_rules(join.strict, strict_dates))
                rows = join_client(gates[target].watch(reads[target]), shared, **given)
                folder = attempt.save(k.shaped(rows).select(*k.schema.fieldNames(), _part()), target, (PART,), sink_format, sink_options)
                outputs[target] = Output(k.schema, attempt.parts(folder, f"{PART}="), sink_format)
        counts = {t: g.require(most_quarantined if quarantine else 0.0) for t, g in gates.items()}
    done = {t: _dates(wanted[t], outputs, t) for t in kinds}
    if whole:  # a kind without a fact is an empty output
        for target, k in kinds.items():
            outputs.setdefault(target, Output(k.schema, {}, sink_format))
    if not whole:  # keep the last version's other dates
        for target in kinds:
            replaced = {*done[target], *gone[target]}
            for name, schema in ((target, kinds[target].schema), (quarantine_name(target), QUARANTINE)):
                old = last.outputs.get(name)
                if name in outputs or old:
                    new = outputs.get(name, Output(schema, {}, sink_format))
                    if old and old.fmt != new.fmt:
                        raise ValueError(f"{name} is kept as {old.fmt}; publish all dates to change that")
                    held = {d: f for d, f in old.parts.items() if d not in replaced} if old else {}
                    outputs[name] = Output(schema, {**held, **new.parts}, new.fmt)
    manifest: Manifest = attempt.publish(outputs, facts, expect=None if whole else last.version, keep=False)
    return PublishedRun(manifest.version, done, gone, counts, how)


def _dates(wanted: Partition, outputs: Mapping[str, Output], target: str) -> list[str]:
    if wanted is None:
        names = [n for n in (target, quarantine_name(target)) if n in outputs]
        return sorted({d for n in names for d in outputs[n].parts})
    return [wanted] if isinstance(wanted, str) else list(wanted)


__all__ = ["PublishConflict", "PublishedRun", "dimension_mark", "quarantine_name", "run_published"]
