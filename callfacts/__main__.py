"""Command line for spark-submit:

    spark-submit --py-files callfacts.zip callfacts/__main__.py \\
        --partition 2021-09-21 --callsTable calls_stg --chatsTable chats_stg

Options mirror the original job: one partition date and the two target
tables (or a suffix appended to the fixed stems ``calls`` / ``chats``).  Sink
settings come from a JSON file, never from the command line; with
``--warehouse`` the five connector settings are checked (all missing ones
reported together) and passed as the connector expects them.

``--publish manifest`` publishes both outputs as one version below ``--staging-root``;
``--changed-only`` then recomputes the dates whose files changed since the last version.
"""

from __future__ import annotations

import argparse
import json
import sys

from callfacts.operators.enrich import STRATEGIES
from callfacts.plans.job import JoinOptions, run
from callfacts.plans.sizing import DEFAULT_BROADCAST_MAX_BYTES
from callfacts.sinks.writer import SAVE_MODES, connector_options, target_name


# Fixed values, kept so that existing invocations keep working: the option
# names of the original command line (-p/--partition, --callsTable,
# --chatsTable) and its input names (fact_call, fact_chat, dim_client).


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(
        prog="callfacts", description="Enrich one date of call and chat facts with client names and write them out."
    )
    p.add_argument("-p", "--partition", nargs="+", metavar="DATE", help="date folder(s) to process, yyyy-MM-dd")
    names = p.add_mutually_exclusive_group(required=True)
    names.add_argument("--callsTable", dest="calls_table", metavar="TARGET", help="where the enriched calls go")
    names.add_argument("--tableSuffix", dest="table_suffix", help="targets are calls<suffix> and chats<suffix>")
    p.add_argument("--chatsTable", dest="chats_table", metavar="TARGET", help="where the enriched chats go")
    p.add_argument("--calls-root", default="fact_call")
    p.add_argument("--chats-root", default="fact_chat")
    p.add_argument("--dim-table", default="dim_client")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--sink-options-file", help="JSON object of sink settings")
    p.add_argument("--warehouse", action="store_true", help="validate and map the five connector settings")
    p.add_argument("--target-option", help="pass the target as this option (e.g. table, dbtable)")
    p.add_argument("--catalog", action="store_true", help="targets are catalog tables (saveAsTable)")
    p.add_argument("--mode", default="overwrite", choices=SAVE_MODES)
    p.add_argument("--partition-overwrite", choices=("static", "dynamic"))
    p.add_argument("--publish", default="overwrite", choices=("overwrite", "staged", "manifest"))
    p.add_argument("--staging-root", help="versioned folders for --publish staged (catalog targets) or manifest")
    p.add_argument("--changed-only", action="store_true", help="find the dates whose files changed (--publish manifest)")
    p.add_argument("--quarantine", action="store_true", help="facts that break a rule go to an output of their own (--publish manifest)")
    p.add_argument("--instants", action="store_true", help="write instants instead of UTC wall times")
    p.add_argument("--time-rule", default="zone", choices=("zone", "fixed"))
    p.add_argument("--join-strategy", default="auto", choices=STRATEGIES)
    p.add_argument("--broadcast-max-bytes", type=int, default=DEFAULT_BROADCAST_MAX_BYTES)
    p.add_argument("--timestamp-format", help="pattern of the facts' times (ISO forms need none)")
    p.add_argument("--allow-empty", action="store_true", help="accept a date without data")
    p.add_argument("--strict-keys", action="store_true")
    p.add_argument("--strict-dates", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    published = args.publish == "manifest"
    if not args.partition and not args.changed_only:
        parser().error("name the dates with --partition, or let --changed-only find them")
    if (args.changed_only or args.quarantine) and not published:
        parser().error("--changed-only and --quarantine need --publish manifest")
    if published and not args.staging_root:
        parser().error("--publish manifest needs --staging-root")
    if published and (args.catalog or args.target_option or args.warehouse or args.instants or args.partition_overwrite):
        parser().error("--publish manifest writes files below its root: no catalog, connector, instants or partition overwrite")
    if args.calls_table and not args.chats_table:
        parser().error("--chatsTable is required with --callsTable")
    calls_t = args.calls_table or target_name("calls", args.table_suffix)
    chats_t = args.chats_table or target_name("chats", args.table_suffix)
    options = {}
    if args.sink_options_file:
        with open(args.sink_options_file) as f:
            options = json.load(f)
    target_option = args.target_option
    if args.warehouse:
        options = connector_options(options)
        target_option = target_option or "table"

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("callfacts").getOrCreate()
    partition = args.partition[0] if args.partition and len(args.partition) == 1 else args.partition
    if published:
        from callfacts.plans.published import run_published

        done = run_published(
            spark,
            root=args.staging_root,
            partition=partition,
            changed_only=args.changed_only,
            calls_table=calls_t,
            chats_table=chats_t,
            calls_root=args.calls_root,
            chats_root=args.chats_root,
            dim_table=args.dim_table,
            quarantine=args.quarantine,
            join=JoinOptions(args.join_strategy, args.strict_keys, args.broadcast_max_bytes),
            strict_dates=args.strict_dates,
            time_rule=args.time_rule,
            timestamp_format=args.timestamp_format,
            allow_empty=args.allow_empty,
            sink_format=args.sink_format,
            sink_options=options,
        )
        print(json.dumps(done.__dict__))
        return 0
    result = run(
        spark,
        partition=partition,
        calls_table=calls_t,
        chats_table=chats_t,
        calls_root=args.calls_root,
        chats_root=args.chats_root,
        dim_table=args.dim_table,
        sink_format=args.sink_format,
        sink_options=options,
        target_option=target_option,
        catalog=args.catalog,
        mode=args.mode,
        partition_overwrite=args.partition_overwrite,
        time_rule=args.time_rule,
        join=JoinOptions(args.join_strategy, args.strict_keys, args.broadcast_max_bytes),
        strict_dates=args.strict_dates,
        publish=args.publish,
        staging_root=args.staging_root,
        timestamp_format=args.timestamp_format,
        allow_empty=args.allow_empty,
        instants=args.instants,
    )
    print(json.dumps(result.__dict__))
    return 0


if __name__ == "__main__":
    sys.exit(main())
