"""Run by test_skew_rehearsal in its own JVM (event log on): one client holds
a third of all calls; the dimension is past the broadcast bound, so ``auto``
picks a shuffled join.  Prints, from Spark's event log, how many shuffled rows
the busiest task of the join stage read."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from callfacts import fixtures  # noqa: E402
from callfacts.operators import choose_strategy, join_client  # noqa: E402
from callfacts.operators.enrich import client_side  # noqa: E402
from callfacts.sources import read_calls_csv  # noqa: E402


def main(sf_dir: str, mode: str = "aqe") -> None:
    """``aqe``: AQE skew handling on (shuffled tier, split at runtime);
    ``split``: skew handling off, so ``auto`` runs the exact hot-key split."""
    events = tempfile.mkdtemp(prefix="callfacts-skew-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", events)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        # AQE thresholds scaled down with the data (defaults: 256 MB, 5x, 64 MB)
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")  # (default 1 MB)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")  # honour the advisory size
        .config("spark.sql.adaptive.skewJoin.enabled", "true" if mode == "aqe" else "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    calls = read_calls_csv(spark, fixtures.call_folder(spark, sf_dir))
    hot = F.pmod(F.col("id"), F.lit(3)) == 0
    calls = calls.withColumn("clientId", F.when(hot, F.lit("7")).otherwise(F.col("clientId")))
    dim = fixtures.clients_frame(spark, sf_dir)
    total = calls.count()
    hot_rows = calls.where(hot).count()
    limits = dict(broadcast_max_bytes=1024, hash_partition_max_bytes=1 << 20)
    strategy = choose_strategy(client_side(dim), "auto", **limits)
    spark.sparkContext.setJobDescription("rehearsal")
    joined = join_client(calls, dim, strategy="auto", hot_key_rows=10_000, **limits)
    joined.write.format("noop").mode("overwrite").save()  # full rows through the join
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    owner, reads, written = {}, {}, 0
    for d, _, files in os.walk(events):
        for f in files:
            if f.startswith("."):
                continue
            for line in open(os.path.join(d, f)):
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    if (ev.get("Properties") or {}).get("spark.job.description") == "rehearsal":
                        for sid in ev.get("Stage IDs", []):
                            owner[sid] = True
                elif ev.get("Event") == "SparkListenerTaskEnd" and owner.get(ev.get("Stage ID")):
                    w = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                    written += w.get("Shuffle Records Written", 0)
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
                    nbytes = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                    reads.setdefault(ev["Stage ID"], []).append((m.get("Total Records Read", 0), nbytes))
    # the join stage is the one reading the most shuffled bytes
    join_stage = max(reads, key=lambda s: sum(b for _, b in reads[s]))
    tasks = reads[join_stage]
    print(
        json.dumps(
            {
                "strategy": strategy,
                "total": total,
                "hot_rows": hot_rows,
                "join_tasks": len(tasks),
                "join_stage_rows": sum(r for r, _ in tasks),
                "join_stage_bytes": sum(b for _, b in tasks),
                "max_task_bytes": max(b for _, b in tasks),
                "shuffled_records": written,
            }
        )
    )


if __name__ == "__main__":
    main(*sys.argv[1:3])
