"""The stream form of the job: each date folder is processed once, late folders later."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from callfacts import fixtures, scratch
from callfacts.plans.job import JoinOptions
from callfacts.sources.readers import TIMESTAMP_NTZ_FORMAT
from callfacts.streaming import fact_stream, run_available_now, start

from conftest import SF_SMALL


def _write_dates(spark, root, dates):
    calls = fixtures.calls_frame(spark, SF_SMALL).where(F.col("date").isin(*dates))
    (
        calls.write.mode("append")
        .partitionBy("date")
        .option("header", "false")
        .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
        .csv(root)
    )
    return calls.count()


def test_new_date_folders_are_processed_once(spark):
    fixtures.register_clients(spark, SF_SMALL)
    base = scratch.fresh_folder(spark, "tests", "stream")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    n1 = _write_dates(spark, src, ["2024-01-01", "2024-01-02"])

    def run_once():
        run_available_now(start(spark, kind="calls", fact_root=src, target=out, checkpoint=ckpt), timeout_s=300)

    run_once()
    assert spark.read.parquet(out).count() == n1
    run_once()  # nothing new: nothing appended
    assert spark.read.parquet(out).count() == n1
    n2 = _write_dates(spark, src, ["2024-01-03"])
    run_once()
    got = spark.read.parquet(out)
    assert got.count() == n1 + n2
    assert {str(r[0]) for r in got.select("date").distinct().collect()} == {"2024-01-01", "2024-01-02", "2024-01-03"}


def test_chat_stream_parses_message_dates(spark):
    fixtures.register_clients(spark, SF_SMALL)
    base = scratch.fresh_folder(spark, "tests", "stream-chats")
    q = start(
        spark,
        kind="chats",
        fact_root=fixtures.chat_folder(spark, SF_SMALL),
        target=f"{base}/out",
        checkpoint=f"{base}/ckpt",
        join=JoinOptions(strategy="shuffle"),
    )
    q.awaitTermination()
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        q.explain()
    assert "AdaptiveSparkPlan" in plan.getvalue() and "SortMergeJoin" in plan.getvalue()  # AQE per micro-batch
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == 20
    assert got.schema["messages"].dataType.elementType["sendAt"].dataType.simpleString() == "timestamp_ntz"


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        fact_stream(spark, "emails", "/nowhere")


def test_bounded_micro_batches_give_the_same_rows(spark):
    fixtures.register_clients(spark, SF_SMALL)
    base = scratch.fresh_folder(spark, "tests", "stream-batches")
    q = start(
        spark,
        kind="calls",
        fact_root=fixtures.call_folder(spark, SF_SMALL),
        target=f"{base}/out",
        checkpoint=f"{base}/ckpt",
        max_files_per_trigger=4,
    )
    run_available_now(q, timeout_s=300)
    assert len(q.recentProgress) > 1  # the 30 date folders came in several batches
    assert spark.read.parquet(f"{base}/out").count() == 1000


def test_processing_time_trigger_runs_until_stopped(spark):
    fixtures.register_clients(spark, SF_SMALL)
    base = scratch.fresh_folder(spark, "tests", "stream-continuous")
    q = start(
        spark,
        kind="calls",
        fact_root=fixtures.call_folder(spark, SF_SMALL),
        target=f"{base}/out",
        checkpoint=f"{base}/ckpt",
        trigger="processing_time",
        processing_time="1 second",
    )
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(f"{base}/out").count() == 1000
