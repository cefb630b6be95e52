"""Inputs and targets stay whole: unreadable records, empty files, overlapping folders, file counts."""

import gzip
import os

import pytest

from callfacts import fixtures, scratch
from callfacts.operators.checks import StrictInputError, require_none
from callfacts.functions.rules import fact_rules
from callfacts.plans.job import JoinOptions, run
from callfacts.sinks.writer import SelfOverwriteError, guard_self_overwrite, qualified, write_table
from callfacts.sources import EmptyInputError, read_calls_csv, read_chats_json

from conftest import SF_SMALL

DATE = "2024-01-05"


def _calls(spark, *cells):
    root = scratch.fresh_folder(spark, "tests", "calls")
    lines = "\n".join(f"{i},1,{c},{c}" for i, c in enumerate(cells))
    folder = f"{root.removeprefix('file:')}/date={DATE}"
    os.makedirs(folder)
    with open(f"{folder}/part-0.csv", "w") as f:
        f.write(lines + "\n" if cells else "")
    return root


def _job(spark, **options):
    root = scratch.fresh_folder(spark, "tests", "job")
    given = dict(
        partition=DATE,
        calls_table=f"{root}/calls",
        chats_table=f"{root}/chats",
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        dim_table=fixtures.register_clients(spark, SF_SMALL),
    )
    return run(spark, **(given | options))


def test_ordinary_times_are_read_and_zoned_ones_are_not(spark):
    root = _calls(
        spark, "2024-01-05 10:00:00", "2024-01-05T10:00:00", "2024-01-05T10:05:00.5", "2024-01-05 10:00:00.123456",
        "2024-01-05T10:00:00Z", "2024-01-05 10:00:00+03:00", "soon", "",
    )
    rows = {r.id: r for r in read_calls_csv(spark, root, DATE, corrupt_column="raw").collect()}
    assert [str(rows[i].startAt) for i in range(4)] == [
        "2024-01-05 10:00:00", "2024-01-05 10:00:00", "2024-01-05 10:05:00.500000", "2024-01-05 10:00:00.123456",
    ]
    assert all(rows[i].startAt is None and rows[i].raw for i in (4, 5, 6))
    assert rows[7].startAt is None and rows[7].raw is None  # missing, not unreadable


def test_strict_job_refuses_unreadable_records(spark):
    root = _calls(spark, "2024-01-05 10:00:00", "2024-01-05T10:00:00Z")
    for options in (dict(join=JoinOptions(strict=True)), dict(strict_dates=True)):
        with pytest.raises(StrictInputError, match="startAt is unreadable .1 rows"):
            _job(spark, calls_root=root, **options)
    _job(spark, calls_root=root)


def test_one_message_object_is_unreadable_as_a_list_in_strict_mode(spark):
    chats = fixtures.struct_chat_folder(spark, SF_SMALL)
    with pytest.raises(StrictInputError, match="messages is unreadable"):
        _job(spark, chats_root=chats, join=JoinOptions(strict=True))
    raw = read_chats_json(spark, chats, corrupt_column="raw")
    assert raw.where("messages IS NULL AND raw IS NULL").count() == 0


def test_strict_checks_are_one_pass(spark):
    calls = read_calls_csv(spark, fixtures.call_folder(spark, SF_SMALL), corrupt_column="raw")
    sc = spark.sparkContext
    sc.setJobGroup("strict-pass", "strict-pass")
    try:
        require_none(calls, fact_rules(), what="calls")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("strict-pass")) <= 2  # one aggregate (AQE: its two stages)


def test_a_file_without_bytes_fails_before_any_write(spark):
    root = _calls(spark)
    target = scratch.fresh_folder(spark, "tests", "kept")
    write_table(spark.range(3), f"{target}/calls")
    with pytest.raises(EmptyInputError):
        _job(spark, calls_root=root, calls_table=f"{target}/calls")
    assert spark.read.parquet(f"{target}/calls").count() == 3
    _job(spark, calls_root=root, allow_empty=True)


def test_targets_must_differ_and_spare_the_dimension(spark):
    root = scratch.fresh_folder(spark, "tests", "targets")
    for a, b in ((f"{root}/t", f"{root}/t/"), (f"{root}/t", f"{root}/t/sub")):
        with pytest.raises(SelfOverwriteError, match="overlap"):
            _job(spark, calls_table=a, chats_table=b)
    spark.range(5).selectExpr("id", "'n' AS name").write.parquet(f"{root}/dim")
    spark.read.parquet(f"{root}/dim").createOrReplaceTempView("dim_guarded")
    with pytest.raises(SelfOverwriteError, match="dimension"):
        _job(spark, dim_table="dim_guarded", calls_table=f"{root}/dim")
    assert spark.read.parquet(f"{root}/dim").count() == 5
    with pytest.raises(SelfOverwriteError, match="three tables"):
        _job(spark, catalog=True, calls_table="same_t", chats_table="SAME_T")


def test_overwrite_guard_compares_whole_addresses(spark, tmp_path, monkeypatch):
    folder = tmp_path / "c2"
    spark.range(3).write.parquet(str(folder))
    relative = os.path.relpath(folder, os.getcwd())
    assert qualified(spark, relative) == qualified(spark, str(folder)) == qualified(spark, f"file:{folder}")
    df = spark.read.parquet(str(folder))
    for roots in (None, [str(folder)]):
        with pytest.raises(SelfOverwriteError):
            guard_self_overwrite(df, relative, roots)
    guard_self_overwrite(df, "s3a://stage/fact_call", ["s3a://raw/fact_call"])
    with pytest.raises(SelfOverwriteError):
        guard_self_overwrite(df, "s3a://raw/fact_call", ["s3a://raw/fact_call/"])


def test_partitioned_write_makes_few_files_and_cuts_a_large_date(spark, session_conf):
    calls = fixtures.calls_frame(spark, "/root/testdata/sf0.01").repartition(8)
    target = scratch.fresh_folder(spark, "tests", "by-date")
    dates = calls.select("date").distinct().count()
    write_table(calls, target, partition_by=["date"])
    assert len(spark.read.parquet(target).inputFiles()) <= 1.5 * dates
    assert spark.read.parquet(target).count() == calls.count()
    one = calls.selectExpr("id", "clientId", "DATE '2024-01-05' AS date")
    with session_conf(**{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}):
        write_table(one, target + "-one", partition_by=["date"])
    assert len(spark.read.parquet(target + "-one").inputFiles()) > 3


def test_a_stream_refuses_the_split(spark):
    from callfacts.streaming import start

    with pytest.raises(ValueError, match="cannot split"):
        start(
            spark, kind="calls", fact_root=fixtures.call_folder(spark, SF_SMALL), target="/nowhere", checkpoint="/nowhere",
            dim_table=fixtures.register_clients(spark, SF_SMALL), join=JoinOptions(strategy="split"),
        )


def _kept_table(spark, name, n=3):
    spark.range(n).selectExpr("id", "'x' AS clientId").write.mode("overwrite").saveAsTable(name)


@pytest.mark.parametrize("other", ["default.one_stg", "`default`.`one_stg`", "spark_catalog.default.one_stg", "ONE_stg"])
@pytest.mark.parametrize("publish", ["overwrite", "staged"])
def test_one_table_under_two_names_is_refused(spark, other, publish):
    _kept_table(spark, "one_stg")
    staging = scratch.fresh_folder(spark, "tests", "staging")
    with pytest.raises(SelfOverwriteError, match="three tables"):
        _job(spark, catalog=True, calls_table="one_stg", chats_table=other, publish=publish, staging_root=staging)
    assert spark.table("one_stg").count() == 3 and not os.path.exists(staging.removeprefix("file:"))


def test_a_catalog_target_over_the_dimension_or_the_facts_is_refused(spark):
    root = scratch.fresh_folder(spark, "tests", "located")
    spark.range(5).selectExpr("id", "'n' AS name").write.parquet(f"{root}/dim")
    spark.catalog.createTable("dim_located", path=f"{root}/dim", source="parquet")
    spark.catalog.createTable("calls_over_dim", path=f"{root}/dim", source="parquet")
    with pytest.raises(SelfOverwriteError, match="dimension"):
        _job(spark, catalog=True, dim_table="dim_located", calls_table="calls_over_dim", chats_table="chats_apart")
    assert spark.table("dim_located").count() == 5
    facts = _calls(spark, "2024-01-05 10:00:00")
    spark.sql(f"CREATE TABLE calls_over_facts (value STRING) USING text LOCATION '{facts}/date={DATE}'")
    with pytest.raises(SelfOverwriteError, match="facts"):
        _job(spark, catalog=True, calls_root=facts, calls_table="calls_over_facts", chats_table="chats_apart")
    assert read_calls_csv(spark, facts).count() == 1
    _kept_table(spark, "shared_a")
    at = spark.sql("DESCRIBE TABLE EXTENDED shared_a").where("col_name = 'Location'").first().data_type
    spark.catalog.createTable("shared_b", path=at, source="parquet")
    with pytest.raises(SelfOverwriteError, match="overlap"):
        _job(spark, catalog=True, calls_table="shared_a", chats_table="shared_b")
    assert spark.table("shared_a").count() == 3


NO_RECORDS = {
    "hidden file": {"part-0.csv": b"", "_meta": b"x" * 50},
    "blank lines": {"part-0.csv": b"\n\n"},
    "empty gzip": {"part-0.csv.gz": gzip.compress(b"")},
}


@pytest.mark.parametrize("files", NO_RECORDS.values(), ids=NO_RECORDS)
def test_input_without_a_record_leaves_the_targets(spark, files):
    root = scratch.fresh_folder(spark, "tests", "empty")
    folder = f"{root.removeprefix('file:')}/date={DATE}"
    os.makedirs(folder)
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    target = scratch.fresh_folder(spark, "tests", "kept")
    write_table(spark.range(3), f"{target}/calls")
    for options in (dict(calls_root=root), dict(chats_root=root)):
        with pytest.raises(EmptyInputError, match="no data"):
            _job(spark, calls_table=f"{target}/calls", **options)
        assert spark.read.parquet(f"{target}/calls").count() == 3


def test_dynamic_overwrite_of_a_table_makes_few_files(spark):
    calls = fixtures.calls_frame(spark, "/root/testdata/sf0.01").repartition(8)
    dates = calls.select("date").distinct().count()
    for _ in range(2):  # the first write makes the table, the second inserts into it
        write_table(calls, "few_files", catalog=True, partition_overwrite="dynamic")
        assert len(spark.table("few_files").inputFiles()) <= 1.5 * dates
    assert spark.table("few_files").count() == calls.count()
