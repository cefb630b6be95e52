"""Sinks (modes, naming, connector options, partition overwrite) and the job."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from callfacts import fixtures, scratch
from callfacts.plans.job import run
from callfacts.sinks import connector_options, missing_settings, target_name, write_table

from conftest import SF_SMALL


def _folder(spark, name):
    return scratch.fresh_folder(spark, "tests", name)


def test_save_modes(spark):
    t = _folder(spark, "modes")
    df = spark.range(5)
    write_table(df, t)
    write_table(df, t, mode="append")
    assert spark.read.parquet(t).count() == 10
    write_table(df, t, mode="ignore")
    assert spark.read.parquet(t).count() == 10
    with pytest.raises(AnalysisException):
        write_table(df, t, mode="error")
    write_table(spark.range(2), t, mode="overwrite")
    assert spark.read.parquet(t).count() == 2
    with pytest.raises(ValueError):
        write_table(df, t, mode="upsert")


def test_target_as_option_and_other_formats(spark):
    t = _folder(spark, "opt")
    write_table(spark.range(3), t, fmt="json", target_option="path")
    assert spark.read.json(t).count() == 3


def test_missing_connector_settings_are_all_reported():
    assert missing_settings({"host": "h", "db": "d"}) == [
        "sink setting 'user' is missing",
        "sink setting 'password' is missing",
        "sink setting 'stagingFsUrl' is missing",
    ]
    with pytest.raises(ValueError, match="'user' is missing; sink setting 'password' is missing"):
        connector_options({"host": "h", "db": "d", "stagingFsUrl": "s"})
    opts = connector_options({"host": "h", "user": "u", "db": "d", "password": "p", "stagingFsUrl": "s"})
    assert opts == {"host": "h", "user": "u", "db": "d", "password": "p", "staging_fs_url": "s"}


def test_target_name():
    assert target_name("calls", "_stg") == "calls_stg"


def _by_date(spark, dates):
    return spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "id long, date string").withColumn(
        "date", F.col("date").cast("date")
    )


@pytest.mark.parametrize("mode, expect", [(None, {"2024-01-02"}), ("static", {"2024-01-02"}), ("dynamic", {"2024-01-01", "2024-01-02"})])
def test_two_dates_written_in_turn(spark, mode, expect):
    t = _folder(spark, f"dates-{mode}")
    write_table(_by_date(spark, ["2024-01-01"]), t, partition_overwrite=mode)
    write_table(_by_date(spark, ["2024-01-02"]), t, partition_overwrite=mode)
    got = {str(r["date"]) for r in spark.read.parquet(t).collect()}
    assert got == expect


def _run(spark, root, partition, **kw):
    return run(
        spark,
        partition=partition,
        calls_table=f"{root}/calls",
        chats_table=f"{root}/chats",
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        dim_table=fixtures.register_clients(spark, SF_SMALL),
        **kw,
    )


def test_job_one_date(spark):
    root = _folder(spark, "job-one")
    res = _run(spark, root, "2024-01-05")
    calls = spark.read.parquet(res.calls_table)
    chats = spark.read.parquet(res.chats_table)
    expect_calls = fixtures.calls_frame(spark, SF_SMALL).where("date = DATE'2024-01-05'").count()
    expect_chats = fixtures.chats_frame(spark, SF_SMALL).where("date = DATE'2024-01-05'").count()
    assert calls.count() == expect_calls > 0
    assert chats.count() == expect_chats > 0
    assert calls.columns == ["id", "clientId", "startAt", "endAt", "name"]
    assert chats.columns == ["id", "clientId", "startAt", "endAt", "messages", "name"]
    assert chats.schema["messages"].dataType.elementType["sendAt"].dataType.simpleString() == "timestamp_ntz"
    assert res.join_strategy == "broadcast"


def test_job_missing_date_leaves_targets_untouched(spark):
    root = _folder(spark, "job-missing")
    _run(spark, root, "2024-01-05")
    before = spark.read.parquet(f"{root}/calls").count()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        _run(spark, root, "1999-01-01")
    assert spark.read.parquet(f"{root}/calls").count() == before


def test_job_empty_date_folder_fails_and_leaves_targets_untouched(spark):
    import os

    from callfacts.sources import EmptyInputError

    root = _folder(spark, "job-empty")
    _run(spark, root, "2024-01-05")
    before = spark.read.parquet(f"{root}/calls").count()
    empty = _folder(spark, "empty-calls")
    os.makedirs(f"{empty}/date=2024-01-05")  # the folder exists, no data files
    with pytest.raises(EmptyInputError, match="no data"):
        run(
            spark,
            partition="2024-01-05",
            calls_table=f"{root}/calls",
            chats_table=f"{root}/chats",
            calls_root=empty,
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
            dim_table=fixtures.register_clients(spark, SF_SMALL),
        )
    assert spark.read.parquet(f"{root}/calls").count() == before


def test_job_rerun_with_dynamic_partition_overwrite_keeps_other_dates(spark):
    root = _folder(spark, "job-dynamic")
    _run(spark, root, "2024-01-05", partition_overwrite="dynamic")
    _run(spark, root, "2024-01-06", partition_overwrite="dynamic")
    _run(spark, root, "2024-01-06", partition_overwrite="dynamic")  # rerun: idempotent
    calls = spark.read.parquet(f"{root}/calls")
    expect = fixtures.calls_frame(spark, SF_SMALL).where("date IN (DATE'2024-01-05', DATE'2024-01-06')").count()
    assert calls.count() == expect
    assert {str(r[0]) for r in calls.select("date").distinct().collect()} == {"2024-01-05", "2024-01-06"}


def test_strict_job_fails_before_touching_the_targets(spark):
    from callfacts.operators.checks import StrictInputError
    from callfacts.plans.job import JoinOptions

    root = _folder(spark, "job-strict")
    _run(spark, root, "2024-01-05")
    before = spark.read.parquet(f"{root}/calls").count()
    dirty = _folder(spark, "dirty-calls")
    spark.createDataFrame([("1,xx,2024-01-05 10:00:00.000000,2024-01-05 10:01:00.000000",)], "value string").write.text(
        f"{dirty}/date=2024-01-05"
    )
    with pytest.raises(StrictInputError, match="clientId='xx'"):
        run(
            spark,
            partition="2024-01-05",
            calls_table=f"{root}/calls",
            chats_table=f"{root}/chats",
            calls_root=dirty,
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
            dim_table=fixtures.register_clients(spark, SF_SMALL),
            join=JoinOptions(strict=True),
        )
    assert spark.read.parquet(f"{root}/calls").count() == before  # old target intact
    _run(spark, root, "2024-01-05", join=JoinOptions(strict=True), strict_dates=True)  # clean input passes


def test_job_fixed_offset_rule(spark):
    zone = _folder(spark, "job-zone")
    fixed = _folder(spark, "job-fixed")
    _run(spark, zone, "2024-01-05")
    _run(spark, fixed, "2024-01-05", time_rule="fixed")
    a = spark.read.parquet(f"{zone}/calls")
    b = spark.read.parquet(f"{fixed}/calls")
    assert a.exceptAll(b).count() == 0  # Moscow was UTC+3 all of 2024


def test_job_arguments_are_keyword_only(spark):
    with pytest.raises(TypeError):
        run(spark, "2024-01-05", "calls", "chats")  # noqa


def test_command_line(spark, capsys):
    from callfacts.__main__ import main, parser

    root = _folder(spark, "cli")
    fixtures.register_clients(spark, SF_SMALL)
    rc = main(
        [
            "--partition", "2024-01-05",
            "--callsTable", f"{root}/calls",
            "--chatsTable", f"{root}/chats",
            "--calls-root", fixtures.call_folder(spark, SF_SMALL),
            "--chats-root", fixtures.chat_folder(spark, SF_SMALL),
            "--target-option", "path",
        ]
    )
    assert rc == 0
    assert f'"calls_table": "{root}/calls"' in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/calls").count() > 0
    args = parser().parse_args(["-p", "2024-01-05", "--tableSuffix", "_stg"])
    assert args.table_suffix == "_stg" and args.calls_table is None
    with pytest.raises(SystemExit):
        parser().parse_args(["--partition", "2024-01-05"])  # no targets


def test_catalog_tables_round_trip(spark):
    from callfacts.sources import read_table

    clients = fixtures.clients_frame(spark, SF_SMALL)
    write_table(clients, "dim_client_saved", catalog=True)
    write_table(clients, "dim_client_saved", catalog=True, mode="append")
    got = read_table(spark, "dim_client_saved")
    assert got.columns == ["id", "name"] and got.count() == 2 * clients.count()
    write_table(clients, "dim_client_saved", catalog=True)  # overwrite
    assert read_table(spark, "dim_client_saved").count() == clients.count()


def test_job_refuses_to_overwrite_its_own_input(spark):
    from callfacts.sinks import SelfOverwriteError

    calls_root = fixtures.call_folder(spark, SF_SMALL)
    with pytest.raises(SelfOverwriteError):
        _run_paths(spark, calls_root + "/date=2024-01-05", _folder(spark, "chats-elsewhere"))
    assert read_calls_csv_count(spark, calls_root) == 1000


def _run_paths(spark, calls_t, chats_t):
    return run(
        spark,
        partition="2024-01-05",
        calls_table=calls_t,
        chats_table=chats_t,
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        dim_table=fixtures.register_clients(spark, SF_SMALL),
    )


def read_calls_csv_count(spark, root):
    from callfacts.sources import read_calls_csv

    return read_calls_csv(spark, root).count()


def test_catalog_dynamic_partition_overwrite_keeps_other_dates(spark):
    write_table(_by_date(spark, ["2024-01-01"]), "t_dyn_dates", catalog=True, partition_overwrite="dynamic")
    write_table(_by_date(spark, ["2024-01-02"]), "t_dyn_dates", catalog=True, partition_overwrite="dynamic")
    write_table(_by_date(spark, ["2024-01-02", "2024-01-02"]), "t_dyn_dates", catalog=True, partition_overwrite="dynamic")
    rows = spark.table("t_dyn_dates").collect()
    assert sorted(str(r["date"]) for r in rows) == ["2024-01-01", "2024-01-02", "2024-01-02"]
    write_table(_by_date(spark, ["2024-01-03"]), "t_dyn_dates", catalog=True, partition_overwrite="static")
    assert [str(r["date"]) for r in spark.table("t_dyn_dates").collect()] == ["2024-01-03"]


def test_job_into_catalog_tables(spark):
    fixtures.register_clients(spark, SF_SMALL)
    res = _run_tables(spark, "calls_stg_cat", "chats_stg_cat")
    assert spark.read.table(res.calls_table).count() > 0
    assert spark.read.table(res.chats_table).count() > 0


def _run_tables(spark, calls, chats):
    return run(
        spark,
        partition="2024-01-05",
        calls_table=calls,
        chats_table=chats,
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        dim_table=fixtures.register_clients(spark, SF_SMALL),
        catalog=True,
    )


def test_never_overwrites_a_path_being_read(spark):
    from callfacts.sinks import SelfOverwriteError

    t = _folder(spark, "self-overwrite")
    write_table(spark.range(3), t)
    with pytest.raises(SelfOverwriteError):
        write_table(spark.read.parquet(t), t, mode="overwrite")
    with pytest.raises(SelfOverwriteError):
        write_table(spark.read.parquet(t), "file://" + t, mode="overwrite", partition_overwrite="dynamic")
    with pytest.raises(SelfOverwriteError):  # the parent of the folder being read
        write_table(spark.read.parquet(t), t.rsplit("/", 1)[0], mode="overwrite")
    assert spark.read.parquet(t).count() == 3  # untouched
    write_table(spark.read.parquet(t), t, mode="append")  # appending is safe
    assert spark.read.parquet(t).count() == 6
    with pytest.raises(SelfOverwriteError):  # the caller names what it read: folders compared
        write_table(spark.range(1), t, mode="overwrite", read_roots=[t + "/part"])
    with pytest.raises(SelfOverwriteError):
        write_table(spark.range(1), t + "/sub", mode="overwrite", read_roots=[t])
    other = _folder(spark, "self-overwrite-neighbour")
    write_table(spark.read.parquet(t), other, mode="overwrite")  # prefix of a name is not a parent
    assert spark.read.parquet(other).count() == 6


def test_command_line_warehouse_settings_are_checked_before_spark(tmp_path):
    import json

    from callfacts.__main__ import main

    settings = tmp_path / "sink.json"
    settings.write_text(json.dumps({"host": "h", "db": "d"}))
    args = ["-p", "2024-01-05", "--tableSuffix", "_stg", "--warehouse", "--sink-options-file", str(settings)]
    with pytest.raises(ValueError, match="'user' is missing; .*'password' is missing; .*'stagingFsUrl' is missing"):
        main(args)


def test_job_catalog_dynamic_overwrite_per_date(spark):
    fixtures.register_clients(spark, SF_SMALL)

    def job(date):
        return run(
            spark,
            partition=date,
            calls_table="calls_by_date",
            chats_table="chats_by_date",
            calls_root=fixtures.call_folder(spark, SF_SMALL),
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
            catalog=True,
            partition_overwrite="dynamic",
        )

    job("2024-01-05")
    job("2024-01-06")
    job("2024-01-06")  # rerun of one date: idempotent
    calls = spark.table("calls_by_date")
    expect = fixtures.calls_frame(spark, SF_SMALL).where("date IN (DATE'2024-01-05', DATE'2024-01-06')").count()
    assert calls.count() == expect


def test_staged_publish_swaps_all_tables_or_none(spark):
    from callfacts.sinks import publish_staged

    root = _folder(spark, "staged")
    first = publish_staged(spark, {"st_a": spark.range(3), "st_b": spark.range(4)}, staging_root=root)
    assert (spark.table("st_a").count(), spark.table("st_b").count()) == (3, 4)
    boom = spark.range(5).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        publish_staged(spark, {"st_a": spark.range(7), "st_b": boom}, staging_root=root)
    assert (spark.table("st_a").count(), spark.table("st_b").count()) == (3, 4)  # neither table moved
    publish_staged(spark, {"st_a": spark.range(8), "st_b": spark.range(9)}, staging_root=root)
    assert (spark.table("st_a").count(), spark.table("st_b").count()) == (8, 9)
    assert spark.read.parquet(first["st_a"]).count() == 3  # the old version stays readable
    with pytest.raises(ValueError, match="nothing was written"):
        publish_staged(spark, {"st_a": spark.range(1).selectExpr("'x' AS id")}, staging_root=root)
    assert spark.table("st_a").count() == 8


def test_job_staged_publish(spark):
    root = _folder(spark, "job-staged")
    fixtures.register_clients(spark, SF_SMALL)
    kw = dict(
        partition="2024-01-05",
        calls_table="calls_staged",
        chats_table="chats_staged",
        calls_root=fixtures.call_folder(spark, SF_SMALL),
        chats_root=fixtures.chat_folder(spark, SF_SMALL),
        catalog=True,
        publish="staged",
        staging_root=root,
    )
    run(spark, **kw)
    run(spark, **kw)  # a rerun publishes a newer version of the same rows
    expect = fixtures.calls_frame(spark, SF_SMALL).where("date = DATE'2024-01-05'").count()
    assert spark.table("calls_staged").count() == expect
    assert spark.table("chats_staged").count() > 0
    with pytest.raises(ValueError, match="staged publish needs"):
        run(spark, **{**kw, "catalog": False})
