"""The warehouse sink: settings, versions, failures."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from callfacts import scratch
from callfacts.sinks import connector_options, write_table
from callfacts.sinks.staged_source import Folder, SinkSettingsError, StagedTable


@pytest.fixture
def options(spark):
    spark.dataSource.register(StagedTable)
    root = scratch.fresh_folder(spark, "tests", "warehouse")
    return connector_options({"host": "h", "user": "u", "db": "d", "password": "secret", "stagingFsUrl": root})


def _write(df, options, mode="overwrite", table="t"):
    write_table(df, table, fmt="callfacts_staged", mode=mode, options=options, target_option="table")


def _read(spark, options, table="t"):
    return spark.read.format("callfacts_staged").options(**options, table=table).load()


def _files(options, pattern):
    return glob.glob(options["staging_fs_url"].removeprefix("file:") + "/" + pattern, recursive=True)


def test_overwrite_and_append(spark, options):
    _write(spark.range(10), options)
    _write(spark.range(4), options)
    assert sorted(r.id for r in _read(spark, options).collect()) == [0, 1, 2, 3]
    _write(spark.range(4, 6).repartition(3), options, mode="append")
    assert sorted(r.id for r in _read(spark, options).collect()) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="the table has"):
        _write(spark.range(1).selectExpr("'x' AS id"), options, mode="append")
    assert _read(spark, options).count() == 6
    _write(spark.range(3).where("id < 0"), options)
    assert _read(spark, options).count() == 0 and _read(spark, options).columns == ["id"]
    _write(spark.range(2), options, table="other")
    assert _read(spark, options).count() == 0 and _read(spark, options, "other").count() == 2


def test_nested_times_and_nulls_come_back(spark, options):
    df = spark.sql(
        "SELECT 1L AS id, TIMESTAMP_NTZ'2024-01-05 10:00:00.5' AS t, array(named_struct('a', 1L, 'b', CAST(NULL AS STRING))) AS m "
        "UNION ALL SELECT NULL, NULL, NULL"
    )
    _write(df, options)
    got = _read(spark, options)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def test_a_failed_task_leaves_the_table_and_no_files(spark, options):
    _write(spark.range(5), options)
    before = _files(options, "**/*.parquet")
    late = F.when(F.col("id") == 999, F.raise_error(F.lit("boom"))).otherwise(F.col("id"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="boom"):
            _write(spark.range(0, 1000, 1, 4).select(late.alias("id")), options, mode=mode)
        assert sorted(r.id for r in _read(spark, options).collect()) == [0, 1, 2, 3, 4]
        assert set(before) <= set(_files(options, "**/*.parquet"))
    before = set(_files(options, "**/*.parquet"))
    with pytest.raises(Exception, match="boom"):  # one task: nothing else is at work when the write is aborted
        _write(spark.range(0, 1000, 1, 1).select(late.alias("id")), options)
    assert set(_files(options, "**/*.parquet")) <= before


def test_a_failed_commit_leaves_the_table(spark, options, monkeypatch):
    _write(spark.range(5), options)
    folder = Folder({**options, "table": "t"})
    draft = f"{folder.base}/versions/.half"
    with open(draft, "w") as f:  # a commit that died before its move
        f.write('{"number": 2, "sch')
    assert folder.current()["number"] == 1 and _read(spark, options).count() == 5
    _write(spark.range(6), options)
    assert _read(spark, options).count() == 6


def test_settings_are_checked_and_never_stored(spark, options):
    with pytest.raises(Exception, match="option 'user' is missing; option 'password' is missing"):
        _write(spark.range(1), {k: v for k, v in options.items() if k not in ("user", "password")})
    with pytest.raises(Exception, match="there is no table"):
        _read(spark, options, "nothing").count()
    with pytest.raises(SinkSettingsError, match="not a name"):
        Folder({**options, "table": "../x"})
    _write(spark.range(1), options)
    for path in _files(options, "**/*"):
        if os.path.isfile(path):
            with open(path, "rb") as f:
                assert b"secret" not in f.read()
