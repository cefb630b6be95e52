"""Readers: declared schemas, partition folders, bad cells, the contract."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import fixtures, scratch
from callfacts import schemas as S
from callfacts.sources import partition_paths, read_calls_csv, read_chats_json, read_table, read_text

from conftest import SF_SMALL

D = dt.datetime


def _folder(spark, name):
    return scratch.fresh_folder(spark, "tests", name)


def _write_lines(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def test_partition_paths():
    assert partition_paths("/r/", None) == ["/r"]
    assert partition_paths("/r", "2024-01-05") == ["/r/date=2024-01-05/"]
    assert partition_paths("/r", ["a", "b"]) == ["/r/date=a/", "/r/date=b/"]
    with pytest.raises(ValueError):
        partition_paths("/r", [])


def test_csv_by_position_with_partition_column(spark):
    root = _folder(spark, "csv")
    _write_lines(spark, f"{root}/date=2024-01-05", ["1,010,2024-01-05 10:00:00.123456,2024-01-05 10:05:00.000000"])
    _write_lines(spark, f"{root}/date=2024-01-06", ["2,11,2024-01-06 10:00:00.000000,2024-01-06 10:01:00.000000"])
    one = read_calls_csv(spark, root, "2024-01-05")
    assert one.columns == ["id", "clientId", "startAt", "endAt", "date"]
    assert one.schema["startAt"].dataType == T.TimestampNTZType()
    assert one.schema["date"].dataType == T.DateType()
    r = one.collect()
    assert len(r) == 1 and r[0]["clientId"] == "010" and r[0]["startAt"] == D(2024, 1, 5, 10, 0, 0, 123456)
    assert r[0]["date"] == dt.date(2024, 1, 5)
    assert read_calls_csv(spark, root).count() == 2
    assert read_calls_csv(spark, root, ["2024-01-05", "2024-01-06"]).count() == 2


def test_timestamp_format_is_a_parameter(spark):
    root = _folder(spark, "csv-format")
    _write_lines(spark, f"{root}/date=2024-01-05", ["1,1,05.01.2024 10:00,05.01.2024 10:30"])
    r = read_calls_csv(spark, root, "2024-01-05", timestamp_format="dd.MM.yyyy HH:mm").first()
    assert (r["startAt"], r["endAt"]) == (D(2024, 1, 5, 10, 0), D(2024, 1, 5, 10, 30))


def test_header_line_is_skipped_and_columns_stay_positional(spark):
    root = _folder(spark, "csv-header")
    _write_lines(spark, f"{root}/date=2024-01-05", ["a,b,c,d", "1,7,2024-01-05 10:00:00.000000,2024-01-05 10:01:00.000000"])
    rows = read_calls_csv(spark, root, "2024-01-05", header=True).collect()
    assert len(rows) == 1 and rows[0]["clientId"] == "7"
    assert read_calls_csv(spark, root, "2024-01-05").count() == 2  # without: the header is a (bad) row


def test_missing_date_fails_before_anything_runs(spark):
    root = _folder(spark, "csv-missing")
    _write_lines(spark, f"{root}/date=2024-01-05", ["1,1,2024-01-05 10:00:00.000000,2024-01-05 10:05:00.000000"])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_calls_csv(spark, root, "1999-01-01")


def test_require_files(spark):
    import os

    from callfacts.sources import EmptyInputError, require_files

    root = _folder(spark, "csv-empty")
    _write_lines(spark, f"{root}/date=2024-01-05", ["1,1,2024-01-05 10:00:00.000000,2024-01-05 10:05:00.000000"])
    os.makedirs(f"{root}/date=2024-01-06")
    require_files(read_calls_csv(spark, root, "2024-01-05"), root, "2024-01-05")
    require_files(read_calls_csv(spark, root), root)
    with pytest.raises(EmptyInputError, match="2024-01-06"):
        require_files(read_calls_csv(spark, root, ["2024-01-05", "2024-01-06"]), root, ["2024-01-05", "2024-01-06"])
    only_empty = _folder(spark, "csv-all-empty")
    os.makedirs(f"{only_empty}/date=2024-01-06")
    with pytest.raises(EmptyInputError):
        require_files(read_calls_csv(spark, only_empty), only_empty)


def test_bad_cell_is_null_and_raw_line_kept(spark):
    root = _folder(spark, "csv-bad")
    line = "3,12,2024-01-05 10:00:00.000000,bad"
    _write_lines(spark, f"{root}/date=2024-01-05", [line])
    r = read_calls_csv(spark, root, "2024-01-05").first()
    assert r["endAt"] is None and r["startAt"] is not None
    r = read_calls_csv(spark, root, "2024-01-05", corrupt_column="_raw").first()
    assert r["endAt"] is None and r["_raw"] == line


def test_json_nested_messages(spark):
    root = _folder(spark, "json")
    lines = [
        '{"id":1,"clientId":"10","startAt":"2024-01-01 00:01:00.000000","endAt":"2024-01-01 00:03:00.000000",'
        '"messages":[{"id":0,"text":"hi, \\"you\\"\\nthere","sendAt":"01/01/2024"}],"extra":5}',
        '{"id":2,"clientId":"11","startAt":"2024-01-01 00:02:00.000000","endAt":null,"messages":null}',
    ]
    _write_lines(spark, f"{root}/date=2024-01-01", lines)
    df = read_chats_json(spark, root, "2024-01-01")
    assert df.columns == ["id", "clientId", "startAt", "endAt", "messages", "date"]
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["messages"][0]["text"] == 'hi, "you"\nthere'
    assert rows[2]["messages"] is None and rows[2]["endAt"] is None


def test_json_partial_results_and_single_object_messages(spark):
    from callfacts.operators import parse_message_times

    root = _folder(spark, "json-shapes")
    single = '{"id":1,"clientId":"10","messages":{"id":1,"text":"one","sendAt":"01/02/2024"}}'
    _write_lines(spark, f"{root}/date=2024-01-01", [single, '{"id":"abc","clientId":"11","messages":[]}'])
    rows = {r["clientId"]: r for r in read_chats_json(spark, root, "2024-01-01", corrupt_column="_raw").collect()}
    assert rows["10"]["messages"] is None and rows["10"]["_raw"] == single  # wrong shape: NULL, raw kept
    assert rows["11"]["id"] is None and rows["11"]["messages"] == []  # partial result: other fields kept
    struct_schema = T.StructType(S.CHAT_RAW.fields[:4] + [T.StructField("messages", S.MESSAGE_RAW)])
    chats = read_chats_json(spark, root, "2024-01-01", schema=struct_schema)
    m = parse_message_times(chats).where("clientId = '10'").first()["messages"]
    assert (m["text"], m["sendAt"]) == ("one", D(2024, 1, 2))


def test_text_lines(spark):
    path = _folder(spark, "text")
    _write_lines(spark, path, ["a", "b c", ""])
    assert sorted(r["value"] for r in read_text(spark, path).collect()) == ["", "a", "b c"]


def test_catalog_table_contract(spark):
    spark.range(3).select(F.col("id"), F.col("id").cast("string").alias("name"), F.lit(1).alias("x")).createOrReplaceTempView("t_ok")
    df = read_table(spark, "t_ok")
    assert df.columns == ["id", "name"]  # extra column dropped
    spark.range(3).select(F.col("id")).createOrReplaceTempView("t_missing")
    with pytest.raises(S.ContractError):
        read_table(spark, "t_missing")
    spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name")).createOrReplaceTempView("t_narrow")
    with pytest.raises(AnalysisException):
        read_table(spark, "t_narrow").collect()  # string -> bigint is not a widening


def test_contract_widens(spark):
    df = spark.range(2).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"))
    assert S.conform(df, S.CLIENT).schema["id"].dataType == T.LongType()


def test_roundtrip_equals_source(spark):
    """Parquet -> CSV / JSON folders -> declared-schema read: the same rows."""
    src = fixtures.calls_frame(spark, SF_SMALL)
    back = read_calls_csv(spark, fixtures.call_folder(spark, SF_SMALL))
    assert src.exceptAll(back).count() == 0 and back.exceptAll(src).count() == 0
    chats = fixtures.chats_frame(spark, SF_SMALL)
    back = read_chats_json(spark, fixtures.chat_folder(spark, SF_SMALL))
    assert chats.exceptAll(back.select(chats.columns)).count() == 0
    assert back.count() == chats.count() == 20
