"""Edge rows for the column expressions and row-level operators (FIXTURES §5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts import schemas as S
from callfacts.functions import numeric_key, parse_date_text, shift_hours, wall_to_utc
from callfacts.functions import rules as R
from callfacts.operators import chat_messages, parse_message_times, rewrite_nested, to_utc, violation_rows
from callfacts.operators.checks import passing, with_violations

D = dt.datetime


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def test_numeric_key_tolerant(spark):
    df = one_col(spark, ["10", "010", " 11 ", "xx", None, "-3"], T.StringType())
    got = [r[0] for r in df.select(numeric_key("v")).collect()]
    assert got == [10, 10, 11, None, None, -3]


def test_numeric_key_rejects_decimals_and_other_notations(spark):
    vals = ["+7", "\t8\n", "-0", "1.5", "1.0", "1e3", "0x10", "1_000", "9223372036854775808", "9223372036854775807"]
    got = [r[0] for r in one_col(spark, vals, T.StringType()).select(numeric_key("v")).collect()]
    assert got == [7, 8, 0, None, None, None, None, None, None, 9223372036854775807]


def test_numeric_key_strict_fails_on_text(spark):
    df = one_col(spark, ["10", "xx"], T.StringType())
    with pytest.raises(Exception, match="not a number"):
        df.select(numeric_key("v", strict=True)).collect()


def test_numeric_key_strict_passes_nulls(spark):
    df = one_col(spark, ["10", None], T.StringType())
    assert [r[0] for r in df.select(numeric_key("v", strict=True)).collect()] == [10, None]


def test_parse_date_text(spark):
    df = one_col(spark, ["09/21/2021", "zz", None, "13/45/2021"], T.StringType())
    got = [r[0] for r in df.select(parse_date_text("v")).collect()]
    assert got == [D(2021, 9, 21), None, None, None]


def test_parse_date_text_strict(spark, session_conf):
    df = one_col(spark, ["09/21/2021", "zz"], T.StringType())
    with session_conf(**{"spark.sql.ansi.enabled": "false"}):
        with pytest.raises(Exception, match="not in pattern"):
            df.select(parse_date_text("v", strict=True)).collect()


@pytest.mark.parametrize(
    "wall, utc",
    [
        (D(2012, 9, 21, 12), D(2012, 9, 21, 8)),  # Moscow at UTC+4
        (D(2021, 9, 21, 12), D(2021, 9, 21, 9)),  # UTC+3
        (D(2014, 10, 25, 12), D(2014, 10, 25, 8)),  # before the 2014-10-26 change
        (D(2014, 10, 27, 12), D(2014, 10, 27, 9)),  # after it
        (D(2010, 7, 1, 12), D(2010, 7, 1, 8)),  # summer time UTC+4
        (D(2010, 1, 15, 12), D(2010, 1, 15, 9)),  # winter time UTC+3
    ],
)
def test_wall_to_utc_by_zone_rules(spark, wall, utc):
    df = one_col(spark, [wall], T.TimestampNTZType())
    assert df.select(wall_to_utc("v")).first()[0] == utc


def test_fixed_offset_ignores_zone_history(spark):
    df = one_col(spark, [D(2012, 9, 21, 12), D(2021, 9, 21, 12)], T.TimestampNTZType())
    assert [r[0] for r in df.select(shift_hours("v")).collect()] == [D(2012, 9, 21, 9), D(2021, 9, 21, 9)]


def test_zone_and_fixed_rules_differ_on_old_dates(spark):
    df = spark.createDataFrame([(1, "1", D(2012, 9, 21, 12), D(2012, 9, 21, 13))], S.CALL)
    zone = to_utc(df, rule="zone").select("startAt", "endAt").first()
    fixed = to_utc(df, rule="fixed").select("startAt", "endAt").first()
    assert zone != fixed
    assert tuple(zone) == (D(2012, 9, 21, 8), D(2012, 9, 21, 9))


def test_to_utc_rejects_unknown_rule(spark):
    df = one_col(spark, [D(2021, 1, 1)], T.TimestampNTZType()).withColumnRenamed("v", "startAt")
    with pytest.raises(ValueError):
        to_utc(df, rule="nope", columns=("startAt",))


def _chats(spark):
    rows = [
        (1, "10", [(1, "a", "09/21/2021"), (2, "b", "zz")]),
        (2, "11", []),
        (3, "12", None),
    ]
    schema = T.StructType([S.CHAT_RAW["id"], S.CHAT_RAW["clientId"], S.CHAT_RAW["messages"]])
    return spark.createDataFrame(rows, schema)


def test_rewrite_list_keeps_empty_and_null(spark):
    out = {r["id"]: r["messages"] for r in parse_message_times(_chats(spark)).collect()}
    assert [(m.id, m.text, m.sendAt) for m in out[1]] == [(1, "a", D(2021, 9, 21)), (2, "b", None)]
    assert out[2] == []
    assert out[3] is None


def test_rewrite_struct(spark):
    df = _chats(spark).select("id", F.element_at("messages", 1).alias("m")).where("id = 1")
    m = rewrite_nested(df, "m", "sendAt", parse_date_text).first()["m"]
    assert (m.id, m.text, m.sendAt) == (1, "a", D(2021, 9, 21))


def test_rewrite_rejects_plain_column(spark):
    with pytest.raises(TypeError):
        rewrite_nested(_chats(spark), "clientId", "x", lambda c: c)


def test_explode_drops_empty_and_null_lists(spark):
    df = _chats(spark).withColumn("name", F.lit("n"))
    assert sorted(r["id"] for r in chat_messages(df).collect()) == [1, 1]
    kept = chat_messages(df, keep_empty=True).collect()
    assert sorted(r["id"] for r in kept) == [1, 1, 2, 3]


def test_chat_messages_parses_after_explode(spark):
    df = _chats(spark).withColumn("name", F.lit("n"))
    got = sorted((r["message_id"], r["sendAt"]) for r in chat_messages(df, send_at=parse_date_text).collect())
    assert got == [(1, D(2021, 9, 21)), (2, None)]


def test_all_failed_rules_are_listed_together(spark):
    rows = [
        (1, None, None, D(2024, 1, 1)),
        (2, "xx", D(2024, 1, 2), D(2024, 1, 1)),
        (3, "7", D(2024, 1, 1), D(2024, 1, 2)),
    ]
    df = spark.createDataFrame(rows, S.CALL)
    got = {r["id"]: r["violations"] for r in with_violations(df).collect()}
    assert got[1] == [R.KEY_MISSING, R.START_MISSING]
    assert got[2] == [R.KEY_NOT_NUMBER, R.END_BEFORE_START]
    assert got[3] == []
    assert violation_rows(df).count() == 4
    assert [r["id"] for r in passing(df).collect()] == [3]


def test_message_rule(spark):
    chats = _chats(spark).withColumns({"startAt": F.lit(D(2024, 1, 1)), "endAt": F.lit(D(2024, 1, 1))})
    got = {r["id"]: r["violations"] for r in with_violations(chats).collect()}
    assert got[1] == [R.MESSAGE_DATE_UNREADABLE]
    assert got[2] == [] and got[3] == []


def test_ambiguous_wall_time_takes_the_first_occurrence(spark):
    """Clocks going back repeat an hour; like Spark's own to_utc_timestamp,
    the earlier (summer) offset is used.  (DuckDB's ICU takes the later one.)"""
    df = one_col(spark, [D(2010, 10, 31, 2, 30), D(2014, 10, 26, 1, 30)], T.TimestampNTZType())
    assert [r[0] for r in df.select(wall_to_utc("v")).collect()] == [D(2010, 10, 30, 22, 30), D(2014, 10, 25, 21, 30)]


def test_nonexistent_wall_time_moves_forward(spark):
    df = one_col(spark, [D(2010, 3, 28, 2, 30)], T.TimestampNTZType())
    assert df.select(wall_to_utc("v")).first()[0] == D(2010, 3, 27, 23, 30)


def test_zone_rule_equals_to_utc_timestamp_under_utc_session(spark, session_conf):
    """The reference's function, evaluated where it is unambiguous (UTC session)."""
    df = spark.range(0, 20000).select(
        (F.lit(D(1985, 1, 1)) + F.make_dt_interval(mins=(F.col("id") * 2741) % (45 * 365 * 24 * 60)))
        .cast("timestamp_ntz")
        .alias("v")
    )
    with session_conf(**{"spark.sql.session.timeZone": "UTC"}):
        ref = F.to_utc_timestamp(F.col("v").cast("timestamp"), "Europe/Moscow").cast("timestamp_ntz")
        assert df.where(wall_to_utc("v") != ref).count() == 0
