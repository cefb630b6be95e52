"""Hours that clocks show twice or skip, instants, and the join against a bucketed dimension."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from callfacts import fixtures, scratch
from callfacts.functions import instant, later_utc, skipped, wall_to_utc
from callfacts.functions.times import repeat_lengths
from callfacts.operators.enrich import BroadcastTooLarge, BucketsError, join_client, save_bucketed
from callfacts.operators.normalize import to_instants

from conftest import SF_SMALL


def _walls(zone):
    """Every quarter of an hour around clock changes and some plain days."""
    days = {"Europe/Moscow": ["1991-03-31", "1991-09-29", "2005-03-27", "2005-10-30", "2010-10-31", "2011-03-27", "2014-10-26", "2024-06-01"]}
    days = days.get(zone, ["2021-03-28", "2021-10-31", "2021-04-04", "2021-10-03", "2050-04-03", "2050-10-02", "2024-06-01"])
    out = []
    for d in days:
        start = dt.datetime.fromisoformat(d) - dt.timedelta(hours=2)
        out += [start + dt.timedelta(minutes=15 * k) for k in range(32)]
    return out


@pytest.mark.parametrize("zone", ["Europe/Moscow", "Europe/Berlin", "Australia/Lord_Howe"])
def test_repeated_and_skipped_hours_match_zoneinfo(spark, zone):
    walls = _walls(zone)
    df = spark.createDataFrame([(w,) for w in walls], "t timestamp_ntz")
    got = df.select(
        "t", wall_to_utc("t", zone).alias("early"), wall_to_utc("t", zone, "later").alias("late"),
        wall_to_utc("t", zone, "null").alias("sure"), later_utc("t", zone).alias("second"), skipped("t", zone).alias("gap"),
    ).collect()
    utc = lambda w, fold: w.replace(tzinfo=ZoneInfo(zone), fold=fold).astimezone(dt.timezone.utc).replace(tzinfo=None)
    back = lambda u: u.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    kinds = set()
    for r in got:
        a, b = utc(r.t, 0), utc(r.t, 1)
        gap = back(a) != r.t
        twice = a != b and not gap
        kinds.add("gap" if gap else "twice" if twice else "plain")
        assert r.early == a and r.gap == gap
        assert r.late == (b if twice else a) and r.second == (b if twice else None)
        assert r.sure == (None if twice else a)
    assert kinds == {"gap", "twice", "plain"}


def test_lengths_of_repeated_hours_come_from_the_zone(spark):
    assert 3600 in repeat_lengths("Europe/Moscow") and 1800 in repeat_lengths("Australia/Lord_Howe")
    assert repeat_lengths("UTC") == []
    with pytest.raises(ValueError, match="repeated is one of"):
        wall_to_utc("t", repeated="both")


@pytest.mark.parametrize("session", ["UTC", "America/Los_Angeles", "Australia/Lord_Howe"])
def test_instants_do_not_depend_on_the_session(spark, session_conf, session):
    times = ["1969-12-31 23:59:59.999999", "2024-03-10 02:30:00.5", "2024-11-03 01:30:00", "0001-01-01 00:00:00", "9999-12-31 23:59:59"]
    with session_conf(**{"spark.sql.session.timeZone": session}):
        df = spark.createDataFrame([(t,) for t in times] + [(None,)], "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
        got = [r[0] for r in df.select(F.unix_micros(instant("t"))).collect()]
        for s, micros in zip(times, got):
            t = dt.datetime.fromisoformat(s)
            assert micros == (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert got[-1] is None
        rows = df.select("t", F.array(F.struct(F.col("t").alias("sendAt"), F.lit("x").alias("text"))).alias("messages"), F.struct("t").alias("one"))
        schema = to_instants(rows).schema.simpleString()
        assert schema == "struct<t:timestamp,messages:array<struct<sendAt:timestamp,text:string>>,one:struct<t:timestamp>>"


@pytest.fixture(scope="module")
def bucketed(spark):
    return spark.table(save_bucketed(fixtures.clients_frame(spark, SF_SMALL), "dim_bucketed_test"))


def test_a_bucketed_table_is_saved_again_in_another_place(spark):
    for n in (3, 5):
        path = scratch.fresh_folder(spark, "tests", "buckets")
        table = save_bucketed(spark.range(n).selectExpr("id", "'n' AS name"), "dim_saved_twice", path=path)
        assert spark.table(table).count() == spark.read.parquet(path).count() == n


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("hot_key_rows", [1, 20, 10**6])
def test_bucketed_join_equals_the_broadcast_join(spark, bucketed, hot_key_rows):
    dim = fixtures.clients_frame(spark, SF_SMALL)
    for calls in (fixtures.calls_frame(spark, SF_SMALL), fixtures.dirty_calls_frame(spark, SF_SMALL)):
        got = join_client(calls, bucketed, strategy="bucketed", hot_key_rows=hot_key_rows)
        assert _rows(got) == _rows(join_client(calls, dim, strategy="broadcast"))
        kept = join_client(calls, bucketed, strategy="bucketed", hot_key_rows=hot_key_rows, keep_unmatched="found")
        assert _rows(kept) == _rows(join_client(calls, dim, strategy="broadcast", keep_unmatched="found"))


def test_bucketed_join_never_shuffles_the_dimension(spark, bucketed):
    calls = fixtures.calls_frame(spark, SF_SMALL)
    joined = join_client(calls, bucketed, strategy="bucketed", hot_key_rows=20)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    merge = plan[plan.index("SortMergeJoin") : plan.index("BroadcastHashJoin", plan.index("Bucketed: true"))]
    dimension = merge[merge.index("_client_key#", merge.index("Exchange hashpartitioning")) :]
    assert "Bucketed: true" in dimension and dimension.count("Exchange hashpartitioning") == 0
    assert plan.count("Exchange hashpartitioning") == 1  # the facts that are not hot


def test_a_hot_client_of_a_bucketed_join_is_not_shuffled(spark, bucketed):
    hot = spark.range(3000).selectExpr("id", "CAST(CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS STRING) AS clientId")
    joined = join_client(hot, bucketed, strategy="bucketed", hot_key_rows=500)
    assert joined.count() == join_client(hot, bucketed, strategy="broadcast").count()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_refuses_what_it_cannot_keep(spark, bucketed, session_conf):
    calls = fixtures.calls_frame(spark, SF_SMALL)
    with pytest.raises(BucketsError):
        join_client(calls, fixtures.clients_frame(spark, SF_SMALL), strategy="bucketed")
    with session_conf(**{"spark.sql.shuffle.partitions": "64"}):  # more than the buckets: they still decide
        many = join_client(calls, bucketed, strategy="bucketed")
        assert many._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    with pytest.raises(BroadcastTooLarge, match="hot keys"):
        join_client(calls, bucketed, strategy="bucketed", hot_key_rows=1, broadcast_max_bytes=100)
