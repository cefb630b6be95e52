"""Every registered query against its DuckDB oracle at sf0.01: names, types,
row count and an order-insensitive value hash."""

import pytest
from conftest import SF_ORACLE
from oracle import arrow_equal, compare, duck

import __spark_entry__ as entry
from callfacts.workloads import ORACLE_SQL as SQL
from callfacts.workloads import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    c = compare(df, con, SQL[name])
    assert c.ok, f"{name}: {c}"
    assert c.rows_spark > 0
    assert arrow_equal(df, con, SQL[name]), f"{name}: Arrow types or values differ"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["target", "id", "clientId", "startAt", "endAt", "name", "message_id", "text", "sendAt"]
    assert {r.target for r in df.select("target").distinct().collect()} == {"calls_stg", "chats_stg"}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow", "America/Los_Angeles"])
def test_results_do_not_depend_on_session_zone(spark, con, session_conf, zone):
    with session_conf(**{"spark.sql.session.timeZone": zone}):
        for name in ("client_calls", "times_zone_rule", "message_times"):
            c = compare(QUERIES[name](spark, SF_ORACLE), con, SQL[name])
            assert c.ok, f"{name} under {zone}: {c}"


def test_results_do_not_depend_on_ansi_mode(spark, con, session_conf):
    with session_conf(**{"spark.sql.ansi.enabled": "false"}):
        for name in ("join_dirty_keys", "call_rule_violations", "message_times"):
            c = compare(QUERIES[name](spark, SF_ORACLE), con, SQL[name])
            assert c.ok, f"{name} with ANSI off: {c}"


@pytest.mark.parametrize("strategy", ["broadcast", "hash", "shuffle", "split"])
def test_every_join_tier_matches_the_oracle(spark, con, session_conf, strategy):
    """The flagship and the exploded chats through each tier, against the same SQL."""
    from callfacts import fixtures
    from callfacts.plans.job import JoinOptions, enrich_calls, enrich_chat_messages
    from callfacts.sources import read_calls_csv, read_chats_json, read_table

    join = JoinOptions(strategy=strategy, hot_key_rows=50)
    dim = read_table(spark, fixtures.register_clients(spark, SF_ORACLE))
    with session_conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        calls = enrich_calls(read_calls_csv(spark, fixtures.call_folder(spark, SF_ORACLE)), dim, join=join)
        assert arrow_equal(calls, con, SQL["client_calls"])
        chats = enrich_chat_messages(read_chats_json(spark, fixtures.chat_folder(spark, SF_ORACLE)), dim, join=join)
        assert arrow_equal(chats, con, SQL["client_chat_messages"])
