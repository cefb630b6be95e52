"""Plan tests: join strategies, size checks, cache scope, partition pruning."""

import pytest
from pyspark.sql import functions as F

from callfacts import fixtures, scratch
from callfacts.operators import choose_strategy, join_client
from callfacts.operators.enrich import KEY, client_side
from callfacts.plans import cached, measure, plan_text
from callfacts.plans.job import JoinOptions, enrich_calls, run
from callfacts.sources import read_calls_csv

from conftest import SF_ORACLE, SF_SMALL


def persistent_rdds(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.fixture
def dim(spark):
    return fixtures.clients_frame(spark, SF_SMALL)


@pytest.fixture
def skewed_calls(spark):
    """Calls where one client holds a third of all rows, plus dirty keys."""
    calls = fixtures.calls_frame(spark, SF_SMALL)
    k = F.pmod(F.col("id"), F.lit(3))
    key = F.when(k == 0, F.lit("7")).when(F.col("id") % 11 == 1, F.lit("x")).otherwise(F.col("clientId"))
    return calls.withColumn("clientId", key)


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_measure_is_exact(spark, dim):
    size = measure(client_side(dim))
    assert size.rows == 150
    # key (8) + name slot (8) + null word (8) + 18-char name padded to 24
    assert size.bytes == 150 * (8 + 8 + 8 + 24)


def test_partition_measure_matches_the_real_shuffle(spark, dim):
    side = client_side(dim)
    size = measure(side, KEY, 8)
    assert (size.rows, size.bytes) == (150, 150 * 48)
    biggest = side.repartition(8, KEY).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert size.max_partition_bytes == biggest * 48


def test_hot_duplicate_key_in_the_dimension_avoids_the_hash_join(spark, dim, session_conf):
    hot = dim.withColumn("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")))
    small = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    with session_conf(**small):
        even, skewed = client_side(dim), client_side(hot)
        assert measure(skewed, KEY, 8).max_partition_bytes >= 50 * 48
        assert choose_strategy(even, "auto", 1000, hash_partition_max_bytes=1500) == "hash"
        assert choose_strategy(skewed, "auto", 1000, hash_partition_max_bytes=1500) == "shuffle"


def _jobs_in(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_measure_sees_a_dimension_rewritten_in_place(spark):
    from callfacts import scratch

    path = scratch.fresh_folder(spark, "tests", "dim") + "/dim.parquet"
    spark.range(10).selectExpr("id", "'n' AS name").write.parquet(path)
    assert choose_strategy(client_side(spark.read.parquet(path)), "auto", 1000) == "broadcast"
    spark.range(100_000).selectExpr("id", "'n' AS name").write.mode("overwrite").parquet(path)
    assert choose_strategy(client_side(spark.read.parquet(path)), "auto", 1000) != "broadcast"


def test_forced_broadcast_of_a_large_side_is_refused(spark, dim):
    from callfacts.operators.enrich import BroadcastTooLarge

    with pytest.raises(BroadcastTooLarge, match="bytes"):
        choose_strategy(client_side(dim), "broadcast", 10)


def test_split_has_no_cap_and_no_fallback(spark, dim, skewed_calls, session_conf):
    """Every hot key is salted, with a tiny broadcast bound and a list bound below the number of hot keys."""
    from callfacts.operators import enrich

    expected = join_client(skewed_calls, dim, strategy="broadcast")
    off = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with session_conf(**off):
        assert choose_strategy(client_side(dim), "auto", 10) == "split"
        got = join_client(skewed_calls, dim, strategy="auto", hot_key_rows=2, broadcast_max_bytes=10)
        assert same_rows(expected, got)
    keyed = skewed_calls.withColumn(KEY, F.col("clientId").try_cast("bigint"))
    every = enrich.hot_keys(keyed, 2)
    few = enrich.hot_keys(keyed, 2, list_rows=every.count() // 2)
    assert 0 < few.count() <= every.count() // 2
    top = keyed.groupBy(KEY).count().where(f"{KEY} IS NOT NULL").orderBy(F.desc("count")).first()[0]
    assert top in {r[0] for r in few.select(KEY).collect()}  # the hottest keys stay on the list


def test_parse_bytes():
    from callfacts.plans.sizing import parse_bytes

    assert parse_bytes("67108864b") == parse_bytes("64m") == parse_bytes("64MB") == 64 << 20
    assert parse_bytes("7") == 7 and parse_bytes("2kb") == 2048
    with pytest.raises(ValueError):
        parse_bytes("lots")


def test_auto_broadcasts_a_measured_small_dimension(spark, dim):
    assert choose_strategy(client_side(dim), "auto", 1 << 20) == "broadcast"
    calls = read_calls_csv(spark, fixtures.call_folder(spark, SF_ORACLE))
    plan = plan_text(enrich_calls(calls, fixtures.clients_frame(spark, SF_ORACLE)))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan  # the facts are never shuffled
    assert "ReadSchema: struct<id:bigint,clientId:string,startAt:timestamp_ntz,endAt:timestamp_ntz>" in plan


def test_auto_beyond_the_bound(spark, dim, session_conf):
    side = client_side(dim)  # 7,200 bytes measured
    small = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    with session_conf(**small):
        top8 = measure(side, KEY, 8).max_partition_bytes
        top16 = measure(side, KEY, 16).max_partition_bytes
        assert top16 < top8
        assert choose_strategy(side, "auto", 1000, hash_partition_max_bytes=top8) == "hash"
        assert choose_strategy(side, "auto", 1000, hash_partition_max_bytes=top16) == "shuffle"
        with session_conf(**{"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16"}):
            assert choose_strategy(side, "auto", 1000, hash_partition_max_bytes=max(top16, 1024)) == "hash"
    with session_conf(**{"spark.sql.shuffle.partitions": "8"}):  # coalescing may reach 64 MB
        assert choose_strategy(side, "auto", 1000, hash_partition_max_bytes=top8) == "shuffle"
    with session_conf(**{**small, "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1MB"}):
        assert choose_strategy(side, "auto", 1000, hash_partition_max_bytes=top8) == "shuffle"  # 1 MB floor
    with session_conf(**{"spark.sql.adaptive.skewJoin.enabled": "false"}):
        assert choose_strategy(side, "auto", 1000) == "split"
    with pytest.raises(ValueError):
        choose_strategy(side, "nope", 1)


def test_null_and_text_keys_are_filtered_before_the_shuffle(spark, dim, skewed_calls, session_conf):
    with session_conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_text(join_client(skewed_calls, dim, strategy="shuffle"))
    assert "SortMergeJoin" in plan
    # the key filter is applied in the scan stage, below the shuffle
    assert "isnotnull(try_cast(" in plan
    assert plan.index("isnotnull(try_cast(") < plan.index("(5) Exchange")


@pytest.mark.parametrize("strategy", ["hash", "shuffle", "split", "spark"])
def test_strategies_agree_with_broadcast_under_skew(spark, dim, skewed_calls, session_conf, strategy):
    expected = join_client(skewed_calls, dim, strategy="broadcast")
    with session_conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = join_client(skewed_calls, dim, strategy=strategy, hot_key_rows=50)
        assert same_rows(expected, got)
        assert got.count() == expected.count() > 0
        plan = plan_text(got)
        if strategy == "split":
            assert "SortMergeJoin" in plan and "_client_salt" in plan and "Union" not in plan
        if strategy == "hash":
            assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "Sort " not in plan


@pytest.mark.parametrize("strategy, join", [("shuffle", "SortMergeJoin"), ("hash", "ShuffledHashJoin")])
def test_shuffle_paths_never_broadcast_and_aqe_splits_the_hot_key(spark, dim, skewed_calls, session_conf, strategy, join):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    facts = skewed_calls.repartition(8)  # several map outputs, so a hot partition can be split
    with session_conf(**small):  # broadcast threshold left on: the hint must still win
        got = join_client(facts, dim, strategy=strategy)
        rows = got.collect()
        final = plan_text(got, "simple")
    assert len(rows) == join_client(skewed_calls, dim, strategy="broadcast").count()
    assert "isFinalPlan=true" in final
    assert f"{join}(skew=true)" in final
    assert "BroadcastHashJoin" not in final


def test_split_with_no_hot_keys_is_still_exact(spark, dim):
    calls = fixtures.calls_frame(spark, SF_SMALL)
    got = join_client(calls, dim, strategy="split", hot_key_rows=10**9)
    assert same_rows(got, join_client(calls, dim, strategy="broadcast"))


def test_cached_dimension_is_scanned_from_memory_and_released(spark):
    dim = fixtures.clients_frame(spark, SF_SMALL)
    calls = fixtures.calls_frame(spark, SF_SMALL)
    before = persistent_rdds(spark)
    with cached(dim) as d:
        plan = plan_text(join_client(calls, d, strategy="broadcast"))
        assert "InMemoryTableScan" in plan
        assert persistent_rdds(spark) == before + 1 or d.storageLevel.useMemory
    assert persistent_rdds(spark) == before
    assert not dim.storageLevel.useMemory


def test_partition_filter_reaches_the_listing(spark):
    df = read_calls_csv(spark, fixtures.call_folder(spark, SF_SMALL)).where(F.col("date") == "2024-01-05")
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(date" in plan


def test_job_releases_cache_when_a_write_fails(spark):
    fixtures.register_clients(spark, SF_SMALL)
    root = scratch.fresh_folder(spark, "tests", "job-fail")
    before = persistent_rdds(spark)
    with pytest.raises(Exception):
        run(
            spark,
            partition="2024-01-05",
            calls_table=f"{root}/calls",
            chats_table=f"{root}/chats",
            calls_root=fixtures.call_folder(spark, SF_SMALL),
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
            sink_format="no.such.format.DefaultSource",
        )
    assert persistent_rdds(spark) == before


def test_job_forced_strategies_give_equal_tables(spark):
    fixtures.register_clients(spark, SF_SMALL)
    out = {}
    for strategy in ("broadcast", "hash", "shuffle", "split"):
        root = scratch.fresh_folder(spark, "tests", f"job-{strategy}")
        res = run(
            spark,
            partition=["2024-01-01", "2024-01-02"],
            calls_table=f"{root}/calls",
            chats_table=f"{root}/chats",
            calls_root=fixtures.call_folder(spark, SF_SMALL),
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
            join=JoinOptions(strategy=strategy, hot_key_rows=5),
        )
        assert res.join_strategy == strategy
        out[strategy] = (spark.read.parquet(f"{root}/calls"), spark.read.parquet(f"{root}/chats"))
    for s in ("hash", "shuffle", "split"):
        assert same_rows(out[s][0], out["broadcast"][0])
        assert same_rows(out[s][1].drop("messages"), out["broadcast"][1].drop("messages"))


def test_one_date_lists_only_its_files(spark):
    root = fixtures.call_folder(spark, SF_SMALL)
    files = read_calls_csv(spark, root, "2024-01-05").inputFiles()
    assert files and all("/date=2024-01-05/" in f for f in files)
    assert len(read_calls_csv(spark, root).inputFiles()) > len(files)


def test_second_write_failing_keeps_the_first_and_releases_the_cache(spark):
    fixtures.register_clients(spark, SF_SMALL)
    root = scratch.fresh_folder(spark, "tests", "job-second-fails")
    blocker = f"{root}/blocker"
    spark.range(1).coalesce(1).write.parquet(blocker)  # a folder of files ...
    before = persistent_rdds(spark)
    with pytest.raises(Exception):
        run(
            spark,
            partition="2024-01-05",
            calls_table=f"{root}/calls",
            chats_table=f"{blocker}/_SUCCESS/chats",  # ... so a path below one of its files cannot be made
            calls_root=fixtures.call_folder(spark, SF_SMALL),
            chats_root=fixtures.chat_folder(spark, SF_SMALL),
        )
    assert persistent_rdds(spark) == before
    assert spark.read.parquet(f"{root}/calls").count() > 0  # calls were written first: no transaction


def test_chat_join_in_the_broadcast_tier_has_no_shuffle(spark):
    from callfacts.plans.job import enrich_chat_messages, enrich_chats
    from callfacts.sources import read_chats_json

    chats = read_chats_json(spark, fixtures.chat_folder(spark, SF_ORACLE))
    dim = fixtures.clients_frame(spark, SF_ORACLE)
    for df in (enrich_chats(chats, dim), enrich_chat_messages(chats, dim)):
        plan = plan_text(df)
        assert "BroadcastHashJoin" in plan
        assert "Exchange hashpartitioning" not in plan
