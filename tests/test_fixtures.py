"""The fixture bindings: chat records stay bounded however long a conversation is."""

from pyspark.sql import functions as F

from callfacts import fixtures, scratch

from conftest import SF_SMALL


def test_long_conversation_is_split_into_bounded_chats(spark):
    # derive a 168-turn conversation from conversation 0 of the given table
    conv = fixtures.table(spark, SF_SMALL, "conversations")
    first = conv.where("conv_id = 0")
    n = first.count()
    copies = first.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(20))))
    long = copies.select("conv_id", (F.col("turn") + F.col("k") * n).alias("turn"), "text")
    sf_dir = scratch.fresh_folder(spark, "tests", "sf-long")
    long.unionByName(conv.where("conv_id <> 0").select("conv_id", "turn", "text")).write.parquet(
        f"{sf_dir}/conversations.parquet"
    )
    chats = fixtures.chats_frame(spark, sf_dir)
    sizes = {r["id"]: r["n"] for r in chats.select("id", F.size("messages").alias("n")).collect()}
    assert max(sizes.values()) <= fixtures.CHAT_TURNS
    total = 21 * n
    blocks = -(-total // fixtures.CHAT_TURNS)
    assert [sizes[b] for b in range(blocks)] == [
        min(fixtures.CHAT_TURNS, total - b * fixtures.CHAT_TURNS) for b in range(blocks)
    ]
    assert sum(sizes.values()) == conv.count() - n + total  # no message lost


def test_chat_ids_of_large_conversation_ids_do_not_collide(spark):
    rows = [(c, t, "x") for c in (1, 1_000_000_001, 3_000_000_000) for t in range(70)]
    sf_dir = scratch.fresh_folder(spark, "tests", "sf-large-ids")
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{sf_dir}/conversations.parquet")
    chats = fixtures.chats_frame(spark, sf_dir).collect()
    assert len(chats) == 6 and len({c.id for c in chats}) == 6  # two blocks each
    assert sorted(len(c.messages) for c in chats) == [6, 6, 6, 64, 64, 64]
