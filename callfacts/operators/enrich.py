"""Enrich facts with the client dimension: inner equi-join on the client key.

Strategies
----------
``broadcast``  hash the dimension and ship it to every task (no shuffle of the
               facts), as the original job does.  Measured too: a dimension
               over ``broadcast_max_bytes`` is refused (``BroadcastTooLarge``).
``hash``       shuffled hash join with the dimension as the build side: both
               sides are shuffled on the key, the facts are streamed through a
               per-partition hash table of the dimension -- no sort of the
               facts.  Safe while the dimension's share of one shuffle
               partition is small.
``shuffle``    sort-merge join (``merge`` hint, so a plan-time estimate can
               not broadcast a side whose measured size was too big): no
               memory bound on either side, spills as needed.
               For ``hash`` and ``shuffle`` AQE splits a skewed key's
               partition at runtime (``spark.sql.adaptive.skewJoin.enabled``).
``split``      salted hot keys, without relying on AQE: keys holding at least
               ``hot_key_rows`` facts are found by a partial aggregate; their
               facts are dealt over as many salts as they hold that many rows
               and their dimension rows are repeated once per salt, so every
               key goes through the one sort-merge join on (key, salt).
``bucketed``   the dimension is a table bucketed and sorted by its id (see
               ``save_bucketed``), so a daily join never shuffles or sorts it; the
               facts are shuffled to its buckets.  AQE cannot split a bucket, so
               hot keys are found as above and joined apart: their dimension rows
               are broadcast behind the measured bound, their facts not shuffled.
``spark``      no hint and no size check: Spark and AQE choose from their own
               estimates (a file-size estimate is not a proven bound; kept
               for comparison and for sessions that tune the thresholds).
``auto``       (default) measure the dimension first -- total bytes and the
               bytes of its largest partition of the join's shuffle, in one
               action; broadcast it when the total is within
               ``broadcast_max_bytes``; otherwise, with AQE skew handling on,
               ``hash`` when the largest partition (and AQE's coalescing
               target) is within ``hash_partition_max_bytes``, else
               ``shuffle``; with AQE skew handling off, ``split``.

Facts whose key is NULL or not a number never match (inner join); Catalyst's
inferred ``isnotnull`` filter drops them before any shuffle, so they cannot
pile up in one partition either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts import scratch
from callfacts.functions.keys import numeric_key
from callfacts.plans.sizing import DEFAULT_BROADCAST_MAX_BYTES, measure, parse_bytes

KEY = "_client_key"
STRATEGIES = ("auto", "broadcast", "hash", "shuffle", "split", "bucketed", "spark")
_HINTS = {"broadcast": "broadcast", "hash": "shuffle_hash", "shuffle": "merge", "spark": None}

SALT = "_client_salt"
READABLE = "_client_key_readable"

# Default of the hot-key split: a key is hot from this many fact rows on.  The
# list of hot keys is broadcast; N rows hold at most N / T keys of T rows, so
# where the list passes HOT_LIST_ROWS the threshold T is doubled until it fits.
# A key below it holds under 2 N / HOT_LIST_ROWS rows, which one task can join.
DEFAULT_HOT_KEY_ROWS = 1_000_000
HOT_LIST_ROWS = 1_000_000

# Largest share of the dimension that one shuffle partition may hold for the
# hash join's in-memory build side.
DEFAULT_HASH_PARTITION_MAX_BYTES = 64 * 1024 * 1024


class BroadcastTooLarge(ValueError):
    """A forced broadcast of a side whose measured size is over the bound."""


def _aqe_splits_skew(spark) -> bool:
    on = lambda k, d: (spark.conf.get(k, d) or d).strip().lower() == "true"
    return on("spark.sql.adaptive.enabled", "true") and on("spark.sql.adaptive.skewJoin.enabled", "true")


def shuffle_partitions(spark) -> int:
    """Partitions a join shuffle starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions", "200"))


def coalesce_cap(spark) -> int:
    """How big AQE may make a coalesced partition from smaller ones (0 when
    coalescing is off).  Its target is at most the larger of the advisory size
    and the minimum partition size, and merging never makes a partition bigger
    than that target or than one original partition."""
    aqe = (spark.conf.get("spark.sql.adaptive.enabled", "true") or "true").lower() == "true"
    on = (spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true") or "true").lower() == "true"
    if not (aqe and on):
        return 0
    advisory = parse_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    floor = parse_bytes(spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1MB"))
    return max(advisory, floor)


def choose_strategy(
    dim: DataFrame,
    strategy: str,
    broadcast_max_bytes: int,
    hash_partition_max_bytes: int = DEFAULT_HASH_PARTITION_MAX_BYTES,
) -> str:
    """The tier for joining to ``dim`` (the projected join side, see
    ``client_side``).  A forced strategy is returned as is, ``broadcast`` only
    after a check of the measured size; ``auto`` measures
    ``dim`` once -- total bytes and, on the join's own partitioning, the
    largest partition -- and picks broadcast / hash / shuffle (or split when
    AQE will not split skewed partitions)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; use one of {STRATEGIES}")
    if strategy == "broadcast":
        size = measure(dim)
        if size.bytes > broadcast_max_bytes:
            raise BroadcastTooLarge(f"the dimension has {size.bytes} bytes; the broadcast bound is {broadcast_max_bytes}")
    if strategy != "auto":
        return strategy
    spark = dim.sparkSession
    size = measure(dim, KEY if KEY in dim.columns else None, shuffle_partitions(spark))
    if size.bytes <= broadcast_max_bytes:
        return "broadcast"
    if not _aqe_splits_skew(spark):
        return "split"
    build = max(size.max_partition_bytes or size.bytes, coalesce_cap(spark))
    return "hash" if build <= hash_partition_max_bytes else "shuffle"


def _join(
    facts: DataFrame,
    dim: DataFrame,
    out: Sequence[str],
    dim_columns: Sequence[str],
    hint: str | None,
    matched: str | None = None,
    salted: bool = False,
) -> DataFrame:
    """Equi-join of the aliased sides (P7) on the cast key, projected to ``out``.

    Inner, or with ``matched`` left outer with that flag.  Then a fact without a readable key
    stands under a hash of itself, so that such facts spread over all partitions, and the
    condition keeps it from matching a client of that number.
    """
    f, d = facts.alias("facts"), dim.alias("clients")
    d = d.hint(hint) if hint else d
    on = F.col(f"facts.{KEY}") == F.col(f"clients.{KEY}")
    if salted:
        on = on & (F.col(f"facts.{SALT}") == F.col(f"clients.{SALT}"))
    found = []
    if matched:
        on = on & F.col(f"facts.{READABLE}")
        found = [F.col(f"clients.{KEY}").isNotNull().alias(matched)]
    joined = f.join(d, on, "left_outer" if matched else "inner")
    return joined.select(*[F.col(f"facts.`{c}`") for c in out], *[F.col(f"clients.`{c}`") for c in dim_columns], *found)


def hot_keys(facts: DataFrame, hot_key_rows: int, list_rows: int | None = None) -> DataFrame:
    """``(key, salts)`` of every key with at least ``hot_key_rows`` facts (see HOT_LIST_ROWS).

    Counts are partially aggregated; the list is written once to the shared
    checkpoint folder, so it survives the loss of an executor.
    """
    scratch.shared_root(facts.sparkSession)  # checkpoint() needs the shared folder
    list_rows = HOT_LIST_ROWS if list_rows is None else list_rows
    counts = facts.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") >= hot_key_rows).checkpoint(eager=True)
    while hot.count() > list_rows:
        hot_key_rows *= 2
        hot = hot.where(F.col("n") >= hot_key_rows)
    return hot.select(KEY, F.ceil(F.col("n") / F.lit(hot_key_rows)).cast("int").alias(SALT))


def _split_join(
    facts: DataFrame, dim: DataFrame, out: Sequence[str], dim_columns: Sequence[str], hot_key_rows: int, matched: str | None
) -> DataFrame:
    hot = F.broadcast(hot_keys(facts, hot_key_rows))  # bounded by HOT_LIST_ROWS rows of 12 bytes
    # a hash of the whole fact, not a random number: a retried task deals its rows as before
    deal = F.xxhash64(*[F.col(f"`{c}`") for c in out])
    salted = facts.join(hot, KEY, "left").withColumn(SALT, F.coalesce(F.pmod(deal, F.col(SALT)).cast("int"), F.lit(0)))
    spread = dim.join(hot, KEY, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALT), F.lit(1)) - 1))
    )
    return _join(salted, spread, out, dim_columns, "merge", matched, salted=True)


class BucketsError(ValueError):
    """A dimension that is not bucketed on its key as the session's joins need it."""


def save_bucketed(dim: DataFrame, table: str, buckets: int | None = None, key: str = "id", path: str | None = None) -> str:
    """Save the dimension as a catalog table bucketed and sorted by its key, for ``bucketed`` joins.

    One shuffle now instead of one a join.  A join then has as many tasks as there are
    ``buckets`` (by default the session's number of shuffle partitions).  With ``path`` the
    table's files lie there instead of in the warehouse.
    """
    n = buckets or shuffle_partitions(dim.sparkSession)
    # as many tasks as buckets, dealt as the buckets are: one file each
    dealt = dim.repartition(n, key)
    where = {"path": path} if path else {}
    dealt.write.format("parquet").mode("overwrite").options(**where).bucketBy(n, key).sortBy(key).saveAsTable(table)
    return table


def _bucketed_join(
    facts: DataFrame, dim: DataFrame, out: Sequence[str], dim_columns: Sequence[str], hot_key_rows: int, max_bytes: int, matched: str | None
) -> DataFrame:
    hot = hot_keys(facts, hot_key_rows)
    known = dim.join(F.broadcast(hot.select(KEY)), KEY, "left_semi")
    size = measure(known)
    if size.bytes > max_bytes:
        raise BroadcastTooLarge(f"the dimension rows of the hot keys have {size.bytes} bytes; the broadcast bound is {max_bytes}")
    marked = facts.join(F.broadcast(hot), KEY, "left")
    cold = _join(marked.where(F.col(SALT).isNull()).drop(SALT), dim, out, dim_columns, "merge", matched)
    if "Bucketed: true" not in cold._jdf.queryExecution().executedPlan().toString():
        raise BucketsError("the dimension would be shuffled: save it with save_bucketed, by the key it is joined on")
    return cold.unionByName(_join(marked.where(F.col(SALT).isNotNull()).drop(SALT), known, out, dim_columns, "broadcast", matched))


def client_side(dim: DataFrame, dim_key: str = "id", dim_columns: Sequence[str] = ("name",)) -> DataFrame:
    """The part of the dimension that takes part in the join: key + wanted columns."""
    return dim.select(F.col(dim_key).cast("bigint").alias(KEY), *dim_columns)


def join_client(
    facts: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str = "clientId",
    dim_key: str = "id",
    dim_columns: Sequence[str] = ("name",),
    strategy: str = "auto",
    strict: bool = False,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    hash_partition_max_bytes: int = DEFAULT_HASH_PARTITION_MAX_BYTES,
    keep_unmatched: str | None = None,
) -> DataFrame:
    """Inner join facts to the dimension; returns the fact columns + ``dim_columns``.

    With ``keep_unmatched`` facts without a client stay, with NULL dimension columns, and the
    column of that name says which facts have one.

    The text key is cast to BIGINT once on the fact side (J3).  Only the key
    and the wanted columns of the dimension take part, so the dimension's own
    ``id`` never collides with the fact's ``id``.
    """
    clash = set(dim_columns) & set(facts.columns)
    if clash:
        raise ValueError(f"dimension columns {sorted(clash)} already exist in the facts")
    keyed = facts.withColumn(KEY, numeric_key(fact_key, strict=strict))
    side = client_side(dim, dim_key, dim_columns)
    if keep_unmatched:
        itself = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
        keyed = keyed.withColumn(READABLE, F.col(KEY).isNotNull()).withColumn(KEY, F.coalesce(F.col(KEY), itself))
        side = side.where(F.col(KEY).isNotNull())
    how = choose_strategy(side, strategy, broadcast_max_bytes, hash_partition_max_bytes)
    if how == "bucketed":
        return _bucketed_join(keyed, side, facts.columns, dim_columns, hot_key_rows, broadcast_max_bytes, keep_unmatched)
    if how == "split":
        return _split_join(keyed, side, facts.columns, dim_columns, hot_key_rows, keep_unmatched)
    return _join(keyed, side, facts.columns, dim_columns, _HINTS[how], keep_unmatched)
