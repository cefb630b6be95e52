"""Helpers shared by the operators: staged tables, connected components, label samples."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import callfacts
from callfacts.scratch import fresh_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as ``--py-files`` would.

    The zip file is handed to Spark, which serves it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(callfacts.__file__).parent
    with tempfile.NamedTemporaryFile(prefix="callfacts-", suffix=".zip", delete=False) as out, zipfile.ZipFile(out, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(out.name)
    _shipped.add(context.applicationId)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back.

    This cuts the lineage with files that every executor sees, so a lost
    executor costs a re-read and no recomputation.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged files that no plan reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns ``(node, component)`` for every node that has an edge to another
    node; ``component`` is the smallest node reachable.  Each step is two
    partially aggregated group-bys and two equi-joins whose right side has one
    row per key, so a hub is split by AQE's skew join.  Rounds grow with the
    logarithm of the number of nodes; each ends in a staged table, and only a
    count and a checksum come to the driver.
    """
    e = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    )
    e = staged(e.distinct(), "edges")
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            e.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = staged(small, "stars")
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)


def label_sample(
    labels: DataFrame, label: str, keep, bound: int, seed: int = 7, id_col: str = "doc_id"
) -> DataFrame:
    """At most ``bound`` labelled ids as ``(_lid, _y)``, for a broadcast join.

    ``keep`` is a condition on the id column (the training rows).  Repeated
    label rows of an id count once (label 1 wins); null ids and labels are left
    out.  Ids are chosen by a seeded hash, so the sample is the same in every
    run; the rate is lowered until the sample holds at most ``bound`` rows.
    """
    known = (
        labels.select(F.col(id_col).alias("_lid"), F.col(label).cast("int").alias("_y"))
        .where(keep(F.col("_lid")) & F.col("_y").isNotNull())
        .groupBy("_lid")
        .agg(F.max("_y").alias("_y"))
    )
    known = staged(known, "labels")
    n, rate = known.count(), 1.0
    while n > bound:
        rate *= 0.95 * bound / n
        cut = int(rate * (1 << 30))
        taken = known.where(F.pmod(F.xxhash64("_lid", F.lit(seed)), F.lit(1 << 30)) < cut)
        n = taken.count()
    return taken if rate < 1.0 else known
