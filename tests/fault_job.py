"""Run by test_fault_tolerance in its own JVM: the first attempt of some tasks
fails; Spark retries them and the committed tables hold every row once."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from callfacts import fixtures, scratch  # noqa: E402
from callfacts.operators import join_client  # noqa: E402
from callfacts.sinks import write_table  # noqa: E402


@F.udf(T.LongType())
def flaky(x):
    """Fails the first attempt of partition 0 (a test-only fault injector)."""
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return x


def main(sf_dir: str, strategy: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,3]")  # up to 3 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")  # the lost attempt shows in stderr
    calls = fixtures.calls_frame(spark, sf_dir).repartition(4).withColumn("id", flaky("id"))
    out = scratch.fresh_folder(spark, "tests", "fault")
    write_table(join_client(calls, fixtures.clients_frame(spark, sf_dir), strategy=strategy), out)
    got = spark.read.parquet(out)
    print(json.dumps({"rows": got.count(), "distinct": got.select("id").distinct().count()}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
