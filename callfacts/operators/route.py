"""Every fact to its target or to quarantine, in one pass (R1 + J1).

A fact is quarantined when a rule fails or no client has its key.  It keeps its fields as far
as they could be read, its raw line and the list of all reasons, so it can be mended and sent
again; target and quarantine together hold every fact once for each client row that matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfacts.functions.rules import Rule, violations
from callfacts.operators.enrich import join_client

NO_CLIENT = "no such client"
MATCHED = "_matched"
REASONS, RAW, ROUTE = "reasons", "raw", "route"
KEPT, QUARANTINED = "target", "quarantine"

QUARANTINE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("clientId", T.StringType()),
        T.StructField(RAW, T.StringType()),
        T.StructField(REASONS, T.ArrayType(T.StringType())),
    ]
)


def routed(facts: DataFrame, dim: DataFrame, rules: list[Rule], *, raw: str = RAW, key: str = "clientId", **join) -> DataFrame:
    """``facts`` with ``name``, ``reasons`` and ``route`` (``target`` or ``quarantine``).

    ``rules`` are evaluated once a fact, before the join.  "No such client" is a reason only
    for a key that is a number: one that is not has its own rule.  The raw line stays with
    quarantined facts only, so that target rows do not carry it to the sink.
    """
    checked = facts.withColumn(REASONS, violations(rules))
    joined = join_client(checked, dim, fact_key=key, keep_unmatched=MATCHED, **join)
    lost = ~F.col(MATCHED) & F.col(key).try_cast("bigint").isNotNull()
    why = F.concat(F.col(REASONS), F.when(lost, F.array(F.lit(NO_CLIENT))).otherwise(F.array().cast("array<string>")))
    flagged = joined.withColumn(REASONS, why)
    bad = F.size(REASONS) > 0
    return flagged.withColumns(
        {ROUTE: F.when(bad, F.lit(QUARANTINED)).otherwise(F.lit(KEPT)), raw: F.when(bad, F.col(raw))}
    ).drop(MATCHED)
