"""All failed rules per fact row.

``with_violations`` adds an ARRAY<STRING> of every failed rule of the row;
``violation_rows`` gives one (id, rule) row per failure.  Both are narrow
(no shuffle), so they scale with the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.functions.rules import Rule, fact_rules, message_rules, violations

COLUMN = "violations"


def rules_for(df: DataFrame, *, messages: bool | None = None) -> list[Rule]:
    """Call rules on any fact; message rules too when the row has a raw message list."""
    rules = fact_rules()
    if messages is None:
        messages = "messages" in df.columns
    if messages:
        rules += message_rules()
    return rules


def with_violations(df: DataFrame, *, messages: bool | None = None, column: str = COLUMN) -> DataFrame:
    return df.withColumn(column, violations(rules_for(df, messages=messages)))


def violation_rows(
    df: DataFrame, *, id_column: str = "id", column: str = COLUMN, messages: bool | None = None
) -> DataFrame:
    """One row per failed rule.

    Each rule's message-or-NULL goes into a fixed-size array that is exploded
    in place and filtered on NULL: plain codegen'd expressions, evaluated once.
    (Exploding a stored list column instead makes Spark infer a non-empty
    filter from it and push that below, evaluating every rule twice.)
    """
    if column in df.columns:
        return df.select(id_column, F.explode(column).alias("rule"))
    flagged = F.array(*[F.when(cond, F.lit(msg)) for cond, msg in rules_for(df, messages=messages)])
    return df.select(id_column, F.explode(flagged).alias("rule")).where(F.col("rule").isNotNull())


class StrictInputError(ValueError):
    """Strict mode found a row its rules refuse; nothing was written.

    ``report`` has the counts by rule where the write counted them.
    """

    report: dict[str, int] | None = None


def require_none(df: DataFrame, rules: list[Rule], *, what: str, show: str = "id") -> None:
    """Fail if any row breaks one of ``rules``.

    One pass over ``df`` for all rules together: a count and one example per
    rule, in one row.  Meant to run before a write, so a strict failure can
    never leave a half-replaced target.
    """
    if not rules:
        return
    shown = F.coalesce(F.col(show).cast("string"), F.lit("NULL"))
    found = [c for cond, _ in rules for c in (F.count_if(cond), F.min(F.when(cond, shown)))]
    row = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(found)]).first()
    broken = [f"{m} ({row[2 * i]} rows, e.g. {show}={row[2 * i + 1]!r})" for i, (_, m) in enumerate(rules) if row[2 * i]]
    if broken:
        raise StrictInputError(f"{what}: {'; '.join(broken)}; nothing was written")


def passing(df: DataFrame, *, column: str = COLUMN) -> DataFrame:
    """Rows that fail no rule (the column is dropped)."""
    checked = df if column in df.columns else with_violations(df, column=column)
    return checked.where(F.size(column) == 0).drop(column)
