"""Data-quality rules: constraints, keys, references and required fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.operators import contracts

Rule = tuple[str, Column]


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, n_rows, n_violations`` for all rules in one pass.

    A rule is violated where its expression is false; NULL passes.
    """
    counts = [F.count_if(~expr).alias(f"v{i}") for i, (_, expr) in enumerate(rules)]
    totals = df.agg(F.count("*").alias("n_rows"), *counts)
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col("n_rows"), F.col(f"v{i}").alias("n_violations"))
        for i, (name, _) in enumerate(rules)
    ])
    return totals.select(F.inline(rows))


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of all broken rules."""
    broken = F.array_compact(F.array(*[F.when(~expr, F.lit(name)) for name, expr in rules]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def not_null(*names: str) -> list[Rule]:
    return [(f"{n} not null", F.col(n).isNotNull()) for n in names]


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add omitted columns with their default; given columns keep their NULLs."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def chip_rules() -> list[Rule]:
    return contracts.rules(contracts.CHIP)


def memory_rules() -> list[Rule]:
    return contracts.rules(contracts.MEMORY)


def variant_rules() -> list[Rule]:
    return contracts.rules(contracts.VARIANT)


def observation_rules() -> list[Rule]:
    return contracts.rules(contracts.OBSERVATION)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def conflicting(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys that occur with more than one payload; identical repeats are fine."""
    versions = df.select(*keys, *payload).distinct()
    return versions.groupBy(*keys).agg(F.count("*").alias("n_payloads")).where("n_payloads > 1")


def ambiguous(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Comparable keys shared by several ids: how many, the first and the last."""
    pairs = df.select(key.alias("key"), F.col(id_col).alias("id")).where("id is not null").distinct()
    return pairs.groupBy("key").agg(
        F.count("*").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    ).where("n_ids > 1")


def missing_fields(json_text: Column, names: Sequence[str]) -> Column:
    """Names absent from a JSON object; a field that holds null is present.

    NULL where the text is no object.
    """
    required = F.array(*[F.lit(n) for n in names])
    return F.array_except(required, F.json_object_keys(json_text))


def required_fields(df: DataFrame, json_col: str, names: Sequence[str]) -> DataFrame:
    """Add ``missing``: absent fields, or all of them when there is no object."""
    absent = missing_fields(F.col(json_col), names)
    return df.withColumn("missing", F.coalesce(absent, F.array(*[F.lit(n) for n in names])))


def reject_cascade(df: DataFrame, reasons: Sequence[Rule], out: str = "outcome") -> DataFrame:
    """Add the first reason that holds; NULL when none does.

    Exactly one ``case`` decides, so each row has one reason and the rejected
    and accepted rows together are the input.
    """
    first, *rest = reasons
    chain = F.when(first[1], F.lit(first[0]))
    for name, expr in rest:
        chain = chain.when(expr, F.lit(name))
    return df.withColumn(out, chain)


def funnel(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Rows per outcome."""
    return df.groupBy(outcome).agg(F.count("*").alias("n_rows"))


def run_failed(counts: DataFrame, errors: Sequence[str], outcome: str = "outcome") -> DataFrame:
    """One row: whether any outcome in ``errors`` occurred. Skips do not fail a run."""
    bad = F.coalesce(F.sum(F.when(F.col(outcome).isin(*errors), F.col("n_rows"))), F.lit(0).cast("bigint"))
    return counts.agg(bad.alias("n_errors"), (bad > 0).alias("failed"))
