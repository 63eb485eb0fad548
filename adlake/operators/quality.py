"""Validation: required columns, row rules, and the valid/reject split.

A rule pairs a reason with the condition a good row meets. The same list drives the plain
filter (conditions that Catalyst can push to the scan) and the reject reasons, so both
always agree; a condition that is NULL counts as not met in either.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adlake.functions.columns import all_of

REASONS = "reject_reasons"


class InvalidRows(ValueError):
    """Strict mode met a row that breaks a rule."""


@dataclass(frozen=True)
class Rule:
    reason: str
    holds: Column


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> None:
    """Raise at plan time, without a job, when columns are absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{table} is missing columns: {missing}")


def required(*names: str) -> list[Rule]:
    return [Rule(f"missing_{name}", F.col(name).isNotNull()) for name in names]


def parsed(name: str, written: str) -> list[Rule]:
    """``name`` was parsed from ``written``: tell an absent value from an unreadable one."""
    return [
        Rule(f"missing_{name}", F.col(written).isNotNull()),
        Rule(f"invalid_{name}", F.col(written).isNull() | F.col(name).isNotNull()),
    ]


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.where(all_of([rule.holds for rule in rules]))


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row, with the reasons against it in rule order (empty array for a good row)."""
    broken = [F.when(rule.holds, F.lit(None)).otherwise(F.lit(rule.reason)) for rule in rules]
    return df.withColumn(REASONS, F.array_compact(F.array(*broken)))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)


def raise_on_rejects(checked: DataFrame) -> None:
    """Strict mode. Stops at the first bad row it meets, before anything is written."""
    found = rejected_rows(checked).select(REASONS).limit(1).collect()
    if found:
        raise InvalidRows(f"invalid rows in strict mode, for instance: {list(found[0][0])}")


#: Names of what ``watched`` counts beside the reasons.
ROWS, BROKEN = "rows", "broken_rows"


def watched(checked: DataFrame, reasons: Iterable[str]) -> tuple[DataFrame, Observation]:
    """The checked rows, and the numbers of rows, of rows that break a rule, and of rows per
    reason. They are counted while the rows are written for whatever purpose, without a pass of
    their own, and are there when that is done."""
    seen = Observation()
    per_reason = [F.count_if(F.array_contains(REASONS, reason)).alias(reason) for reason in dict.fromkeys(reasons)]
    broken = F.count_if(F.size(REASONS) > 0).alias(BROKEN)
    return checked.observe(seen, F.count("*").alias(ROWS), broken, *per_reason), seen


def raise_on_counts(counts: Mapping[str, int]) -> None:
    """Strict mode, from what ``watched`` has counted."""
    if counts[BROKEN]:
        found = {name: n for name, n in counts.items() if n and name not in (ROWS, BROKEN)}
        raise InvalidRows(f"invalid rows in strict mode: {counts[BROKEN]} of {counts[ROWS]}, by reason {found}")


def reason_counts(checked: DataFrame) -> DataFrame:
    return (
        rejected_rows(checked)
        .select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("row_count"))
    )
