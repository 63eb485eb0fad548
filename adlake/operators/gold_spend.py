"""Spend-only gold tables. Money is summed as exact decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions import columns as c
from adlake.operators.gold_bookings import as_date
from adlake.operators.quality import (
    Rule,
    keep_valid,
    parsed,
    require_columns,
    required,
    with_reasons,
)

REQUIRED = ["spend_date", "channel", "spend_usd"]

# what rounds to a cent below zero, and what no longer fits the money type
NO_CENT, MONEY_LIMIT = -0.005, 1e16

PARTITIONS = {"daily_spend_by_channel": ["spend_date"]}


def _shaped(silver: DataFrame) -> DataFrame:
    require_columns(silver, REQUIRED, "silver spend")
    return silver.select(
        as_date(silver, "spend_date").alias("spend_date"),
        F.col("channel").cast("string").alias("channel"),
        c.money(F.col("spend_usd")).alias("spend_usd"),
        F.col("spend_date").alias("_spend_date"),
        F.col("spend_usd").alias("_spend_usd"),
    )


def _rules(shaped: DataFrame) -> list[Rule]:
    exact, written = F.col("spend_usd"), F.col("_spend_usd")
    if dict(shaped.dtypes)["_spend_usd"] == "string":
        readable, not_negative = exact.isNotNull(), exact >= 0
    else:
        # the same verdict from the stored amount (NaN is beyond any number): the comparisons
        # reach the parquet scan, and the costly conversion is left to the rows that stay
        readable, not_negative = written < MONEY_LIMIT, written > NO_CENT
    return [
        *parsed("spend_date", "_spend_date"),
        *required("channel"),
        Rule("missing_spend_usd", written.isNotNull()),
        Rule("invalid_spend_usd", written.isNull() | readable),
        Rule("negative_spend_usd", written.isNull() | ~readable | not_negative),
    ]


def valid_spend(silver: DataFrame) -> DataFrame:
    """The rows that spend and combined tables sum."""
    shaped = _shaped(silver)
    return keep_valid(shaped, _rules(shaped)).select(REQUIRED)


def checked_spend(silver: DataFrame) -> DataFrame:
    """Every row with the reasons that keep it out of the spend tables."""
    shaped = _shaped(silver)
    return with_reasons(shaped, _rules(shaped)).withColumnsRenamed(
        {"_spend_date": "written_spend_date", "_spend_usd": "written_spend_usd"}
    )


def daily_totals(silver: DataFrame) -> DataFrame:
    """Decimal spend per date and channel: the pre-aggregate the other tables build on."""
    total = F.sum("spend_usd").alias("total")
    return valid_spend(silver).groupBy("spend_date", "channel").agg(total)


def daily_spend_by_channel(silver: DataFrame) -> DataFrame:
    return _daily(daily_totals(silver))


def channel_spend_summary(silver: DataFrame) -> DataFrame:
    return _summary(daily_totals(silver))


def _daily(totals: DataFrame) -> DataFrame:
    return totals.select(
        "spend_date", "channel", c.amount_usd(F.col("total")).alias("total_spend_usd")
    )


def _summary(totals: DataFrame) -> DataFrame:
    # one row per date and channel comes in, so counting rows counts days
    by_channel = totals.groupBy("channel").agg(
        F.sum("total").cast(c.MONEY_SUM).alias("total"),
        F.count("*").alias("spend_day_count"),
    )
    return by_channel.select(
        "channel",
        c.amount_usd(F.col("total")).alias("total_spend_usd"),
        "spend_day_count",
        c.cost_per(F.col("total"), F.col("spend_day_count")).alias("average_daily_spend_usd"),
    )


def tables_from_totals(totals: DataFrame) -> dict[str, DataFrame]:
    return {"daily_spend_by_channel": _daily(totals), "channel_spend_summary": _summary(totals)}


def spend_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return tables_from_totals(daily_totals(silver))
