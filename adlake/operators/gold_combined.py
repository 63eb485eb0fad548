"""Gold tables that set spend against bookings.

A single table joins two aggregates in full outer fashion; both arrive partitioned by the
join keys, so the join itself shuffles nothing. Where several figures come out of one pass
(the KPIs, the cube of all three tables) the inputs are stacked instead: a spend row has no
booking and a booking row no money, so one aggregation serves both, without cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import columns as c
from adlake.operators.gold_bookings import CALLS, as_date
from adlake.operators.gold_spend import daily_totals, valid_spend
from adlake.operators.grains import GRAIN, at_grains, counts_at_grains
from adlake.operators.quality import keep_valid, parsed, require_columns, required

REQUIRED = ["booking_id", "booking_date", "channel"]

PARTITIONS = {"daily_cpb_by_channel": ["metric_date"]}

CUBE = {"daily": ["metric_date", "channel"], "channels": ["channel"], "overall": []}


def countable_bookings(silver: DataFrame) -> DataFrame:
    """Rows that count as bookings here. Weaker than the booking-only tables' rules: a booking
    whose meeting time is unknown still cost money."""
    require_columns(silver, REQUIRED, "silver bookings")
    shaped = silver.select(
        F.col("booking_id").cast("string").alias("booking_id"),
        as_date(silver, "booking_date").alias("booking_date"),
        F.col("channel").cast("string").alias("channel"),
        F.col("booking_date").alias("_booking_date"),
    )
    rules = [*required("booking_id", "channel"), *parsed("booking_date", "_booking_date")]
    return keep_valid(shaped, rules).select(REQUIRED)


def activity(spend: DataFrame, bookings: DataFrame) -> DataFrame:
    """Spend rows (``spend_date, channel, usd``) and countable bookings stacked, each with its
    day and channel."""
    spent = spend.select(
        F.col("spend_date").alias("metric_date"),
        "channel",
        F.col("usd").cast(c.MONEY_SUM).alias("usd"),
        F.lit(None).cast("string").alias("booking_id"),
    )
    booked = bookings.select(
        F.col("booking_date").alias("metric_date"),
        "channel",
        F.lit(None).cast(c.MONEY_SUM).alias("usd"),
        "booking_id",
    )
    return spent.unionByName(booked)


def _summed_activity(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """Activity with spend already summed per day and channel: for aggregates that multiply
    their input (several distinct counts, grouping sets), so that they multiply little."""
    spend = daily_totals(silver_spend).withColumnRenamed("total", "usd")
    return activity(spend, countable_bookings(silver_bookings))


def _total() -> Column:
    return F.coalesce(F.sum("usd").cast(c.MONEY_SUM), _nothing()).alias("total")


def _nothing() -> Column:
    return F.lit(0).cast(c.MONEY_SUM)


def _priced(grouped: DataFrame, *keys: str) -> DataFrame:
    return grouped.select(
        *keys,
        c.amount_usd(F.col("total")).alias("total_spend_usd"),
        CALLS,
        c.cost_per(F.col("total"), F.col(CALLS)).alias("cost_per_booking_usd"),
    )


def _cost_by(silver_spend: DataFrame, silver_bookings: DataFrame, *keys: str) -> DataFrame:
    spent = (
        valid_spend(silver_spend)
        .withColumnRenamed("spend_date", "metric_date")
        .groupBy(*keys)
        .agg(F.sum("spend_usd").alias("spent"))
    )
    booked = (
        countable_bookings(silver_bookings)
        .withColumnRenamed("booking_date", "metric_date")
        .groupBy(*keys)
        .agg(F.count_distinct("booking_id").alias("booked"))
    )
    both = spent.join(booked, on=list(keys), how="full_outer").select(
        *keys,
        F.coalesce("spent", _nothing()).alias("total"),
        F.coalesce("booked", F.lit(0)).alias(CALLS),
    )
    return _priced(both, *keys)


def cpb_by_channel(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    return _cost_by(silver_spend, silver_bookings, "channel")


def daily_cpb_by_channel(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    return _cost_by(silver_spend, silver_bookings, "metric_date", "channel")


def combined_dashboard_kpis(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """One row, also over empty inputs. Channels count once whichever side they come from."""
    booked = F.col("booking_id").isNotNull()
    totals = _summed_activity(silver_spend, silver_bookings).agg(
        _total(),
        F.count_distinct("booking_id").alias("total_bookings"),
        F.count_distinct("channel").alias("channel_count"),
        F.count_distinct(F.when(~booked, F.col("metric_date"))).alias("spend_date_count"),
        F.count_distinct(F.when(booked, F.col("metric_date"))).alias("booking_date_count"),
    )
    return _kpis(totals)


def _kpis(totals: DataFrame) -> DataFrame:
    return totals.select(
        c.amount_usd(F.col("total")).alias("total_spend_usd"),
        "total_bookings",
        c.cost_per(F.col("total"), F.col("total_bookings")).alias("average_cost_per_booking_usd"),
        "channel_count",
        "spend_date_count",
        "booking_date_count",
    )


def dashboard_kpis(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """The three headline figures alone."""
    return combined_dashboard_kpis(silver_spend, silver_bookings).select(
        "total_bookings",
        F.col("total_spend_usd").alias("total_spend"),
        F.col("average_cost_per_booking_usd").alias("average_cpb"),
    )


def combined_cube(silver_spend: DataFrame, silver_bookings: DataFrame, heavy: Sequence[str] = ()) -> DataFrame:
    """Spend and distinct bookings per day and channel, per channel and overall, reading each
    input once. As small as the three tables that come out of it."""
    bookings = countable_bookings(silver_bookings).withColumnRenamed("booking_date", "metric_date")
    booked = counts_at_grains(bookings, "booking_id", CUBE, CALLS, heavy).withColumn("usd", F.lit(None).cast(c.MONEY_SUM))
    days = daily_totals(silver_spend).select(
        F.col("spend_date").alias("metric_date"), "channel", F.col("total").cast(c.MONEY_SUM).alias("usd")
    )
    spent = at_grains(days, CUBE, "usd").withColumn(CALLS, F.lit(0).cast("long"))
    return spent.unionByName(booked).groupBy(GRAIN, "metric_date", "channel").agg(
        _total(), F.count("usd").alias("spend_rows"), F.sum(CALLS).alias(CALLS)
    )


def tables_from_cube(cube: DataFrame) -> dict[str, DataFrame]:
    daily = cube.where(F.col(GRAIN) == "daily")
    channels = cube.where(F.col(GRAIN) == "channels")
    is_daily = F.col(GRAIN) == "daily"
    is_overall = F.col(GRAIN) == "overall"
    totals = cube.agg(
        F.coalesce(F.max(F.when(is_overall, F.col("total"))), _nothing()).alias("total"),
        F.coalesce(F.max(F.when(is_overall, F.col(CALLS))), F.lit(0)).alias("total_bookings"),
        F.count_distinct(F.when(is_daily, F.col("channel"))).alias("channel_count"),
        F.count_distinct(
            F.when(is_daily & (F.col("spend_rows") > 0), F.col("metric_date"))
        ).alias("spend_date_count"),
        F.count_distinct(
            F.when(is_daily & (F.col(CALLS) > 0), F.col("metric_date"))
        ).alias("booking_date_count"),
    )
    return {
        "cpb_by_channel": _priced(channels, "channel"),
        "daily_cpb_by_channel": _priced(daily, "metric_date", "channel"),
        "combined_dashboard_kpis": _kpis(totals),
    }


def combined_tables(silver_spend: DataFrame, silver_bookings: DataFrame) -> dict[str, DataFrame]:
    """The three combined tables, each its own lazy query."""
    inputs = (silver_spend, silver_bookings)
    return {
        "cpb_by_channel": cpb_by_channel(*inputs),
        "daily_cpb_by_channel": daily_cpb_by_channel(*inputs),
        "combined_dashboard_kpis": combined_dashboard_kpis(*inputs),
    }


def channels_in_use(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """Every channel of either input, once."""
    spent = valid_spend(silver_spend).select("channel")
    return spent.union(countable_bookings(silver_bookings).select("channel")).distinct()
