"""Further metrics: campaign cost, time slots per channel, weekly load per employee."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.fixed_values import UNKNOWN_CAMPAIGN
from adlake.functions import columns as c
from adlake.operators.gold_bookings import as_date, booking_trends, daily_calls_by_source
from adlake.operators.gold_combined import cpb_by_channel, dashboard_kpis
from adlake.operators.gold_spend import daily_totals, valid_spend
from adlake.operators.quality import keep_valid, require_columns, required
from adlake.session import staged


def campaign_cpb(silver_spend: DataFrame, silver_bookings: DataFrame) -> DataFrame:
    """Bookings per channel and campaign against the spend of the whole channel, which repeats
    on each of its campaigns. Channels without bookings do not appear."""
    require_columns(silver_bookings, ["booking_id", "channel"], "silver bookings")
    channel, booking = c.blank_to_null(F.col("channel")), c.blank_to_null(F.col("booking_id"))
    booked = (
        silver_bookings.where(channel.isNotNull() & booking.isNotNull())
        .groupBy(
            channel.alias("channel"),
            c.column_or(silver_bookings, "utm_campaign", UNKNOWN_CAMPAIGN).alias("campaign"),
        )
        .agg(F.count_distinct(booking).alias("total_bookings"))
    )
    spent = valid_spend(silver_spend).groupBy("channel").agg(F.sum("spend_usd").alias("spent"))
    # no broadcast hint: both sides are aggregates whose size AQE knows when it picks the join
    total = F.coalesce("spent", F.lit(0).cast(c.MONEY))
    return booked.join(spent, "channel", "left").select(
        "channel",
        "campaign",
        "total_bookings",
        c.amount_usd(total).alias("total_spend"),
        c.cost_per(total, F.col("total_bookings")).alias("cost_per_booking"),
    )


def time_slot_by_channel(silver_bookings: DataFrame) -> DataFrame:
    needed = ["booking_id", "channel", "meeting_day_of_week", "meeting_hour"]
    require_columns(silver_bookings, needed, "silver bookings")
    slots = silver_bookings.select(
        "meeting_day_of_week",
        F.col("meeting_hour").try_cast("int").alias("meeting_hour"),
        c.blank_to_null(F.col("channel")).alias("channel"),
        c.blank_to_null(F.col("booking_id")).alias("booking_id"),
    )
    return keep_valid(slots, required(*needed)).groupBy("meeting_day_of_week", "meeting_hour", "channel").agg(
        F.count_distinct("booking_id").alias("bookings")
    )


def employee_weekly_load(silver_bookings: DataFrame) -> DataFrame:
    """Meetings, weeks with meetings and the average between them, per employee, under the
    name most recently booked.

    From one scan: bookings, weeks and names of an employee become rows of one kind each, of
    which equal ones are dropped map-side. They are counted per employee and name, which keeps
    the sort that a ``max`` over structs needs to a row per employee and spelling.
    """
    needed = ["booking_id", "employee_id", "meeting_week_start_date", "booking_date"]
    require_columns(silver_bookings, needed, "silver bookings")
    shaped = silver_bookings.select(
        c.blank_to_null(F.col("employee_id")).alias("employee_id"),
        c.blank_to_null(F.col("booking_id")).alias("booking_id"),
        as_date(silver_bookings, "meeting_week_start_date").alias("week"),
        as_date(silver_bookings, "booking_date").alias("booked_on"),
        c.blank_to_null(c.safe_col(silver_bookings, "employee_name")).alias("employee_name"),
    )
    rows = keep_valid(shaped, required("employee_id", "booking_id", "week"))

    facts = {"booking": "booking_id", "week": "week", "name": "employee_name"}
    kinds = [
        F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("value"))
        for kind, name in facts.items()
    ]
    seen = (
        rows.select("employee_id", "booked_on", F.inline(F.array(*kinds)))
        .where(F.col("value").isNotNull())
        .groupBy("employee_id", "kind", "value")
        .agg(F.max("booked_on").alias("last_used"))
    )
    by_name = seen.groupBy("employee_id", F.when(F.col("kind") == "name", F.col("value")).alias("name")).agg(
        F.count_if(F.col("kind") == "booking").alias("meetings"),
        F.count_if(F.col("kind") == "week").alias("weeks"),
        F.max("last_used").alias("last_used"),
    )
    newest = F.max(F.when(F.col("name").isNotNull(), F.struct("last_used", "name")))
    load = by_name.groupBy("employee_id").agg(
        newest["name"].alias("employee_name"),
        F.sum("meetings").alias("total_meetings"),
        F.sum("weeks").alias("number_of_weeks"),
    )
    return load.select(
        "employee_id",
        "employee_name",
        "total_meetings",
        "number_of_weeks",
        c.mean_count(F.col("total_meetings"), F.col("number_of_weeks")).alias(
            "avg_meetings_per_week"
        ),
    )


#: Columns of silver bookings that the metrics count by, where they are there.
COUNTED = [
    "booking_id", "channel", "booking_date", "meeting_date", "meeting_day_of_week", "meeting_hour",
    "meeting_week_start_date", "utm_campaign", "employee_id", "employee_name", "employee_email",
]


@contextmanager
def metric_inputs(silver_spend: DataFrame, silver_bookings: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Within, what the metrics need of spend and bookings, from one scan of each: totals per day
    and channel, and every different booking row once, without the columns no metric reads."""
    totals = daily_totals(silver_spend).select("spend_date", "channel", F.col("total").alias("spend_usd"))
    rows = silver_bookings.select(*(name for name in COUNTED if name in silver_bookings.columns)).distinct()
    with staged(totals) as spend, staged(rows) as bookings:
        yield spend, bookings


def metric_tables(silver_spend: DataFrame, silver_bookings: DataFrame) -> dict[str, DataFrame]:
    """The metrics bundle that is exported as JSON."""
    return {
        "dashboard_kpis": dashboard_kpis(silver_spend, silver_bookings),
        "daily_calls_by_source": daily_calls_by_source(silver_bookings),
        "cpb_by_channel": cpb_by_channel(silver_spend, silver_bookings),
        "booking_trends": booking_trends(silver_bookings),
        "channel_attribution": campaign_cpb(silver_spend, silver_bookings),
        "booking_volume_by_time_slot": time_slot_by_channel(silver_bookings),
        "employee_meeting_load": employee_weekly_load(silver_bookings),
    }
