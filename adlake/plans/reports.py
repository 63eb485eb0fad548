"""Reader queries over gold tables: orderings, pivots and presentation labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.fixed_values import CHANNEL_TITLES, COLUMN_TITLES
from adlake.functions import columns as c
from adlake.operators.places import ranked, with_places

CPB = "cost_per_booking_usd"
CALLS = "booked_call_count"

COLUMNS = {
    "combined_dashboard_kpis": [
        "total_spend_usd", "total_bookings", "average_cost_per_booking_usd",
        "channel_count", "spend_date_count", "booking_date_count", "gold_processed_at",
    ],
    "cpb_by_channel": ["channel", "total_spend_usd", CALLS, CPB],
    "daily_cpb_by_channel": ["metric_date", "channel", "total_spend_usd", CALLS, CPB],
    "daily_calls_by_source": ["booking_date", "channel", CALLS],
    "booking_trends": ["booking_date", CALLS],
    "channel_attribution": ["channel", "utm_campaign", CALLS],
    "booking_volume_by_time_slot": ["meeting_day_of_week", "meeting_hour", CALLS],
    "employee_meeting_load": ["employee_id", "employee_name", "employee_email", CALLS],
}

# (column, descending); NULLs come last either way
ORDERINGS = {
    "cpb_by_channel": [(CPB, False)],
    "daily_cpb_by_channel": [("metric_date", False), ("channel", False)],
    "daily_calls_by_source": [("booking_date", False), ("channel", False)],
    "booking_trends": [("booking_date", False)],
    "channel_attribution": [(CALLS, True), ("channel", False), ("utm_campaign", False)],
    "booking_volume_by_time_slot": [
        (CALLS, True), ("meeting_day_of_week", False), ("meeting_hour", False),
    ],
    "employee_meeting_load": [(CALLS, True), ("employee_name", False)],
}


def report(gold: DataFrame, table: str) -> DataFrame:
    """The gold table as readers see it: its report columns in its report order."""
    shown = gold.select([name for name in COLUMNS[table] if name in gold.columns])
    order = _order(table)
    return shown.orderBy(*order) if order else shown


def _order(table: str) -> list[Column]:
    return [
        F.desc_nulls_last(name) if descending else F.asc_nulls_last(name)
        for name, descending in ORDERINGS.get(table, [])
    ]


def report_with_places(gold: DataFrame, table: str) -> DataFrame:
    """The report's rows with the place of each in the report's order, equal keys sharing the
    first, for readers that page through it. No task sees all rows."""
    shown = gold.select([name for name in COLUMNS[table] if name in gold.columns])
    if table not in ORDERINGS:
        return shown
    return ranked(with_places(shown, *_order(table)), *(key for key, _ in ORDERINGS[table]))


def by_keys(gold: DataFrame, *keys: str) -> DataFrame:
    """Rows in key order."""
    return gold.orderBy(*keys)


def calls_pivot(
    daily_calls: DataFrame,
    channels: Sequence[str] | None = None,
    titles: Mapping[str, str] = CHANNEL_TITLES,
) -> DataFrame:
    """Calls per day with a column per channel, 0 where a channel had none. Naming the
    channels spares the extra query that finds them."""
    titled = daily_calls.withColumn("channel", c.titled_value(F.col("channel"), titles))
    wanted = [titles.get(name, name) for name in channels] if channels else None
    pivoted = titled.groupBy("booking_date").pivot("channel", wanted).agg(F.sum(CALLS))
    return pivoted.fillna(0)


def priced_rows(daily_cpb: DataFrame) -> DataFrame:
    """Rows that have a cost per booking, as charts need."""
    return daily_cpb.dropna(subset=[CPB])


def cpb_pivot(
    daily_cpb: DataFrame,
    channels: Sequence[str] | None = None,
    titles: Mapping[str, str] = CHANNEL_TITLES,
) -> DataFrame:
    """Mean cost per booking per day with a column per channel, NULL where there is none."""
    titled = priced_rows(daily_cpb).withColumn(
        "channel", c.titled_value(F.col("channel"), titles)
    )
    wanted = [titles.get(name, name) for name in channels] if channels else None
    return titled.groupBy("metric_date").pivot("channel", wanted).agg(F.avg(CPB))


def with_titles(df: DataFrame) -> DataFrame:
    """Presentation column names."""
    return c.titled(df, COLUMN_TITLES)


def with_chart_titles(df: DataFrame) -> DataFrame:
    """Presentation column names and channel names."""
    if "channel" in df.columns:
        df = df.withColumn("channel", c.titled_value(F.col("channel"), CHANNEL_TITLES))
    return with_titles(df)
