"""Booking-only gold tables. Every count is an exact distinct count of booking ids.

``count_distinct`` shuffles (key, id) pairs after a map-side pass that drops copies, so
neither a channel holding most rows nor an id delivered millions of times loads one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.fixed_values import (
    UNKNOWN_CAMPAIGN,
    UNKNOWN_EMPLOYEE_EMAIL,
    UNKNOWN_EMPLOYEE_ID,
    UNKNOWN_EMPLOYEE_NAME,
)
from adlake.functions import columns as c
from adlake.operators.grains import counts_at_grains
from adlake.operators.quality import (
    Rule,
    keep_valid,
    parsed,
    require_columns,
    required,
    with_reasons,
)

REQUIRED = [
    "booking_id",
    "channel",
    "booking_date",
    "meeting_date",
    "meeting_day_of_week",
    "meeting_hour",
]

_PARSED = ["booking_date", "meeting_date", "meeting_hour"]

GRAINS = {
    "daily_calls_by_source": ["booking_date", "channel"],
    "booking_trends": ["booking_date"],
    "channel_attribution": ["channel", "utm_campaign"],
    "booking_volume_by_time_slot": ["meeting_day_of_week", "meeting_hour"],
    "employee_meeting_load": ["employee_id", "employee_name", "employee_email"],
}

PARTITIONS = {"daily_calls_by_source": ["booking_date"], "booking_trends": ["booking_date"]}

CALLS = "booked_call_count"


def as_date(df: DataFrame, name: str) -> Column:
    """The date column ``name``; one held as text is parsed."""
    return c.plain_date(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name)


def _shaped(silver: DataFrame) -> DataFrame:
    require_columns(silver, REQUIRED, "silver bookings")
    return silver.select(
        F.col("booking_id").cast("string").alias("booking_id"),
        F.col("channel").cast("string").alias("channel"),
        as_date(silver, "booking_date").alias("booking_date"),
        as_date(silver, "meeting_date").alias("meeting_date"),
        F.col("meeting_day_of_week").cast("string").alias("meeting_day_of_week"),
        F.col("meeting_hour").try_cast("int").alias("meeting_hour"),
        c.column_or(silver, "utm_campaign", UNKNOWN_CAMPAIGN).alias("utm_campaign"),
        c.column_or(silver, "employee_id", UNKNOWN_EMPLOYEE_ID).alias("employee_id"),
        c.column_or(silver, "employee_name", UNKNOWN_EMPLOYEE_NAME).alias("employee_name"),
        c.column_or(silver, "employee_email", UNKNOWN_EMPLOYEE_EMAIL).alias("employee_email"),
        *(F.col(name).alias(f"_{name}") for name in _PARSED),
    )


def _rules() -> list[Rule]:
    hour = F.col("meeting_hour")
    return [
        *required("booking_id", "channel", "meeting_day_of_week"),
        *chain.from_iterable(parsed(name, f"_{name}") for name in _PARSED),
        Rule("meeting_hour_out_of_range", hour.isNull() | hour.between(0, 23)),
    ]


def valid_bookings(silver: DataFrame) -> DataFrame:
    """The rows that booking-only tables count, with missing labels filled."""
    return keep_valid(_shaped(silver), _rules()).drop(*(f"_{name}" for name in _PARSED))


def checked_bookings(silver: DataFrame) -> DataFrame:
    """Every row with the reasons that keep it out of the booking tables."""
    written = {f"_{name}": f"written_{name}" for name in _PARSED}
    return with_reasons(_shaped(silver), _rules()).withColumnsRenamed(written)


def _calls_by(silver: DataFrame, table: str) -> DataFrame:
    counted = F.count_distinct("booking_id").alias(CALLS)
    return valid_bookings(silver).groupBy(*GRAINS[table]).agg(counted)


def daily_calls_by_source(silver: DataFrame) -> DataFrame:
    return _calls_by(silver, "daily_calls_by_source")


def booking_trends(silver: DataFrame) -> DataFrame:
    return _calls_by(silver, "booking_trends")


def channel_attribution(silver: DataFrame) -> DataFrame:
    return _calls_by(silver, "channel_attribution")


def booking_volume_by_time_slot(silver: DataFrame) -> DataFrame:
    return _calls_by(silver, "booking_volume_by_time_slot")


def employee_meeting_load(silver: DataFrame) -> DataFrame:
    return _calls_by(silver, "employee_meeting_load")


def booking_dashboard_kpis(silver: DataFrame) -> DataFrame:
    return valid_bookings(silver).agg(
        F.count_distinct("booking_id").alias("total_bookings"),
        F.count_distinct("channel").alias("channel_count"),
        F.count_distinct("booking_date").alias("booking_date_count"),
        F.count_distinct("meeting_date").alias("meeting_date_count"),
    )


CUBE = {**GRAINS, "meeting_dates": ["meeting_date"], "everything": []}


def booking_cube(silver: DataFrame, heavy: Sequence[str] = ()) -> DataFrame:
    """Distinct bookings at every gold grain from one scan.

    Rows carry ``grain``, the name of the table they belong to. The result is as small as the
    gold tables together, so a job stages it once and derives each table from it. ``heavy`` are
    ids with very many different rows (see ``grains.heavy_ids``).
    """
    return counts_at_grains(valid_bookings(silver), "booking_id", CUBE, CALLS, heavy)


def tables_from_cube(cube: DataFrame) -> dict[str, DataFrame]:
    """The six booking tables out of :func:`booking_cube`."""
    tables = {
        name: cube.where(F.col("grain") == name).select(*keys, CALLS)
        for name, keys in GRAINS.items()
    }

    def having(name: str, value: Column | None = None) -> Column:
        return F.when(F.col("grain") == name, F.lit(1) if value is None else value)

    tables["booking_dashboard_kpis"] = cube.agg(
        F.coalesce(F.max(having("everything", F.col(CALLS))), F.lit(0)).alias("total_bookings"),
        F.count_distinct(having("daily_calls_by_source", F.col("channel"))).alias("channel_count"),
        F.count(having("booking_trends")).alias("booking_date_count"),
        F.count(having("meeting_dates")).alias("meeting_date_count"),
    )
    return tables


def booking_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """All booking tables, each its own lazy query over ``silver``."""
    return {name: _calls_by(silver, name) for name in GRAINS} | {
        "booking_dashboard_kpis": booking_dashboard_kpis(silver)
    }
