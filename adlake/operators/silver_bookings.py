"""Bronze webhook events to silver bookings: one row per event, flat and typed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.fixed_values import CHANNEL_BY_EVENT_TYPE, WANTED_WEBHOOK_EVENT
from adlake.functions import columns as c
from adlake.operators.quality import Rule, keep_valid, parsed, required, valid_rows, with_reasons
from adlake.schemas import WEBHOOK_EVENT

PARTITION = "meeting_date"

MEMBERS = "array<struct<user: string, user_name: string, user_email: string>>"
QUESTIONS = "array<struct<question: string, answer: string, position: int>>"

COLUMNS = [
    "webhook_event", "webhook_created_at", "webhook_created_by",
    "booking_id", "invitee_uri", "booking_created_at", "booking_date", "booking_updated_at",
    "invitee_email", "invitee_name", "invitee_first_name", "invitee_last_name",
    "invitee_phone", "invitee_timezone", "invitee_status", "invitee_canceled",
    "invitee_cancel_reason", "rescheduled",
    "scheduled_event_id", "scheduled_event_uri", "scheduled_event_name",
    "scheduled_event_status", "event_type_uri", "channel",
    "meeting_created_at", "meeting_updated_at", "meeting_start_time", "meeting_end_time",
    "meeting_date", "meeting_day_of_week", "meeting_hour", "meeting_week_start_date",
    "meeting_location_type", "meeting_location",
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "salesforce_uuid",
    "employee_uri", "employee_id", "employee_name", "employee_email",
    "bronze_source_system", "bronze_ingestion_timestamp", "bronze_raw_s3_key",
    "bronze_source_file_path",
]


def rules() -> list[Rule]:
    return [
        Rule("corrupt_record", F.col("_corrupt_record").isNull()),
        Rule("missing_raw_event", F.col("_has_event")),
        Rule("unsupported_event", F.col("webhook_event") == WANTED_WEBHOOK_EVENT),
        Rule("missing_payload", F.col("_has_payload")),
        Rule("missing_scheduled_event", F.col("_has_meeting")),
        *required("booking_id", "scheduled_event_id", "event_type_uri"),
        Rule("unmapped_channel", F.col("channel").isNotNull()),
        *parsed("meeting_date", "meeting_start_time"),
    ]


def _event(bronze: DataFrame) -> Column:
    event = c.safe_col(bronze, "raw_event", dtype=WEBHOOK_EVENT)
    if dict(bronze.dtypes).get("raw_event") == "variant":
        return F.from_json(event.cast("string"), WEBHOOK_EVENT)
    return event


def flatten(bronze: DataFrame, channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE) -> DataFrame:
    """All bronze rows in silver shape, good or not, plus what the rules need to judge them."""
    events = bronze.select(
        c.safe_col(bronze, "source_system").alias("bronze_source_system"),
        c.safe_col(bronze, "ingestion_timestamp").alias("bronze_ingestion_timestamp"),
        c.safe_col(bronze, "raw_s3_key").alias("bronze_raw_s3_key"),
        c.safe_col(bronze, "source_file_path").alias("bronze_source_file_path"),
        c.safe_col(bronze, "_corrupt_record").alias("_corrupt_record"),
        _event(bronze).alias("event"),
    )

    def at(path: str, dtype: str = "string") -> Column:
        return c.safe_col(events, f"event.{path}", dtype=dtype)

    def booking(path: str, dtype: str = "string") -> Column:
        return at(f"payload.{path}", dtype)

    def meeting(path: str, dtype: str = "string") -> Column:
        return at(f"payload.scheduled_event.{path}", dtype)

    def tracking(name: str) -> Column:
        return booking(f"tracking.{name}").cast("string").alias(name)

    starts = c.instant(meeting("start_time"))
    host = c.first_of(meeting("event_memberships", MEMBERS))
    text = {
        "webhook_event": at("event"),
        "webhook_created_at": at("created_at"),
        "webhook_created_by": at("created_by"),
        "booking_id": c.last_segment(booking("uri")),
        "invitee_uri": booking("uri"),
        "booking_created_at": booking("created_at"),
        "booking_updated_at": booking("updated_at"),
        "invitee_email": booking("email"),
        "invitee_name": booking("name"),
        "invitee_first_name": booking("first_name"),
        "invitee_last_name": booking("last_name"),
        "invitee_phone": c.answer_to(booking("questions_and_answers", QUESTIONS), "phone"),
        "invitee_timezone": booking("timezone"),
        "invitee_status": booking("status"),
        "invitee_cancel_reason": booking("cancel_reason"),
        "scheduled_event_id": c.last_segment(meeting("uri")),
        "scheduled_event_uri": meeting("uri"),
        "scheduled_event_name": meeting("name"),
        "scheduled_event_status": meeting("status"),
        "event_type_uri": meeting("event_type"),
        "channel": c.lookup(meeting("event_type"), channels),
        "meeting_created_at": meeting("created_at"),
        "meeting_updated_at": meeting("updated_at"),
        "meeting_start_time": meeting("start_time"),
        "meeting_end_time": meeting("end_time"),
        "meeting_location_type": meeting("location.type"),
        "meeting_location": meeting("location.location"),
        "employee_uri": host["user"],
        "employee_id": c.last_segment(host["user"]),
        "employee_name": host["user_name"],
        "employee_email": host["user_email"],
    }
    return events.select(
        *(expr.cast("string").alias(name) for name, expr in text.items()),
        *map(tracking, ["utm_source", "utm_medium", "utm_campaign"]),
        *map(tracking, ["utm_content", "utm_term", "salesforce_uuid"]),
        booking("canceled", "boolean").alias("invitee_canceled"),
        booking("rescheduled", "boolean").alias("rescheduled"),
        c.calendar_date(c.instant(booking("created_at"))).alias("booking_date"),
        c.calendar_date(starts).alias("meeting_date"),
        c.day_name(starts).alias("meeting_day_of_week"),
        c.hour_of_day(starts).alias("meeting_hour"),
        c.week_start(starts).alias("meeting_week_start_date"),
        F.col("event").isNotNull().alias("_has_event"),
        at("payload").isNotNull().alias("_has_payload"),
        booking("scheduled_event").isNotNull().alias("_has_meeting"),
        "bronze_source_system",
        "bronze_ingestion_timestamp",
        "bronze_raw_s3_key",
        "bronze_source_file_path",
        "_corrupt_record",
    )


def bookings(bronze: DataFrame, channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE) -> DataFrame:
    """Valid silver bookings."""
    return keep_valid(flatten(bronze, channels), rules()).select(COLUMNS)


def checked_bookings(
    bronze: DataFrame, channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE
) -> DataFrame:
    """Every bronze row in silver shape with its reject reasons."""
    checked = with_reasons(flatten(bronze, channels), rules())
    return checked.select(*COLUMNS, "_corrupt_record", "reject_reasons")


def accepted(checked: DataFrame) -> DataFrame:
    return valid_rows(checked).select(COLUMNS)
