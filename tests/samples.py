"""Small inputs shared by the tests. People and ids are invented."""

from datetime import date

from adlake.fixed_values import BOOKING_SOURCE_SYSTEM, CHANNEL_BY_EVENT_TYPE

FACEBOOK, YOUTUBE, TIKTOK = CHANNEL_BY_EVENT_TYPE

BOOKING_SCHEMA = """booking_id string, channel string, booking_date date, meeting_date date,
  meeting_day_of_week string, meeting_hour int, meeting_week_start_date date,
  utm_campaign string, employee_id string, employee_name string, employee_email string"""

SPEND_SCHEMA = "spend_date date, channel string, spend_usd double"

FIRST_DAY, SECOND_DAY = date(2024, 3, 6), date(2024, 3, 7)
WEEK, NEXT_WEEK = date(2024, 3, 11), date(2024, 3, 18)
INES = ("e1", "Ines", "ines@example.com")
JON = ("e2", "Jon", "jon@example.com")
NOBODY = (None, None, None)

BOOKINGS = [
    ("a1", "facebook_paid_ads", FIRST_DAY, date(2024, 3, 11), "Monday", 8, WEEK, "spring_call", *INES),
    ("a2", "facebook_paid_ads", SECOND_DAY, date(2024, 3, 11), "Monday", 8, WEEK, "spring_call", *INES),
    ("a3", "youtube_paid_ads", FIRST_DAY, date(2024, 3, 12), "Tuesday", 15, WEEK, "retarget", *JON),
    ("a4", "tiktok_paid_ads", FIRST_DAY, date(2024, 3, 13), "Wednesday", 21, WEEK, None, *JON),
    ("a5", "tiktok_paid_ads", SECOND_DAY, date(2024, 3, 12), "Tuesday", 15, WEEK, "shorts", *INES),
    ("a6", "facebook_paid_ads", SECOND_DAY, date(2024, 3, 20), "Wednesday", 22, NEXT_WEEK, "retarget", *NOBODY),
]

# The amounts behind the published cost figures.
SPEND = [
    (FIRST_DAY, "facebook_paid_ads", 653.28),
    (FIRST_DAY, "youtube_paid_ads", 487.59),
    (FIRST_DAY, "tiktok_paid_ads", 345.12),
    (SECOND_DAY, "facebook_paid_ads", 700.0),
    (SECOND_DAY, "youtube_paid_ads", 500.0),
    (SECOND_DAY, "tiktok_paid_ads", 300.0),
]


def bookings(spark, extra=(), base=BOOKINGS):
    return spark.createDataFrame([*base, *extra], BOOKING_SCHEMA)


def spend(spark, extra=(), base=SPEND):
    return spark.createDataFrame([*base, *extra], SPEND_SCHEMA)


def booking(**changes):
    """One booking tuple, like a1 but for ``changes``."""
    names = [part.split()[0] for part in BOOKING_SCHEMA.split(",")]
    return tuple(changes.get(name, value) for name, value in zip(names, BOOKINGS[0]))


def webhook(number="1", *, event="invitee.created", kind=FACEBOOK, start="2025-10-08T13:30:00.000000Z", **payload):
    """A webhook event as the provider sends it."""
    meeting = {
        "uri": f"https://bookings.example/scheduled_events/meet-{number}",
        "name": "Intro call",
        "status": "active",
        "event_type": kind,
        "start_time": start,
        "end_time": "2025-10-08T14:15:00.000000Z",
        "created_at": "2025-10-08T07:41:18.000000Z",
        "updated_at": "2025-10-08T07:41:20.000000Z",
        "location": {"type": "custom", "location": None},
        "event_memberships": [
            {
                "user": "https://bookings.example/users/host-7",
                "user_name": "Ira Host",
                "user_email": "ira@example.com",
            }
        ],
    } | payload.pop("meeting", {})
    return {
        "event": event,
        "created_at": "2025-10-08T07:41:20.000000Z",
        "created_by": "https://bookings.example/users/owner",
        "payload": {
            "uri": f"https://bookings.example/scheduled_events/meet-{number}/invitees/book-{number}",
            "created_at": "2025-10-08T07:41:18.402155Z",
            "updated_at": "2025-10-08T07:41:18.402155Z",
            "email": "guest@example.com",
            "name": "Some Guest",
            "first_name": "Some",
            "last_name": "Guest",
            "timezone": "America/Bogota",
            "status": "active",
            "rescheduled": False,
            "unlisted_field": {"kept": True},
            "questions_and_answers": [
                {"question": "Company?", "answer": "Acme", "position": 0},
                {"question": "What is your PHONE number?", "answer": "+1 555 0100", "position": 1},
            ],
            "scheduled_event": meeting,
            "tracking": {"utm_source": "ads", "utm_campaign": None},
        }
        | payload,
    }


def envelope(event, key="bronze/k.json"):
    return {
        "source_system": BOOKING_SOURCE_SYSTEM,
        "ingestion_timestamp": "2025-10-08T07:42:00+00:00",
        "raw_s3_key": key,
        "raw_event": event,
    }
