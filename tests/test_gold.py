from datetime import date

import pytest

from adlake.operators import gold_bookings, gold_combined, gold_extra, gold_spend
from adlake.operators.quality import rejected_rows
from tests.samples import (
    BOOKING_SCHEMA,
    FIRST_DAY,
    SECOND_DAY,
    SPEND_SCHEMA,
    booking,
    bookings,
    spend,
)


def test_booking_tables(spark, rows):
    tables = gold_bookings.booking_tables(bookings(spark))
    expected = {
        "daily_calls_by_source": [
            (FIRST_DAY, "facebook_paid_ads", 1),
            (FIRST_DAY, "tiktok_paid_ads", 1),
            (FIRST_DAY, "youtube_paid_ads", 1),
            (SECOND_DAY, "facebook_paid_ads", 2),
            (SECOND_DAY, "tiktok_paid_ads", 1),
        ],
        "booking_trends": [(FIRST_DAY, 3), (SECOND_DAY, 3)],
        "channel_attribution": [
            ("facebook_paid_ads", "retarget", 1),
            ("facebook_paid_ads", "spring_call", 2),
            ("tiktok_paid_ads", "shorts", 1),
            ("tiktok_paid_ads", "unknown_campaign", 1),
            ("youtube_paid_ads", "retarget", 1),
        ],
        "booking_volume_by_time_slot": [
            ("Monday", 8, 2),
            ("Tuesday", 15, 2),
            ("Wednesday", 21, 1),
            ("Wednesday", 22, 1),
        ],
        "employee_meeting_load": [
            ("e1", "Ines", "ines@example.com", 3),
            ("e2", "Jon", "jon@example.com", 2),
            ("unknown_employee", "Unknown Employee", "unknown_email", 1),
        ],
        "booking_dashboard_kpis": [(6, 3, 2, 4)],
    }
    assert {name: rows(table) for name, table in tables.items()} == expected
    cut = gold_bookings.tables_from_cube(gold_bookings.booking_cube(bookings(spark)))
    assert {name: rows(table) for name, table in cut.items()} == expected
    assert {n: t.dtypes for n, t in cut.items()} == {n: t.dtypes for n, t in tables.items()}


def test_empty_bookings(spark, rows):
    empty = bookings(spark, base=[])
    assert rows(gold_bookings.booking_dashboard_kpis(empty)) == [(0, 0, 0, 0)]
    cut = gold_bookings.tables_from_cube(gold_bookings.booking_cube(empty))
    assert rows(cut["booking_dashboard_kpis"]) == [(0, 0, 0, 0)]
    assert rows(cut["booking_trends"]) == []


@pytest.mark.parametrize(
    "field", ["booking_id", "channel", "booking_date", "meeting_date", "meeting_day_of_week", "meeting_hour"]
)
def test_bookings_need(spark, field):
    frame = bookings(spark, [booking(**{field: None})], base=[])
    assert gold_bookings.valid_bookings(frame).count() == 0
    bad = rejected_rows(gold_bookings.checked_bookings(frame)).head()
    assert bad.reject_reasons == [f"missing_{field}"]


@pytest.mark.parametrize("hour, kept", [(-1, 0), (0, 1), (23, 1), (24, 0)])
def test_hour_range(spark, hour, kept):
    assert gold_bookings.valid_bookings(bookings(spark, [booking(meeting_hour=hour)], base=[])).count() == kept


def test_missing_columns_fail_at_once(spark):
    with pytest.raises(ValueError, match=r"\['booking_date', 'meeting_hour'\]"):
        gold_bookings.booking_trends(bookings(spark).drop("meeting_hour", "booking_date"))
    with pytest.raises(ValueError, match=r"silver spend is missing columns: \['spend_usd'\]"):
        gold_spend.daily_spend_by_channel(spend(spark).drop("spend_usd"))
    with pytest.raises(ValueError, match=r"\['booking_id'\]"):
        gold_combined.cpb_by_channel(spend(spark), bookings(spark).drop("booking_id"))


def test_optional_columns(spark, rows):
    bare = bookings(spark).drop("utm_campaign", "employee_id", "employee_name", "employee_email")
    load = rows(gold_bookings.employee_meeting_load(bare))
    assert load == [("unknown_employee", "Unknown Employee", "unknown_email", 6)]
    assert {r[1] for r in rows(gold_bookings.channel_attribution(bare))} == {"unknown_campaign"}
    blank = bookings(spark, [booking(booking_id="b9", utm_campaign="", employee_name="")], base=[])
    assert rows(gold_bookings.channel_attribution(blank))[0][1] == "unknown_campaign"
    assert rows(gold_bookings.employee_meeting_load(blank))[0][1] == "Unknown Employee"


def test_dates_and_hours_held_as_text(spark, rows):
    text = spark.createDataFrame(
        [("b1", "c", "2024-03-06", "2024-03-11", "Monday", "17"),
         ("b2", "c", "06.03.2024", "2024-03-11", "Monday", "17"),
         ("b3", "c", "2024-03-06", "2024-03-11", "Monday", "late")],
        "booking_id string, channel string, booking_date string, meeting_date string, meeting_day_of_week string, meeting_hour string",
    )
    assert rows(gold_bookings.booking_trends(text)) == [(FIRST_DAY, 1)]
    bad = {r.booking_id: r.reject_reasons for r in rejected_rows(gold_bookings.checked_bookings(text)).collect()}
    assert bad == {"b2": ["invalid_booking_date"], "b3": ["invalid_meeting_hour"]}


def test_spend_tables(spark, rows):
    tables = gold_spend.spend_tables(spend(spark, [(FIRST_DAY, "radio", 100.0), (FIRST_DAY, "radio", 50.25)]))
    assert (FIRST_DAY, "radio", 150.25) in rows(tables["daily_spend_by_channel"])
    assert rows(tables["channel_spend_summary"]) == [
        ("facebook_paid_ads", 1353.28, 2, 676.64),
        ("radio", 150.25, 1, 150.25),
        ("tiktok_paid_ads", 645.12, 2, 322.56),
        ("youtube_paid_ads", 987.59, 2, 493.8),
    ]


def test_spend_rules(spark, rows):
    odd = [
        (None, "c", 1.0), (FIRST_DAY, None, 1.0), (FIRST_DAY, "c", None), (FIRST_DAY, "c", -1.0),
        (FIRST_DAY, "c", float("nan")), (FIRST_DAY, "c", 1e17), (FIRST_DAY, "c", -0.004), (FIRST_DAY, "c", -0.005),
    ]
    frame = spend(spark, odd, base=[])
    assert rows(gold_spend.daily_spend_by_channel(frame)) == [(FIRST_DAY, "c", 0.0)]
    reasons = sorted(r.reject_reasons[0] for r in rejected_rows(gold_spend.checked_spend(frame)).collect())
    assert reasons == [
        "invalid_spend_usd", "invalid_spend_usd", "missing_channel", "missing_spend_date",
        "missing_spend_usd", "negative_spend_usd", "negative_spend_usd",
    ]
    text = frame.withColumn("spend_usd", frame.spend_usd.cast("string"))
    assert rows(gold_spend.daily_spend_by_channel(text)) == [(FIRST_DAY, "c", 0.0)]


def test_combined_tables(spark, rows):
    expected = {
        "cpb_by_channel": [
            ("facebook_paid_ads", 1353.28, 3, 451.09),
            ("tiktok_paid_ads", 645.12, 2, 322.56),
            ("youtube_paid_ads", 987.59, 1, 987.59),
        ],
        "daily_cpb_by_channel": [
            (FIRST_DAY, "facebook_paid_ads", 653.28, 1, 653.28),
            (FIRST_DAY, "tiktok_paid_ads", 345.12, 1, 345.12),
            (FIRST_DAY, "youtube_paid_ads", 487.59, 1, 487.59),
            (SECOND_DAY, "facebook_paid_ads", 700.0, 2, 350.0),
            (SECOND_DAY, "tiktok_paid_ads", 300.0, 1, 300.0),
            (SECOND_DAY, "youtube_paid_ads", 500.0, 0, None),
        ],
        # 2985.99 / 6 is 497.665, which half up makes 497.67
        "combined_dashboard_kpis": [(2985.99, 6, 497.67, 3, 2, 2)],
    }
    inputs = spend(spark), bookings(spark, [booking()])  # a1 once more
    tables = gold_combined.combined_tables(*inputs)
    assert {name: rows(table) for name, table in tables.items()} == expected
    cut = gold_combined.tables_from_cube(gold_combined.combined_cube(*inputs))
    assert {name: rows(table) for name, table in cut.items()} == expected
    assert {n: t.dtypes for n, t in cut.items()} == {n: t.dtypes for n, t in tables.items()}
    assert rows(gold_combined.dashboard_kpis(*inputs)) == [(6, 2985.99, 497.67)]


@pytest.mark.parametrize("build", ["tables", "cube"])
def test_one_sided_inputs(spark, rows, build):
    def tables(*inputs):
        if build == "tables":
            return gold_combined.combined_tables(*inputs)
        return gold_combined.tables_from_cube(gold_combined.combined_cube(*inputs))

    only_spend = tables(spend(spark), bookings(spark, base=[]))
    assert rows(only_spend["combined_dashboard_kpis"]) == [(2985.99, 0, None, 3, 2, 0)]
    assert {r[3] for r in rows(only_spend["cpb_by_channel"])} == {None}
    only_bookings = tables(spend(spark, base=[]), bookings(spark))
    assert rows(only_bookings["combined_dashboard_kpis"]) == [(0.0, 6, 0.0, 3, 0, 2)]
    assert {r[1:] for r in rows(only_bookings["cpb_by_channel"])} == {(0.0, 1, 0.0), (0.0, 2, 0.0), (0.0, 3, 0.0)}
    neither = tables(spend(spark, base=[]), bookings(spark, base=[]))
    assert rows(neither["combined_dashboard_kpis"]) == [(0.0, 0, None, 0, 0, 0)]
    assert rows(neither["daily_cpb_by_channel"]) == []


def test_combined_counts_bookings_without_meeting_time(spark, rows):
    odd = bookings(spark, [booking(booking_id="b5", meeting_hour=None)])
    assert rows(gold_combined.cpb_by_channel(spend(spark), odd))[0][2] == 4
    assert rows(gold_bookings.daily_calls_by_source(odd))[0][2] == 1


def test_channels_in_use(spark, rows):
    other = spend(spark, [(FIRST_DAY, "radio", 1.0)], base=[])
    assert len(rows(gold_combined.channels_in_use(other, bookings(spark)))) == 4


def test_campaign_cpb(spark, rows):
    june = date(2026, 6, 1)
    booked = bookings(spark, [
        booking(booking_id="x1", channel="fb", utm_campaign="one"),
        booking(booking_id="x2", channel="fb", utm_campaign="one"),
        booking(booking_id="x3", channel="fb", utm_campaign=None),
        booking(booking_id="x4", channel="yt", utm_campaign="two"),
        booking(booking_id=None, channel="yt"), booking(booking_id="x6", channel=None),
    ], base=[])
    spent = spend(spark, [(june, "fb", 200.0), (june, "fb", 250.0), (june, "radio", 9.0)], base=[])
    assert rows(gold_extra.campaign_cpb(spent, booked)) == [
        ("fb", "one", 2, 450.0, 225.0),
        ("fb", "unknown_campaign", 1, 450.0, 450.0),
        ("yt", "two", 1, 0.0, 0.0),
    ]


def test_time_slot_by_channel(spark, rows):
    doubled = bookings(spark, [booking(), booking(booking_id="b7", meeting_hour=None)])
    assert rows(gold_extra.time_slot_by_channel(doubled)) == [
        ("Monday", 8, "facebook_paid_ads", 2),
        ("Tuesday", 15, "tiktok_paid_ads", 1),
        ("Tuesday", 15, "youtube_paid_ads", 1),
        ("Wednesday", 21, "tiktok_paid_ads", 1),
        ("Wednesday", 22, "facebook_paid_ads", 1),
    ]


def test_employee_weekly_load(spark, rows):
    w1, w2 = date(2026, 7, 6), date(2026, 7, 13)
    frame = bookings(spark, [
        booking(booking_id="x1", meeting_week_start_date=w1, employee_name="Maya"),
        booking(booking_id="x2", meeting_week_start_date=w1, employee_name=""),
        booking(booking_id="x3", meeting_week_start_date=w2, booking_date=SECOND_DAY, employee_name="Maya B."),
        booking(booking_id="x3", meeting_week_start_date=w2, employee_name="Maya"),
        booking(booking_id="x4", meeting_week_start_date=None),
        booking(booking_id="x5", employee_id=""),
        booking(booking_id="x6", employee_id="e9", employee_name=None, meeting_week_start_date=w1),
    ], base=[])
    assert rows(gold_extra.employee_weekly_load(frame)) == [
        ("e1", "Maya B.", 3, 2, 1.5),
        ("e9", None, 1, 1, 1.0),
    ]


def test_schemas(spark):
    tables = gold_combined.combined_tables(spend(spark), bookings(spark))
    assert tables["daily_cpb_by_channel"].dtypes == [
        ("metric_date", "date"),
        ("channel", "string"),
        ("total_spend_usd", "double"),
        ("booked_call_count", "bigint"),
        ("cost_per_booking_usd", "double"),
    ]
    assert BOOKING_SCHEMA and SPEND_SCHEMA
