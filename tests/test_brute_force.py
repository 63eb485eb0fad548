"""Gold tables against plain-Python counting on random rows, heavily skewed ones included."""

from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adlake.operators import gold_bookings, gold_combined
from tests.samples import BOOKING_SCHEMA, SPEND_SCHEMA

DAY = date(2026, 1, 1)
maybe = lambda values: st.sampled_from([*values, None])
days = maybe([DAY + timedelta(n) for n in range(3)])
# "hot" stands for one id, and "big" for one channel, that hold much of the input
ids = st.one_of(st.just("hot"), st.sampled_from([f"b{n}" for n in range(12)]), st.none())
channels = st.one_of(st.just("big"), maybe(["small", "tiny"]))

booking_rows = st.lists(
    st.tuples(
        ids, channels, days, days, maybe(["Monday", "Friday"]), st.sampled_from([None, 0, 9, 23, 24]),
        days, maybe(["", "summer"]), maybe(["e1", "e2"]), maybe(["Maya"]), maybe(["m@example.com"]),
    ),
    max_size=40,
)
amounts = st.one_of(st.none(), st.integers(-200, 20000).map(lambda cents: cents / 100))
spend_rows = st.lists(st.tuples(days, channels, amounts), max_size=30)


def ratio(total, count):
    if not count:
        return None
    return float((total / count).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def distinct(rows, key):
    groups = defaultdict(set)
    for row in rows:
        groups[key(row)].add(row[0])
    return {k: len(v) for k, v in groups.items()}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(booked=booking_rows, spent=spend_rows)
def test_gold_tables(spark, booked, spent):
    bookings = spark.createDataFrame(booked, BOOKING_SCHEMA)
    spend = spark.createDataFrame(spent, SPEND_SCHEMA)

    valid = [r for r in booked if None not in r[:6] and 0 <= r[5] <= 23]
    cube = gold_bookings.tables_from_cube(gold_bookings.booking_cube(bookings))
    keys = {
        "daily_calls_by_source": lambda r: (r[2], r[1]),
        "booking_trends": lambda r: (r[2],),
        "channel_attribution": lambda r: (r[1], r[7] or "unknown_campaign"),
        "booking_volume_by_time_slot": lambda r: (r[4], r[5]),
        "employee_meeting_load": lambda r: (
            r[8] or "unknown_employee",
            r[9] or "Unknown Employee",
            r[10] or "unknown_email",
        ),
    }
    for name, key in keys.items():
        expected = distinct(valid, key)
        for table in (cube[name], gold_bookings.booking_tables(bookings)[name]):
            assert {tuple(row)[:-1]: row[-1] for row in table.collect()} == expected
    kpis = tuple(len({r[i] for r in valid}) for i in (0, 1, 2, 3))
    assert tuple(cube["booking_dashboard_kpis"].head()) == kpis
    assert tuple(gold_bookings.booking_dashboard_kpis(bookings).head()) == kpis

    counted = [r for r in booked if None not in r[:3]]
    money = [r for r in spent if None not in r and r[2] >= 0]
    bundle = gold_combined.tables_from_cube(gold_combined.combined_cube(spend, bookings))
    single = gold_combined.combined_tables(spend, bookings)
    for name, b_key, s_key in [
        ("cpb_by_channel", lambda r: (r[1],), lambda r: (r[1],)),
        ("daily_cpb_by_channel", lambda r: (r[2], r[1]), lambda r: (r[0], r[1])),
    ]:
        totals = defaultdict(Decimal)
        for row in money:
            totals[s_key(row)] += Decimal(str(row[2]))
        calls = distinct(counted, b_key)
        expected = {
            k: (float(totals.get(k, 0)), calls.get(k, 0), ratio(totals.get(k, Decimal(0)), calls.get(k)))
            for k in {*totals, *calls}
        }
        for table in (bundle[name], single[name]):
            assert {tuple(row)[:-3]: tuple(row)[-3:] for row in table.collect()} == expected
    total, ids_seen = sum((Decimal(str(r[2])) for r in money), Decimal(0)), {r[0] for r in counted}
    expected = (
        float(total), len(ids_seen), ratio(total, len(ids_seen)),
        len({r[1] for r in money} | {r[1] for r in counted}),
        len({r[0] for r in money}), len({r[2] for r in counted}),
    )
    assert tuple(bundle["combined_dashboard_kpis"].head()) == expected
    assert tuple(single["combined_dashboard_kpis"].head()) == expected
