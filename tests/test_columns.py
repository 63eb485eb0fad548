from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adlake.functions import columns as c


def one(spark, value, dtype, expression):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expression(F.col("v"))).head()[0]


@pytest.mark.parametrize(
    "uri, expected",
    [
        ("https://x.example/events/abc-123", "abc-123"),
        ("https://x.example/y/", "y"),
        ("https://x.example/y//", "y"),
        ("plain", "plain"),
        ("", None),
        ("///", None),
        (None, None),
    ],
)
def test_last_segment(spark, uri, expected):
    assert one(spark, uri, "string", c.last_segment) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-07-09T17:45:00.000000Z", datetime(2025, 7, 9, 17, 45)),
        ("2025-07-09T23:45:00-05:00", datetime(2025, 7, 10, 4, 45)),
        ("whenever", None),
        ("", None),
        (None, None),
    ],
)
def test_instant(spark, text, expected):
    shown = spark.createDataFrame([(text,)], "v string").select(c.instant(F.col("v")).cast("timestamp_ntz"))
    assert shown.head()[0] == expected


def test_calendar_parts(spark):
    ts = c.instant(F.lit("2025-07-13T23:30:00Z"))
    row = spark.range(1).select(
        c.calendar_date(ts), c.hour_of_day(ts), c.day_name(ts), c.week_start(ts)
    ).head()
    assert tuple(row) == (date(2025, 7, 13), 23, "Sunday", date(2025, 7, 7))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-07-09", date(2026, 7, 9)),
        ("2026-7-9", date(2026, 7, 9)),
        ("2026-07", None),
        ("2026-13-01", None),
        ("not-a-date", None),
        (None, None),
    ],
)
def test_plain_date(spark, text, expected):
    assert one(spark, text, "string", c.plain_date) == expected


def test_cents_round_half_up(spark):
    assert one(spark, 2.675, "double", c.cents) == 2.68
    assert one(spark, 653.284, "double", c.cents) == 653.28


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), 1e17])
def test_money_has_no_place_for(spark, amount):
    assert one(spark, amount, "double", c.money) is None


@pytest.mark.parametrize("total, count, expected", [(10.0, 3, 3.33), (0.0, 2, 0.0), (5.0, 0, None), (0.05, 2, 0.03)])
def test_cost_per(spark, total, count, expected):
    row = spark.range(1).select(c.cost_per(c.money(F.lit(total)), F.lit(count)))
    assert row.head()[0] == expected


def test_mean_count_ties_go_to_even(spark):
    row = spark.range(1).select(
        c.mean_count(F.lit(9), F.lit(8)), c.mean_count(F.lit(3), F.lit(2)), c.mean_count(F.lit(11), F.lit(8))
    )
    assert tuple(row.head()) == (1.12, 1.5, 1.38)


def test_lookup(spark):
    table = {"a": "one", "b": "two"}
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert [r[0] for r in df.select(c.lookup(F.col("v"), table)).collect()] == ["one", None, None]
    assert [r[0] for r in df.select(c.lookup(F.col("v"), {})).collect()] == [None] * 3
    assert [r[0] for r in df.select(c.titled_value(F.col("v"), table)).collect()] == ["one", "z", None]


def test_first_of_empty_array(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "v array<int>")
    assert [r[0] for r in df.select(c.first_of(F.col("v"))).collect()] == [1, None, None]


def test_safe_col(spark):
    df = spark.createDataFrame([((True, ("x",)),)], "p struct<canceled: boolean, q: struct<r: string>>")
    row = df.select(
        c.safe_col(df, "p.canceled", dtype="boolean").alias("a"),
        c.safe_col(df, "p.q.r").alias("b"),
        c.safe_col(df, "p.q.missing").alias("d"),
        c.safe_col(df, "nowhere.at.all", 7, "int").alias("e"),
        c.safe_col(df, "p.canceled.deeper").alias("f"),
    )
    assert tuple(row.head()) == (True, "x", None, 7, None)
    assert [t for _, t in row.dtypes] == ["boolean", "string", "string", "int", "string"]


def test_labels(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(c.column_or(df, "v", "none")).collect()] == ["a", "none", "none"]
    assert {r[0] for r in df.select(c.column_or(df, "w", "none")).collect()} == {"none"}


def test_answer_to(spark):
    asked = "v array<struct<question: string, answer: string>>"
    df = spark.createDataFrame(
        [([("Company?", "A"), ("Your Phone, please", "1"), ("phone again", "2")],), ([(None, "x")],), ([],), (None,)],
        asked,
    )
    assert [r[0] for r in df.select(c.answer_to(F.col("v"), "phone")).collect()] == ["1", None, None, None]


def test_settled_keeps_rows_and_types(spark):
    df = spark.range(3).withColumn("s", F.struct("id"))
    assert c.settled(df).schema.simpleString() == df.schema.simpleString()
    assert c.settled(df).collect() == df.collect()


def test_json_starts_with(spark):
    texts = spark.createDataFrame([("[1]",), (" \r\n\t[1]",), ('"["',), ("",), (None,)], "t string")
    assert [r[0] for r in texts.select(c.json_starts_with(texts.t, "[")).collect()] == [True, True, False, False, None]
