"""Counts merged from bitmaps against distinct counts of all that was ever delivered."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from adlake.operators import bitmaps, gold_bookings
from adlake.operators.places import placed, ranked, with_places
from adlake.sources.readers import read_table
from adlake.sources.versions import Pending, current
from adlake.streaming.jobs import take_in_bookings
from tests.samples import BOOKING_SCHEMA, WEEK


def booking(i, draw):
    day = date(2024, 3, 1) + timedelta(days=draw.randrange(4))
    slot = draw.choice([("Monday", 8), ("Tuesday", 15)])
    who = draw.choice([("e1", "Ines", "i@x"), ("e2", "Jon", "j@x"), (None, None, None)])
    return (f"b{i}", draw.choice(["a", "b", "c"]), day, WEEK, *slot, WEEK, draw.choice(["x", None]), *who)


def deliveries(seed=3):
    draw = random.Random(seed)
    rows = [booking(draw.randrange(60), draw) for _ in range(200)]  # ids repeat, also under other keys
    rows += [(None, *rows[0][1:]), ("bad", None, *rows[0][2:])]
    return rows[:80], rows[40:130], rows[:20] + rows[130:], []


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_counts_equal_distinct_counts_after_every_delivery(spark, tmp_path):
    seen, root, gold = [], str(tmp_path / "bitmaps"), str(tmp_path / "gold")
    for batch in deliveries():
        seen += batch
        frame = spark.createDataFrame(batch, BOOKING_SCHEMA)
        if batch:
            take_in_bookings(spark, frame, root, gold, fmt="parquet")
        everything = spark.createDataFrame(seen, BOOKING_SCHEMA)
        want = gold_bookings.booking_tables(everything)
        got = gold_bookings.tables_from_cube(bitmaps.cube_of(bitmaps.kept_bitmaps(spark, root)))
        for name in want:
            assert rows_of(got[name].select(want[name].columns)) == rows_of(want[name]), name
        for name in ("daily_calls_by_source", "booking_trends"):
            stored = read_table(spark, f"{gold}/{name}", "parquet").select(want[name].columns)
            assert rows_of(stored) == rows_of(want[name])


def test_a_batch_that_dies_and_is_run_again(spark, tmp_path, monkeypatch):
    """Before each commit: numbers, then bitmaps."""
    root = str(tmp_path / "b")
    first, second, *_ = deliveries(5)
    for batch in (first, second):
        frame = spark.createDataFrame(batch, BOOKING_SCHEMA)
        for dies_at in (0, 1):
            left, plain = [dies_at], Pending.commit

            def commit(self, keep=2, left=left, plain=plain):
                if not left[0]:
                    raise OSError("gone")
                left[0] -= 1
                return plain(self, keep)

            monkeypatch.setattr(Pending, "commit", commit)
            # the second time round numbers are there, so that only bitmaps are committed
            with pytest.raises(OSError, match="gone"), bitmaps.added_bookings(frame, root):
                pass
            monkeypatch.undo()
            if dies_at == 0 and current(spark, f"{root}/numbers") is None:
                with bitmaps.added_bookings(frame, root):
                    pass
                break
        with bitmaps.added_bookings(frame, root):
            pass
    everything = spark.createDataFrame(first + second, BOOKING_SCHEMA)
    cube = bitmaps.cube_of(bitmaps.kept_bitmaps(spark, root))
    assert cube.where("grain = 'everything'").first().booked_call_count == everything.where("channel IS NOT NULL").agg(F.count_distinct("booking_id")).first()[0]


def test_numbers_are_dense_and_stay(spark, tmp_path):
    path = str(tmp_path / "n")
    ids = spark.range(1000).select(F.concat(F.lit("b"), F.col("id") % 300).alias("booking_id"))
    first = {r.booking_id: r.number for r in bitmaps.booking_numbers(ids, path).collect()}
    assert sorted(first.values()) == list(range(1, 301))
    more = ids.unionByName(spark.createDataFrame([("new",), (None,), ("b7",)], "booking_id string"))
    second = {r.booking_id: r.number for r in bitmaps.booking_numbers(more, path).collect()}
    assert second == first | {"new": 301}
    runs = current(spark, path).runs
    bitmaps.booking_numbers(more, path)
    assert current(spark, path).runs == runs


def test_runs_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bitmaps, "MOST_RUNS", 3)
    path = str(tmp_path / "n")
    for i in range(6):
        found = bitmaps.booking_numbers(spark.createDataFrame([(f"b{i}",)], "booking_id string"), path)
    assert len(current(spark, path).runs) <= 3 and sorted(r.number for r in found.collect()) == list(range(1, 7))


def test_places(spark):
    draw = random.Random(1)
    values = [(draw.choice([None, *range(20)]), i) for i in range(500)]
    df = spark.createDataFrame(values, "k int, i int").repartition(7)
    want = sorted(values, key=lambda v: (v[0] is None, v[0] or 0, v[1]))
    order = [F.asc_nulls_last("k"), F.asc("i")]
    got = {row.i: row.place for row in with_places(df, *order).collect()}
    assert got == {i: at for at, (_, i) in enumerate(want, 1)}
    with placed(df, *order) as numbered:
        shared = {row.i: row.place for row in ranked(numbered, "k").collect()}
    firsts = {}
    for at, (k, _) in enumerate(want, 1):
        firsts.setdefault(k, at)
    assert shared == {i: firsts[k] for k, i in want}
    assert "SinglePartition" not in ranked(with_places(df, *order), "k")._jdf.queryExecution().executedPlan().toString()
