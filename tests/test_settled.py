"""Closed days do not depend on how a backlog is cut, and every late or repeated row is reported."""

import collections
import json
import random

import pytest

from adlake.operators import bitmaps
from adlake.sources.readers import read_table
from adlake.streaming import jobs as streams
from adlake.streaming import settled
from tests.samples import YOUTUBE, envelope, webhook


def files():
    """Bookings of ten days out of order, some of days long closed, a third delivered again."""
    draw = random.Random(11)
    events = []
    for i in range(60):
        day = 1 + min(9, i // 7) if draw.random() > 0.3 else draw.randint(1, 9)
        kind = {"kind": YOUTUBE} if i % 4 == 0 else {}
        events.append((f"{i}", f"2025-07-{day:02}T{i % 24:02}:30:00Z", kind))
    events.append(("last", "2025-07-12T00:00:00Z", {}))
    delivered = [*events]
    for event in draw.sample(events, 20):
        delivered.insert(draw.randint(delivered.index(event) + 1, len(delivered)), event)
    cut = [delivered[i : i + 9] for i in range(0, len(delivered), 9)]
    return events, delivered, cut


def deliver(folder, number, batch):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps(envelope(webhook(name, created_at=at, **kind), f"k/{number:03}/{place:03}") | {"ingestion_timestamp": f"2025-08-01T00:{number:02}:{place:02}Z"})
        for place, (name, at, kind) in enumerate(batch)
    ]
    path = folder / f"{number:03}.json"
    path.write_text("\n".join(lines))
    # the stream takes older files first
    import os

    os.utime(path, (1_700_000_000 + number * 10, 1_700_000_000 + number * 10))


def run(spark, tmp_path, name, **options):
    query = streams.settled_stream(spark, str(tmp_path / "bronze"), str(tmp_path / name), str(tmp_path / f"c-{name}"), **options)
    query.awaitTermination(300)
    assert query.exception() is None
    return results(spark, tmp_path, name)


def results(spark, tmp_path, name):
    days = read_table(spark, str(tmp_path / name / "closed_days"), "parquet").collect()
    reported = read_table(spark, str(tmp_path / name / "reported"), "parquet").groupBy("kind").count().collect()
    return {(str(r.booking_date), r.channel): r.booked_call_count for r in days}, {r.kind: r["count"] for r in reported}


@pytest.mark.parametrize("cut", [1, 4, 100])
def test_any_cut_of_a_backlog_ends_the_same(spark, tmp_path, cut):
    events, delivered, parts = files()
    for number, batch in enumerate(parts):
        deliver(tmp_path / "bronze", number, batch)
    days, reported = run(spark, tmp_path, "s", files_per_batch=cut)
    want = collections.Counter()
    for _, at, kind in events:
        if at[:10] < "2025-07-11":
            want[at[:10], "youtube_paid_ads" if kind else "facebook_paid_ads"] += 1
    assert days == want
    assert reported["repeated"] == len(delivered) - len(events)
    assert (reported.get("late", 0) > 0) == (cut < 100)


def test_a_replayed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    _, _, parts = files()
    for number, batch in enumerate(parts[:3]):
        deliver(tmp_path / "bronze", number, batch)
    first = run(spark, tmp_path, "s", files_per_batch=2)
    for number, batch in enumerate(parts[3:], 3):
        deliver(tmp_path / "bronze", number, batch)
    plain, left = settled.write_table, [2]

    def dies(*args, **options):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("gone")
        return plain(*args, **options)

    monkeypatch.setattr(settled, "write_table", dies)
    query = streams.settled_stream(spark, str(tmp_path / "bronze"), str(tmp_path / "s"), str(tmp_path / "c-s"), files_per_batch=2)
    with pytest.raises(Exception, match="gone"):
        query.awaitTermination(300)
    monkeypatch.undo()
    assert first != run(spark, tmp_path, "s", files_per_batch=2) == run(spark, tmp_path, "t", files_per_batch=2)


def test_deliveries_are_numbered_through_without_python(spark, tmp_path, monkeypatch):
    """Numbers go on over batches, over merged runs of the counts and over a replay, and the stream
    calls no Python per id."""
    _, delivered, parts = files()
    monkeypatch.setattr(settled, "MOST_RUNS", 2)
    for number, batch in enumerate(parts):
        deliver(tmp_path / "bronze", number, batch)
    keep, left = settled._keep_counts, [4]

    def dies(*args):
        keep(*args)
        left[0] -= 1
        if left[0] == 0:
            raise OSError("gone")

    monkeypatch.setattr(settled, "_keep_counts", dies)
    query = streams.settled_stream(spark, str(tmp_path / "bronze"), str(tmp_path / "s"), str(tmp_path / "c-s"), files_per_batch=1)
    with pytest.raises(Exception, match="gone"):
        query.awaitTermination(300)
    query = streams.settled_stream(spark, str(tmp_path / "bronze"), str(tmp_path / "s"), str(tmp_path / "c-s"), files_per_batch=1)
    query.awaitTermination(300)
    assert query.exception() is None
    assert "TransformWithState" not in query._jsq.explainInternal(True)
    again = read_table(spark, str(tmp_path / "s" / "reported"), "parquet").where("kind = 'repeated'").collect()
    seen, want = collections.Counter(), set()
    for name, _, _ in delivered:
        seen[name] += 1
        if seen[name] > 1:
            want.add((name, seen[name]))
    assert {(r.booking_id.removeprefix("book-"), r.delivery) for r in again} == want


def test_bitmap_stream(spark, tmp_path):
    """Batches of one file, deliveries repeated: the tables are those of all bookings."""
    events, _, parts = files()
    for number, batch in enumerate(parts[:4]):
        deliver(tmp_path / "bronze", number, batch)
    root, gold = str(tmp_path / "bitmaps"), str(tmp_path / "gold")
    query = streams.bitmap_stream(spark, str(tmp_path / "bronze"), root, gold, str(tmp_path / "c"), fmt="parquet", files_per_batch=2)
    query.awaitTermination(300)
    taken = {(name, at[:10], bool(kind)) for batch in parts[:4] for name, at, kind in batch}
    want = collections.Counter(day for _, day, _ in taken)
    trends = read_table(spark, f"{gold}/booking_trends", "parquet")
    assert {str(r.booking_date): r.booked_call_count for r in trends.collect()} == want
    cube = bitmaps.cube_of(bitmaps.kept_bitmaps(spark, root))
    assert cube.where("grain = 'everything'").first().booked_call_count == len(taken)
