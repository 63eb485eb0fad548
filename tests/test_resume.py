"""A sequence that goes on where it died, and a streamed table that stays compact."""

import json
import threading

import pytest

from adlake.operators import silver_bookings
from adlake.plans import jobs
from adlake.sources import versions
from adlake.sources.readers import read_bronze_bookings, read_table
from adlake.streaming import jobs as streams
from tests.samples import envelope, webhook


class Killed(RuntimeError):
    pass


@pytest.fixture
def bronze(tmp_path):
    bookings, spend = tmp_path / "bookings", tmp_path / "spend"
    bookings.mkdir()
    spend.mkdir()
    (bookings / "1.json").write_text(json.dumps(envelope(webhook("1"))) + "\n")
    _spent(spend, "a.json", 10.0)
    return bookings, spend


def _spent(folder, name, amount):
    records = [{"date": "2025-10-08", "channel": "facebook_paid_ads", "spend": amount}]
    (folder / name).write_text(json.dumps({"raw_s3_key": name, "raw_payload": records}) + "\n")


STEPS = ["silver_spend_job", "silver_bookings_job", "gold_spend_job", "gold_bookings_job", "gold_combined_job"]


def _watched(monkeypatch, dies=None):
    ran = []

    def watch(name, plain):
        def run(*args, **options):
            if name == dies:
                raise Killed(name)
            ran.append(name)
            return plain(*args, **options)

        run.__name__ = name
        return run

    for name in STEPS:
        monkeypatch.setattr(jobs, name, watch(name, getattr(jobs, name)))
    return ran


def test_only_what_is_left_runs_again(spark, bronze, tmp_path, monkeypatch):
    bookings, spend = bronze
    lake = str(tmp_path / "lake")

    def refresh(**options):
        jobs.refresh_lakehouse(spark, str(bookings), str(spend), lake, mode="publish", fmt="parquet", resume=True, **options)

    def cost():
        return read_table(spark, f"{lake}/gold/cpb_by_channel", "parquet").first().cost_per_booking_usd

    # dies after silver
    with monkeypatch.context() as patch:
        ran = _watched(patch, "gold_bookings_job")
        with pytest.raises(Killed):
            refresh()
        assert set(ran) == {"silver_spend_job", "silver_bookings_job", "gold_spend_job"}
    with monkeypatch.context() as patch:
        ran = _watched(patch)
        refresh()
        assert ran == ["gold_bookings_job", "gold_combined_job"] and cost() == 10.0
        ran.clear()
        refresh()
        assert ran == []
        _spent(spend, "b.json", 5.0)
        refresh()
        assert sorted(ran) == ["gold_combined_job", "gold_spend_job", "silver_spend_job"] and cost() == 15.0
        ran.clear()
        # other parameters are other steps
        refresh(spend_channels=["facebook_paid_ads", "else"])
        assert "silver_spend_job" in ran and "silver_bookings_job" not in ran
    with pytest.raises(ValueError, match="resume"):
        jobs.refresh_lakehouse(spark, str(bookings), str(spend), lake, resume=True)


def test_a_stream_of_many_batches_ends_in_few_files(spark, tmp_path):
    bronze, target = tmp_path / "bronze", str(tmp_path / "silver")
    bronze.mkdir()

    def deliver(first, last):
        for n in range(first, last):
            start = f"2025-10-{8 + n % 2:02}T13:30:00.000000Z"
            (bronze / f"{n:03}.json").write_text("\n".join(json.dumps(envelope(webhook(f"{n}-{k}", start=start), f"k{n}")) for k in range(3)))

    def run():
        query = streams.silver_version_stream(
            spark, str(bronze), target, str(tmp_path / "c"), files_per_batch=1, most_runs=4, fmt="parquet"
        )
        query.awaitTermination(600)
        assert query.exception() is None
        want = silver_bookings.bookings(read_bronze_bookings(spark, str(bronze), layout="lines"))
        got = read_table(spark, target, "parquet").select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        return versions.current(spark, target)

    deliver(0, 12)
    assert len(run().runs) <= 4
    files = read_table(spark, target, "parquet").inputFiles()
    assert len([name for name in files if "meeting_date=2025-10-08" in name]) <= 4
    deliver(12, 15)
    assert len(run().runs) <= 4 and versions.marks(spark, target)["batch of silver"] == 14


def test_a_replayed_batch_is_left_out(spark, tmp_path, monkeypatch):
    """Dying after the commit, the stream repeats a batch that the table holds already."""
    bronze, target = tmp_path / "bronze", str(tmp_path / "silver")
    bronze.mkdir()
    (bronze / "1.json").write_text(json.dumps(envelope(webhook("1"))))

    def dies(*_, **__):
        raise Killed("after the commit")

    monkeypatch.setattr(streams, "compacted", dies)
    query = streams.silver_version_stream(spark, str(bronze), target, str(tmp_path / "c"), fmt="parquet")
    with pytest.raises(Exception, match="after the commit"):
        query.awaitTermination(300)
    monkeypatch.undo()
    streams.silver_version_stream(spark, str(bronze), target, str(tmp_path / "c"), fmt="parquet").awaitTermination(300)
    assert read_table(spark, target, "parquet").count() == 1


def test_published_tables_are_written_side_by_side(spark, tmp_path, monkeypatch):
    together, plain = threading.Barrier(2), jobs.pending_table

    def both(*args, **options):
        together.wait(timeout=20)
        return plain(*args, **options)

    monkeypatch.setattr(jobs, "pending_table", both)
    paths = [str(tmp_path / name) for name in "ab"]
    jobs._write_all(spark, [jobs.Written(spark.range(n), path, "publish", [], "parquet") for n, path in enumerate(paths, 1)])
    assert [read_table(spark, path, "parquet").count() for path in paths] == [1, 2]
