"""Versions that appear at once, appends that know their inputs, and names that move."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adlake.plans import jobs
from adlake.sources import sinks, versions
from adlake.sources.readers import read_silver_bookings, read_silver_spend, read_table
from adlake.sources.sinks import register_table, write_table
from tests.samples import FIRST_DAY, SECOND_DAY, spend


def table_of(spark, path):
    found = read_table(spark, path, "parquet").select("spend_date", "channel", "spend_usd").collect()
    return sorted(tuple(row) for row in found)


def publish(spark, path, rows, mode="publish"):
    write_table(spend(spark, base=rows), path, mode=mode, partition_by=["spend_date"], fmt="parquet")


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b, c = [(FIRST_DAY, "a", 1.0)], [(FIRST_DAY, "b", 2.0), (SECOND_DAY, "b", 3.0)], [(SECOND_DAY, "c", 4.0)]
    publish(spark, path, a)
    assert table_of(spark, path) == a
    before = read_table(spark, path, "parquet").select("channel")
    publish(spark, path, b)
    assert table_of(spark, path) == b and [row.channel for row in before.collect()] == ["a"]
    publish(spark, path, c, "publish_partitions")
    assert table_of(spark, path) == [b[0], c[0]]
    assert versions.roll_back(spark, path).number == 4 and table_of(spark, path) == b
    # two versions are kept, and no run that neither has
    assert len(versions.versions(spark, path)) == 2
    runs = {run for version in versions.versions(spark, path) for run in version.runs}
    assert {f"_run={run}" for run in runs} == {p.name for p in (tmp_path / "t" / "_runs").iterdir()}
    for mode in ("overwrite", "append", "replace_partitions"):
        with pytest.raises(ValueError, match="bypass"):
            publish(spark, path, a, mode)


def test_two_writers_do_not_both_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark, path, [(FIRST_DAY, "a", 1.0)])
    frame = spend(spark, base=[(FIRST_DAY, "b", 1.0)])
    first, second = versions.publish(frame, path, fmt="parquet"), versions.publish(frame, path, fmt="parquet")
    first.commit()
    with pytest.raises(FileExistsError):
        second.commit()


def test_a_path_is_written_in_one_way(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark, path, [(FIRST_DAY, "a", 1.0)], "overwrite")
    with pytest.raises(ValueError, match="in place"):
        publish(spark, path, [(FIRST_DAY, "a", 1.0)])


def test_names_move_with_the_versions(spark, tmp_path):
    path, name = str(tmp_path / "it's"), "versioned_spend"
    publish(spark, path, [(FIRST_DAY, "a", 1.0)])
    register_table(spark, name, path, "parquet")
    under_way = spark.table(name).select("channel")
    pending = versions.publish(spend(spark, base=[(SECOND_DAY, "b", 2.0)]), path, partition_by=["spend_date"], fmt="parquet")
    assert [row.channel for row in spark.table(name).collect()] == ["a"]
    pending.commit()
    # the name still leads to the version before, which is whole
    assert [row.channel for row in spark.sql(f"SELECT channel FROM {name}").collect()] == ["a"]
    register_table(spark, name, path, "parquet")
    assert [tuple(row) for row in spark.sql(f"SELECT channel, spend_date FROM {name}").collect()] == [("b", SECOND_DAY)]
    assert [row.channel for row in under_way.collect()] == ["a"]


def test_a_name_is_never_away(spark, tmp_path, monkeypatch):
    """Registration again neither drops nor makes the table."""
    path, name = str(tmp_path / "t"), "steady_spend"
    publish(spark, path, [(FIRST_DAY, "a", 1.0)])
    register_table(spark, name, path, "parquet")
    said = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(self, text, *a, **k))
    publish(spark, path, [(FIRST_DAY, "b", 2.0), (SECOND_DAY, "b", 2.0)])
    register_table(spark, name, path, "parquet")
    assert any("SET LOCATION" in text for text in said) and not any("DROP" in text for text in said)
    assert spark.table(name).count() == 2
    # other columns: the name is made again
    write_table(spend(spark).withColumn("more", F.lit(1)), path, mode="publish", fmt="parquet")
    register_table(spark, name, path, "parquet")
    assert "more" in spark.table(name).columns


class Killed(RuntimeError):
    pass


@pytest.fixture
def raw(spark, tmp_path):
    """Bronze spend in two files; ``deliver`` writes another."""
    folder = tmp_path / "bronze"
    folder.mkdir()

    def deliver(name, records):
        row = {
            "source_system": "s", "ingestion_timestamp": "2026-01-01T00:00:00Z", "source_url": "u",
            "source_file_name": name, "raw_s3_key": f"k/{name}", "raw_payload": records,
        }
        (folder / name).write_text(json.dumps(row) + "\n")

    deliver("a.json", [{"date": "2026-01-01", "channel": "tiktok_paid_ads", "spend": 10.0}, {"date": "bad", "channel": "x", "spend": 1.0}])
    deliver("b.json", [{"date": "2026-01-02", "channel": "youtube_paid_ads", "spend": 5.5}])
    return str(folder), deliver


def spent(spark, path):
    return sorted((str(r.spend_date), r.spend_usd) for r in read_silver_spend(spark, path, "parquet").collect())


ALL = [("2026-01-01", 10.0), ("2026-01-02", 5.5)]


def test_append_twice_adds_once(spark, raw, tmp_path):
    source, deliver = raw
    target, rejects = str(tmp_path / "s"), str(tmp_path / "r")
    for _ in range(2):
        jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
        assert spent(spark, target) == ALL and read_table(spark, rejects, "parquet").count() == 1
    assert len(versions.current(spark, target).runs) == 1
    deliver("c.json", [{"date": "2026-01-02", "channel": "tiktok_paid_ads", "spend": 1.25}, {"date": None, "channel": "x", "spend": 1.0}])
    for _ in range(2):
        jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
        assert spent(spark, target) == sorted([*ALL, ("2026-01-02", 1.25)]) and read_table(spark, rejects, "parquet").count() == 2
    # three runs in a file each become one, and the record of inputs stays
    versions.merged(spark, target, partition_by=["spend_date"], fmt="parquet").commit()
    assert len(versions.current(spark, target).runs) == 1
    jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
    assert spent(spark, target) == sorted([*ALL, ("2026-01-02", 1.25)])


@pytest.mark.parametrize("dies_at", range(5))
def test_append_dies_anywhere_and_is_run_again(spark, raw, tmp_path, monkeypatch, dies_at):
    """Before or after each write and each commit: what comes out in the end is the same."""
    source, deliver = raw
    target, rejects = str(tmp_path / "s"), str(tmp_path / "r")
    jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
    deliver("c.json", [{"date": "2026-01-03", "channel": "tiktok_paid_ads", "spend": 2.0}, {"date": None, "channel": "x", "spend": 1.0}])
    _die_at(monkeypatch, dies_at)
    try:
        jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
    except Killed:
        assert spent(spark, target) == ALL
    monkeypatch.undo()
    jobs.silver_spend_job(spark, source, target, rejects=rejects, mode="append", fmt="parquet")
    assert spent(spark, target) == sorted([*ALL, ("2026-01-03", 2.0)])
    assert read_table(spark, rejects, "parquet").count() == 2


def _die_at(monkeypatch, step):
    """Raise at the given one of the places before a run is written and before one is committed."""
    done = []

    def counted(plain):
        def run(*args, **options):
            done.append(1)
            if len(done) > step:
                raise Killed
            return plain(*args, **options)

        return run

    write, commit = counted(versions.write_run), counted(versions.Pending.commit)
    monkeypatch.setattr(versions, "write_run", write)
    monkeypatch.setattr(jobs, "write_run", write)
    monkeypatch.setattr(versions.Pending, "commit", commit)


@pytest.mark.parametrize("dies_at", [0, 1, 3, 5, 6, 7])
def test_a_refresh_that_dies_leaves_whole_tables(spark, raw, tmp_path, monkeypatch, dies_at):
    source, deliver = raw
    target, root = str(tmp_path / "s"), str(tmp_path / "gold")

    def refresh():
        jobs.silver_spend_job(spark, source, target, rejects=str(tmp_path / "r"), mode="publish", fmt="parquet")
        jobs.gold_spend_job(spark, target, root, mode="publish", fmt="parquet")
        for name in ("daily_spend_by_channel", "channel_spend_summary"):
            register_table(spark, f"killed_{name}", f"{root}/{name}", "parquet")

    def totals():
        return [
            spark.sql(f"SELECT SUM(total_spend_usd) FROM killed_{name}").first()[0]
            for name in ("daily_spend_by_channel", "channel_spend_summary")
        ]

    refresh()
    assert totals() == [15.5, 15.5]
    deliver("c.json", [{"date": "2026-01-03", "channel": "tiktok_paid_ads", "spend": 100.0}])
    _die_at(monkeypatch, dies_at)
    try:
        refresh()
        died = False
    except Killed:
        died = True
    monkeypatch.undo()
    assert all(total in (15.5, 115.5) for total in totals())
    assert died == (totals() == [15.5, 15.5])
    refresh()
    assert totals() == [115.5, 115.5]


def test_refresh_with_names(spark, raw, tmp_path):
    """The whole sequence published twice; readers by path and by name see the second."""
    source, deliver = raw
    bookings = tmp_path / "bookings"
    bookings.mkdir()
    (bookings / "none.json").write_text("not json\n")
    lake = str(tmp_path / "lake")
    for total in (15.5, 18.5):
        jobs.refresh_lakehouse(spark, str(bookings), source, lake, mode="publish", fmt="parquet", database="published")
        assert spark.table("published.channel_spend_summary").agg(F.sum("total_spend_usd")).first()[0] == total
        assert read_table(spark, f"{lake}/gold/combined_dashboard_kpis", "parquet").first().total_spend_usd == total
        assert read_silver_bookings(spark, f"{lake}/silver/bookings", "parquet").count() == 0
        deliver("c.json", [{"date": "2026-01-03", "channel": "tiktok_paid_ads", "spend": 3.0}])
    assert not list(Path(lake).glob("gold/*/*.parquet"))


def test_in_place_append_needs_a_record(spark, raw, tmp_path):
    source, _ = raw
    jobs.silver_spend_job(spark, source, str(tmp_path / "s"), fmt="parquet")
    with pytest.raises(ValueError, match="publish"):
        jobs.silver_spend_job(spark, source, str(tmp_path / "s"), mode="append", fmt="parquet")
    assert sinks.MODES
