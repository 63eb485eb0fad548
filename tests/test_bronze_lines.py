"""Taking a key in again leaves every other line of its folder as it was."""

import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from adlake.plans import jobs
from adlake.sources import sinks
from adlake.sources.readers import read_bronze_bookings
from tests.samples import webhook

SCHEMA = "raw_s3_key string, x string, event_type string, ingest_date string"
BY = ["event_type", "ingest_date"]


def lines(folder):
    return sorted(line for p in folder.rglob("*.json") for line in p.read_bytes().split(b"\n") if line)


def test_other_lines_stay_byte_for_byte(spark, tmp_path):
    root = tmp_path / "b"
    day = root / "event_type=e" / "ingest_date=2026-01-01"
    day.mkdir(parents=True)
    stays = [
        b'{"raw_s3_key":"k0","x":"a","extra":"keep"}', b"{ broken", b'{"raw_s3_key": "k2",  "x" : 1.50}', b'{"x":"no key"}',
        b'{"raw_s3_key":"k3"}\r', "{\"raw_s3_key\":\"k4\",\"x\":\"ü \"}".encode(), b"[]", b'  {"raw_s3_key":"k5"}  ',
    ]
    (day / "one.json").write_bytes(b"\n".join([stays[0], b'{"raw_s3_key":"k1","x":"old"}', *stays[1:6]]) + b"\n")
    (day / "two.json").write_bytes(b"\n".join(stays[6:]) + b"\n")
    (day / "only.json").write_bytes(b'{"raw_s3_key":"k1","x":"older"}\n')
    other = root / "event_type=e" / "ingest_date=2026-01-02"
    other.mkdir()
    (other / "far.json").write_bytes(b'{"raw_s3_key":"k1","x":"another folder"}\n')
    untouched = {p: (p.read_bytes(), p.stat().st_mtime_ns) for p in (day / "two.json", other / "far.json")}
    new = [("k1", "new", "e", "2026-01-01"), ("k1", "second", "e", "2026-01-01"), ("k9", "z", "e", "2026-01-01")]
    frame = spark.createDataFrame(new, SCHEMA)
    written = [json.dumps({"raw_s3_key": k, "x": x}, separators=(",", ":")).encode() for k, x, *_ in new]
    for _ in range(2):
        sinks.write_bronze(frame, str(root), BY)
        assert lines(day) == sorted([*stays, *written])
        assert all((p.read_bytes(), p.stat().st_mtime_ns) == was for p, was in untouched.items())
    assert not (day / "only.json").exists() and (day / "one.json").exists()


def test_a_job_that_dies_loses_nothing_and_is_run_again(spark, tmp_path, monkeypatch):
    root = tmp_path / "b"
    first = spark.createDataFrame([(f"k{i}", "old", "e", "2026-01-01") for i in range(20)], SCHEMA).coalesce(2)
    sinks.write_bronze(first, str(root), BY)
    again = first.where("raw_s3_key < 'k15'").withColumn("x", F.lit("new"))
    calls = []

    def dies(*args):
        calls.append(1)
        raise OSError("gone")

    monkeypatch.setattr(sinks, "replace_file", dies)
    monkeypatch.setattr(sinks, "delete_file", dies)
    with pytest.raises(OSError, match="gone"):
        sinks.write_bronze(again, str(root), BY)
    monkeypatch.undo()
    keys = {json.loads(line)["raw_s3_key"] for line in lines(root)}
    assert calls and keys == {f"k{i}" for i in range(20)}
    sinks.write_bronze(again, str(root), BY)
    got = sorted((row["raw_s3_key"], row["x"]) for row in map(json.loads, lines(root)))
    assert got == sorted((f"k{i}", "new" if f"k{i}" < "k15" else "old") for i in range(20))


def test_keys_in_packed_files(spark, tmp_path):
    root = str(tmp_path / "b")
    frame = spark.createDataFrame([("k1", "a", "e", "2026-01-01")], SCHEMA)
    frame.write.partitionBy(*BY).option("compression", "gzip").json(root)
    with pytest.raises(ValueError, match="plain .json"):
        sinks.write_bronze(frame, root, BY)
    sinks.write_bronze(frame.withColumn("raw_s3_key", F.lit("k2")), root, BY)
    assert spark.read.json(root).count() == 2


def test_no_folder_passes_through_one_task(spark, tmp_path, monkeypatch):
    """Also where the keys are too many to be broadcast, lines are not dealt out by folder alone,
    and a file that may have to be rewritten has a bounded number of rows."""
    root = tmp_path / "b"
    frame = spark.range(40).selectExpr("concat('k', id) raw_s3_key", "'a' x", "'e' event_type", "'2026-01-01' ingest_date").coalesce(1)
    monkeypatch.setattr(sinks, "BRONZE_ROWS", 15, raising=False)
    plans, staged = [], sinks.staged

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df)

    monkeypatch.setattr(sinks, "staged", seen)
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    try:
        for _ in range(2):
            sinks.write_bronze(frame, str(root), BY)
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(lines(root)) == 40 and len(list(root.rglob("*.json"))) == 3
    assert not any(re.search(r"SortMergeJoin \[event_type#\d+, ingest_date#\d+\]", plan) for plan in plans)


def test_packed_files_are_rewritten_packed(spark, tmp_path):
    """Other lines of packed and of plain files stay byte for byte, in files of the same names."""
    root = tmp_path / "b"
    day = root / "event_type=e" / "ingest_date=2026-01-01"
    day.mkdir(parents=True)
    stays = [b'{"raw_s3_key":"k0","x":"a","extra":"keep"}', b"{ broken", b'{"raw_s3_key": "k2",  "x" : 1.50}\r', b'{"x":"no key"}']
    old = b'{"raw_s3_key":"k1","x":"old"}'
    (day / "one.json.gz").write_bytes(gzip.compress(b"\n".join([stays[0], old, stays[1]]) + b"\n"))
    (day / "two.json").write_bytes(b"\n".join([old, *stays[2:]]) + b"\n")
    (day / "all.json.gz").write_bytes(gzip.compress(old + b"\n"))
    frame = spark.createDataFrame([("k1", "new", "e", "2026-01-01"), ("k9", "z", "e", "2026-01-01")], SCHEMA)
    for _ in range(2):
        sinks.write_bronze(frame, str(root), BY, packed=True)
        packed = sorted(line for p in day.glob("*.json.gz") for line in gzip.decompress(p.read_bytes()).split(b"\n") if line)
        assert packed == sorted([*stays[:2], b'{"raw_s3_key":"k1","x":"new"}', b'{"raw_s3_key":"k9","x":"z"}'])
        assert lines(root) == sorted(stays[2:])
    assert {p.name for p in day.glob("[a-z]*.json*") if not p.name.startswith("part-")} == {"one.json.gz", "two.json"}


def test_requests_taken_in_again_need_little_disk(spark, tmp_path, monkeypatch):
    """Bronze and rejects are packed, good rows are staged without their body, and no line is put
    aside where all of a file are replaced."""
    bodies = [json.dumps(webhook(str(n), event="invitee.canceled" if n % 10 == 0 else "invitee.created")) for n in range(300)]
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.json").write_text("\n".join(json.dumps({"body": body}) for body in bodies))
    bronze, rejects = tmp_path / "bronze", tmp_path / "rejects"
    staged, aside, staging = [], [], sinks.staging_path
    monkeypatch.setattr(jobs, "staged", lambda df, whole=jobs.staged: staged.append(df) or whole(df))
    monkeypatch.setattr(sinks, "staging_path", lambda spark, name: aside.append(name) or staging(spark, name))
    for _ in range(2):
        jobs.webhook_intake_job(spark, str(tmp_path / "q"), str(bronze), rejects=str(rejects))
    assert read_bronze_bookings(spark, str(bronze)).select("booking_id").distinct().count() == 270
    assert read_bronze_bookings(spark, str(bronze)).count() == 270
    kept = spark.read.json(str(rejects))
    assert kept.count() == 30 and sorted(row.body for row in kept.select("body").collect()) == sorted(bodies[::10])
    for folder, events in ((bronze, bodies[1:]), (rejects, bodies[::10])):
        assert 4 * sum(p.stat().st_size for p in folder.rglob("part-*")) < sum(map(len, events))
    assert staged[0].where("size(reject_reasons) = 0 and body is not null").isEmpty()
    assert "bronze-lines" not in aside
