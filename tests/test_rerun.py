"""Intake and sinks when run again, with defaults, or on what they cannot read."""

import json

import pytest
from pyspark.sql import functions as F

from adlake.operators import silver_spend
from adlake.plans import jobs
from adlake.sources import intake, sinks
from adlake.sources.manifest import select_names
from adlake.sources.readers import read_bronze_bookings, read_bronze_spend
from tests.samples import envelope, webhook

REQUESTS = "body string, isBase64Encoded boolean"


def requests(spark, bodies):
    return spark.createDataFrame([(body, False) for body in bodies], REQUESTS)


def take_in(spark, path, bodies, at="2025-10-08T07:42:00+00:00"):
    taken = intake.webhook_intake(requests(spark, bodies), ingested_at=at)
    good = taken.where(F.size("reject_reasons") == 0)
    sinks.write_bronze(good.select(*intake.BOOKING_ENVELOPE, *intake.BOOKING_PARTITIONS), path, intake.BOOKING_PARTITIONS)


def test_bronze_to_silver_with_defaults_keeps_every_event(spark, tmp_path):
    bronze, silver, rejects = (str(tmp_path / name) for name in ("bronze", "silver", "rejects"))
    take_in(spark, bronze, [json.dumps(webhook(str(i))) for i in range(20)])
    jobs.silver_bookings_job(spark, bronze, silver, rejects=rejects)
    assert spark.read.parquet(silver).count() == 20
    assert spark.read.parquet(rejects).count() == 0


def test_same_event_taken_in_twice_is_one_row(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    take_in(spark, bronze, [json.dumps(webhook("1")), json.dumps(webhook("2"))])
    take_in(spark, bronze, [json.dumps(webhook("2", name="Renamed")), json.dumps(webhook("3"))])
    rows = read_bronze_bookings(spark, bronze).select("raw_event.payload.name", "booking_id").collect()
    assert sorted(row.booking_id for row in rows) == ["book-1", "book-2", "book-3"]
    assert {row.booking_id: row.name for row in rows}["book-2"] == "Renamed"


def test_same_spend_file_taken_in_twice_counts_once(spark, tmp_path):
    files, bronze = tmp_path / "files", str(tmp_path / "bronze")
    files.mkdir()
    (files / "spend_data_2026-03-02.json").write_text(json.dumps([{"date": "2026-03-02", "channel": "facebook_paid_ads", "spend": 100}]))
    (files / "spend_data_2026-03-03.json").write_text("[]")
    names = select_names(spark.createDataFrame([("spend_data_2026-03-02.json",)], "file_name string"), newest=1)
    for _ in range(2):
        taken = intake.spend_intake(spark, str(files), ingested_at="2026-03-04T00:00:00+00:00", file_names=names)
        assert taken.count() == 1
        sinks.write_bronze(taken.drop("record_count"), bronze, intake.SPEND_PARTITIONS)
    spent = silver_spend.spend(read_bronze_spend(spark, bronze))
    assert spent.agg(F.sum("spend_usd")).first()[0] == 100


def test_documents_layout_reports_what_follows_the_first_value(spark, tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    one, two = envelope(webhook("1")), envelope(webhook("2"))
    (folder / "single.json").write_text(json.dumps(one, indent=2))
    (folder / "listed.json").write_text(json.dumps([one, two]))
    (folder / "lines.json").write_text(json.dumps(one) + "\n" + json.dumps(two))
    (folder / "broken.json").write_text('{"raw_event": ')
    (folder / "skipped.txt").write_text(json.dumps(one))
    read = read_bronze_bookings(spark, str(folder), layout="documents", glob="*.json")
    found = read.select(F.element_at(F.split("source_file_path", "/"), -1).alias("file"), F.col("_corrupt_record").isNull().alias("good"))
    counts = {(row.file, row.good): row["count"] for row in found.groupBy("file", "good").count().collect()}
    assert counts == {("single.json", True): 1, ("listed.json", True): 2, ("lines.json", False): 1, ("broken.json", False): 1}


def test_last_value_of_a_repeated_key_counts(spark):
    body = json.dumps(webhook("1"))[:-1] + ', "event": "invitee.created"}'
    row = intake.webhook_intake(requests(spark, [body])).first()
    assert row.reject_reasons == [] and row.booking_id == "book-1"


def test_rejects_of_other_days_stay(spark, tmp_path):
    silver, rejects = str(tmp_path / "silver"), str(tmp_path / "rejects")
    for day, name in (("2025-10-08", "a"), ("2025-10-09", "b")):
        folder = tmp_path / name
        folder.mkdir()
        bad = envelope(webhook(name, event="invitee.canceled")) | {"ingestion_timestamp": f"{day}T07:42:00+00:00"}
        good = envelope(webhook(name, start=f"{day}T17:00:00Z"))
        (folder / "x.json").write_text(json.dumps(bad) + "\n" + json.dumps(good))
        jobs.silver_bookings_job(spark, str(folder), silver, rejects=rejects, mode="replace_partitions")
    assert spark.read.parquet(silver).count() == 2
    assert spark.read.parquet(rejects).count() == 2


def test_overwrite_leaves_no_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2026-01-01", "2026-01-02"):
            sinks.write_table(spark.createDataFrame([(1, day)], "n int, day string"), path, partition_by=["day"], fmt="parquet")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [row.n for row in spark.read.parquet(path).collect()] == [1]


def test_registration_refuses_a_managed_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.range(2).write.mode("overwrite").saveAsTable("default.kept_by_spark")
    try:
        with pytest.raises(ValueError, match="managed"):
            sinks.register_table(spark, "default.kept_by_spark", path, "parquet")
        assert spark.table("default.kept_by_spark").count() == 2
    finally:
        spark.sql("DROP TABLE default.kept_by_spark")
