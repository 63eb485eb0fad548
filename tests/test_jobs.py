import json
from datetime import date
from pathlib import Path

import pytest

from adlake.operators import gold_bookings
from adlake.operators.quality import InvalidRows
from adlake.plans import jobs, reports
from adlake.session import checkpointed, scratch_dir, staging_path, table_format
from adlake.sources.readers import read_table
from adlake.sources.sinks import export_json, register_table, write_table
from tests.samples import FIRST_DAY, SECOND_DAY, TIKTOK, YOUTUBE, bookings, envelope, spend, webhook


@pytest.fixture
def bronze(tmp_path):
    booked, spent = tmp_path / "bronze" / "bookings", tmp_path / "bronze" / "spend"
    booked.mkdir(parents=True)
    spent.mkdir()
    events = [webhook("1"), webhook("2", kind=YOUTUBE), webhook("3", kind=TIKTOK, start="2025-10-09T09:00:00Z"), webhook("4", start="never")]
    for number, event in enumerate([*events, events[0]]):
        (booked / f"{number}.json").write_text(json.dumps(envelope(event), indent=1))
    records = [("2025-10-08", "facebook_paid_ads", 653.28), ("2025-10-09", "youtube_paid_ads", 487.59), ("2025-10-08", "radio", 1.0)]
    payload = [{"date": d, "channel": c, "spend": s} for d, c, s in records]
    (spent / "a.json").write_text(json.dumps({"source_file_name": "a.json", "raw_payload": payload}))
    return str(booked), str(spent)


def test_refresh_lakehouse(spark, bronze, tmp_path, rows):
    root = str(tmp_path / "lake")
    for _ in range(2):  # running again gives the same tables
        jobs.refresh_lakehouse(spark, *bronze, root, database="lake", layout="documents", fmt="parquet")
    daily = spark.table("lake.daily_cpb_by_channel")
    assert rows(daily.drop("gold_processed_at").select("metric_date", "channel", "total_spend_usd", "booked_call_count", "cost_per_booking_usd")) == [
        (date(2025, 10, 8), "facebook_paid_ads", 653.28, 1, 653.28),
        (date(2025, 10, 8), "tiktok_paid_ads", 0.0, 1, 0.0),
        (date(2025, 10, 8), "youtube_paid_ads", 0.0, 1, 0.0),
        (date(2025, 10, 9), "youtube_paid_ads", 487.59, 0, None),
    ]
    assert {name for name in jobs.GOLD_TABLES if "gold_processed_at" in spark.table(f"lake.{name}").columns} == set(jobs.GOLD_TABLES)
    silver = read_table(spark, f"{root}/silver/bookings", "parquet")
    assert silver.count() == 4 and "silver_processed_at" in silver.columns
    assert sorted(p.name for p in (tmp_path / "lake/silver/bookings").glob("meeting_date=*")) == ["meeting_date=2025-10-08", "meeting_date=2025-10-09"]
    (bad,) = read_table(spark, f"{root}/rejects/bookings", "parquet").collect()
    assert (bad.booking_id, bad.reject_reasons) == ("book-4", ["invalid_meeting_date"])
    (bad,) = read_table(spark, f"{root}/rejects/spend", "parquet").collect()
    assert bad.reject_reasons == ["unsupported_channel"]
    kpis = reports.report(spark.table("lake.combined_dashboard_kpis"), "combined_dashboard_kpis").head()
    assert tuple(kpis)[:-1] == (1140.87, 3, 380.29, 3, 2, 1)


def test_nothing_valid(spark, tmp_path):
    bad, spent, root = tmp_path / "bad", tmp_path / "spend", str(tmp_path / "lake")
    bad.mkdir(), spent.mkdir()
    (bad / "1.json").write_text(json.dumps(envelope(webhook("1", start="never"))))
    jobs.refresh_lakehouse(spark, str(bad), str(spent), root, layout="documents", fmt="parquet")
    assert read_table(spark, f"{root}/rejects/bookings", "parquet").count() == 1
    assert read_table(spark, f"{root}/rejects/spend", "parquet").count() == 0
    kpis = read_table(spark, f"{root}/gold/combined_dashboard_kpis", "parquet").drop("gold_processed_at")
    assert tuple(kpis.head()) == (0.0, 0, None, 0, 0, 0)


def test_silver_schemas_are_those_written(spark):
    from adlake.operators import silver_bookings, silver_spend
    from adlake.schemas import BRONZE_BOOKING, BRONZE_SPEND, SILVER_BOOKING, SILVER_SPEND

    for build, bronze, silver in [
        (silver_bookings.bookings, BRONZE_BOOKING, SILVER_BOOKING),
        (silver_spend.spend, BRONZE_SPEND, SILVER_SPEND),
    ]:
        made = build(spark.createDataFrame([], bronze))
        assert made.dtypes == spark.createDataFrame([], silver).dtypes


def test_strict_leaves_the_table_alone(spark, bronze, tmp_path):
    target = str(tmp_path / "silver")
    jobs.silver_bookings_job(spark, bronze[0], target, layout="documents", fmt="parquet")
    with pytest.raises(InvalidRows, match="invalid_meeting_date"):
        jobs.silver_bookings_job(spark, bronze[0], target, strict=True, layout="documents", fmt="parquet")
    assert read_table(spark, target, "parquet").count() == 4


def test_command_line(bronze, spark, tmp_path):
    root = tmp_path / "lake"
    silver, spent = str(root / "s"), str(root / "p")
    jobs.main(["silver-bookings", "--source", bronze[0], "--target", silver, "--rejects", str(root / "r"), "--layout", "documents"])
    jobs.main(["silver-spend", "--source", bronze[1], "--target", spent, "--layout", "documents", "--channels", '{"x": "radio"}'])
    jobs.main(["gold-bookings", "--silver", silver, "--root", str(root)])
    jobs.main(["gold-spend", "--silver", spent, "--root", str(root)])
    jobs.main(["gold-combined", "--silver-spend", spent, "--silver-bookings", silver, "--root", str(root)])
    assert {p.name for p in root.iterdir()} == {"s", "p", "r", *jobs.GOLD_TABLES}
    assert read_table(spark, f"{root}/channel_spend_summary", "parquet").head().channel == "radio"
    jobs.main(["metrics", "--silver-spend", spent, "--silver-bookings", silver, "--root", str(root / "m")])
    assert len(list((root / "m").iterdir())) == 7
    (kpis,) = spark.read.json(f"{root}/m/dashboard_kpis").collect()
    assert (kpis.total_bookings, kpis.total_spend) == (3, 1.0)
    with pytest.raises(SystemExit):
        jobs.main(["gold-spend"])


def test_intake_commands(spark, tmp_path, rows):
    raw, requests, lake = tmp_path / "raw", tmp_path / "requests", tmp_path / "lake"
    raw.mkdir(), requests.mkdir()
    names = [f"spend_data_2025-06-2{n}.json" for n in range(4)]
    for n, name in enumerate(names):
        day = [{"date": f"2025-06-2{n}", "channel": "facebook_paid_ads", "spend": 100.0}] * (n + 1)
        (raw / name).write_text(json.dumps(day))
    (tmp_path / "index.json").write_text(json.dumps({"files": names}))
    spend_args = ["intake-spend", "--files", str(raw), "--manifests", str(tmp_path / "index.json"), "--newest", "2",
                  "--target", str(lake / "spend"), "--counts", str(lake / "counts"), "--ingested-at", "2025-07-01T00:00:00+00:00"]
    bodies = [json.dumps(webhook("1")), json.dumps(webhook("2")), "{broken"]
    (requests / "a.json").write_text("\n".join(json.dumps({"body": body}) for body in bodies))
    hook_args = ["intake-webhooks", "--requests", str(requests), "--target", str(lake / "hooks"), "--rejects", str(lake / "bad")]
    for _ in range(2):  # running again adds nothing
        jobs.main(spend_args)
        jobs.main(hook_args)
    counted = spark.read.json(str(lake / "counts")).select("source_file_name", "record_count")
    assert rows(counted) == [(names[2], 3), (names[3], 4)]
    assert spark.read.json(str(lake / "bad")).count() == 1
    jobs.main(["silver-spend", "--source", str(lake / "spend"), "--target", str(tmp_path / "s")])
    jobs.main(["silver-bookings", "--source", str(lake / "hooks"), "--target", str(tmp_path / "b")])
    assert read_table(spark, str(tmp_path / "s"), "parquet").count() == 7
    assert read_table(spark, str(tmp_path / "b"), "parquet").count() == 2
    with pytest.raises(ValueError, match="manifest"):
        jobs.spend_intake_job(spark, str(raw), str(lake / "x"), newest=1)


def test_jobs_leave_nothing_staged(spark, bronze, tmp_path):
    folder = Path(scratch_dir(spark)) / "adlake"
    before = set(folder.iterdir()) if folder.exists() else set()
    jobs.refresh_lakehouse(spark, *bronze, str(tmp_path / "lake"), layout="documents", fmt="parquet")
    assert set(folder.iterdir()) == before


def test_custom_paths(spark, tmp_path):
    write_table(spend(spark), str(tmp_path / "s"), partition_by=["spend_date"], fmt="parquet")
    paths = {"channel_spend_summary": str(tmp_path / "elsewhere")}
    jobs.gold_spend_job(spark, str(tmp_path / "s"), str(tmp_path / "g"), paths=paths, fmt="parquet")
    assert read_table(spark, str(tmp_path / "elsewhere"), "parquet").count() == 3
    assert {p.name for p in (tmp_path / "g").iterdir()} == {"daily_spend_by_channel"}


def test_write_modes(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def write(frame, mode):
        write_table(frame, path, mode=mode, partition_by=["spend_date"], fmt="parquet")
        return rows(read_table(spark, path, "parquet").select("spend_date", "channel", "spend_usd"))

    first = [(FIRST_DAY, "a", 1.0), (SECOND_DAY, "a", 2.0)]
    assert write(spend(spark, base=first), "overwrite") == first
    assert write(spend(spark, base=[(SECOND_DAY, "b", 3.0)]), "replace_partitions") == [first[0], (SECOND_DAY, "b", 3.0)]
    assert len(write(spend(spark, base=first), "append")) == 4
    assert write(spend(spark, base=first[:1]), "overwrite") == first[:1]
    with pytest.raises(ValueError, match="mode"):
        write(spend(spark), "upsert")


def test_one_date_is_spread_over_tasks_when_it_is_big(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        big = spark.range(400_000, numPartitions=8).selectExpr("id", "sha2(string(id), 256) AS text", "date'2026-01-01' AS day")
        write_table(big, str(tmp_path / "t"), partition_by=["day"], fmt="parquet")
        assert len(list((tmp_path / "t" / "day=2026-01-01").glob("*.parquet"))) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    small = spark.range(1000, numPartitions=8).selectExpr("id", "date'2026-01-01' AS day")
    write_table(small, str(tmp_path / "u"), partition_by=["day"], fmt="parquet")
    assert len(list((tmp_path / "u" / "day=2026-01-01").glob("*.parquet"))) == 1


def test_register_again_after_change(spark, tmp_path):
    path = str(tmp_path / "t")
    for days in ([FIRST_DAY], [FIRST_DAY, SECOND_DAY]):
        write_table(spend(spark, base=[(d, "a", 1.0) for d in days]), path, partition_by=["spend_date"], fmt="parquet")
        register_table(spark, "registered_spend", path, "parquet")
        assert spark.table("registered_spend").count() == len(days)


def test_export(spark, tmp_path):
    export_json(gold_bookings.booking_trends(bookings(spark)), str(tmp_path / "x"))
    lines = [json.loads(line) for p in (tmp_path / "x").glob("*.json") for line in p.read_text().splitlines()]
    assert {line["booking_date"]: line["booked_call_count"] for line in lines} == {"2024-03-06": 3, "2024-03-07": 3}


def test_session_helpers(spark):
    assert table_format(spark) == "parquet"
    assert staging_path(spark, "x") != staging_path(spark, "x")
    assert staging_path(spark, "x").startswith(scratch_dir(spark))
    staged = checkpointed(spark.range(5))
    assert staged.count() == 5 and "Range" not in staged._jdf.queryExecution().toString()


def test_reports(spark):
    tables = gold_bookings.booking_tables(bookings(spark))
    slots = reports.report(tables["booking_volume_by_time_slot"], "booking_volume_by_time_slot")
    assert [r[0] for r in slots.collect()] == ["Monday", "Tuesday", "Wednesday", "Wednesday"]
    load = reports.report(tables["employee_meeting_load"], "employee_meeting_load")
    assert [r.employee_name for r in load.collect()] == ["Ines", "Jon", "Unknown Employee"]
    priced = spark.createDataFrame(
        [("a", 1.0, 1, None), ("b", 9.0, 1, 9.0), ("c", 3.0, 1, 3.0)],
        "channel string, total_spend_usd double, booked_call_count long, cost_per_booking_usd double",
    )
    assert [r.channel for r in reports.report(priced, "cpb_by_channel").collect()] == ["c", "b", "a"]
    assert [r.channel for r in reports.by_keys(priced, "channel").collect()] == ["a", "b", "c"]
    assert reports.priced_rows(priced).count() == 2


def test_pivots_and_titles(spark, rows):
    calls = gold_bookings.daily_calls_by_source(bookings(spark))
    pivot = reports.calls_pivot(calls)
    assert pivot.columns == ["booking_date", "Facebook Paid Ads", "TikTok Paid Ads", "YouTube Paid Ads"]
    assert rows(pivot) == [(FIRST_DAY, 1, 1, 1), (SECOND_DAY, 2, 1, 0)]
    assert reports.calls_pivot(calls, ["tiktok_paid_ads"]).columns == ["booking_date", "TikTok Paid Ads"]
    daily = spark.createDataFrame(
        [(FIRST_DAY, "youtube_paid_ads", 2.0), (FIRST_DAY, "youtube_paid_ads", 4.0), (FIRST_DAY, "other", None), (SECOND_DAY, "other", 1.0)],
        "metric_date date, channel string, cost_per_booking_usd double",
    )
    cost = reports.cpb_pivot(daily)
    assert cost.columns == ["metric_date", "YouTube Paid Ads", "other"]
    assert rows(cost) == [(FIRST_DAY, 3.0, None), (SECOND_DAY, None, 1.0)]
    assert reports.with_titles(daily).columns == ["Metric Date", "Channel", "Cost per Booking"]
    assert reports.with_chart_titles(daily).head()["Channel"] == "YouTube Paid Ads"
