import json

from adlake.operators import gold_bookings, silver_bookings
from adlake.sources.readers import read_bronze_bookings, read_table
from adlake.streaming import jobs as streams
from tests.samples import YOUTUBE, envelope, webhook


def deliver(folder, name, *events, at="2025-10-08T07:42:00+00:00"):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(envelope(event) | {"ingestion_timestamp": at}) for event in events]
    (folder / name).write_text("\n".join(lines))


def finished(*queries):
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None


def test_intake_stream_resumes_without_repeats(spark, tmp_path):
    source = tmp_path / "requests"
    source.mkdir()
    paths = [str(tmp_path / name) for name in ("bronze", "rejects", "checkpoint")]

    def take_in():
        finished(*streams.intake_stream(spark, str(source), paths[0], paths[2], rejects=paths[1]))
        return read_bronze_bookings(spark, paths[0], layout="lines")

    (source / "1.json").write_text(json.dumps({"body": json.dumps(webhook("1"))}))
    (source / "2.json").write_text(json.dumps({"body": "{broken"}))
    assert {r.booking_id for r in take_in().collect()} == {"book-1"}
    (source / "3.json").write_text(json.dumps({"body": json.dumps(webhook("3"))}))
    assert sorted(r.booking_id for r in take_in().collect()) == ["book-1", "book-3"]
    (bad,) = spark.read.json(paths[1]).collect()
    assert bad.body == "{broken" and bad.reject_reasons[0] == "invalid_json"


def test_stream_equals_batch(spark, tmp_path):
    bronze, target = tmp_path / "bronze", str(tmp_path / "silver")
    deliver(bronze, "1.json", webhook("1"), webhook("2", kind=YOUTUBE), webhook("3", start=None), webhook("1"))
    finished(streams.silver_stream(spark, str(bronze), target, str(tmp_path / "c"), fmt="parquet"))
    batch = silver_bookings.bookings(read_bronze_bookings(spark, str(bronze), layout="lines"))
    streamed = read_table(spark, target, "parquet").select(batch.columns)
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, batch.collect()))
    assert batch.count() == 3


def test_redeliveries_are_dropped_across_runs(spark, tmp_path):
    bronze, target = tmp_path / "bronze", str(tmp_path / "silver")

    def run():
        finished(streams.silver_stream(spark, str(bronze), target, str(tmp_path / "c"), once_within="2 days", fmt="parquet"))
        return sorted(r.booking_id for r in read_table(spark, target, "parquet").collect())

    deliver(bronze, "1.json", webhook("1"), webhook("1"))
    assert run() == ["book-1"]
    deliver(bronze, "2.json", webhook("1"), webhook("2"), at="2025-10-09T00:00:00+00:00")
    assert run() == ["book-1", "book-2"]


def test_gold_refresh_touches_only_its_days(spark, tmp_path):
    bronze, facts, gold = tmp_path / "bronze", str(tmp_path / "facts"), str(tmp_path / "gold")

    def run():
        finished(streams.gold_refresh_stream(spark, str(bronze), facts, gold, str(tmp_path / "c"), fmt="parquet"))
        table = read_table(spark, f"{gold}/daily_calls_by_source", "parquet")
        return {(str(r.booking_date), r.channel): (r.booked_call_count, r.gold_processed_at) for r in table.collect()}

    deliver(bronze, "1.json", webhook("1"), webhook("2", created_at="2025-10-10T10:00:00Z"))
    first = run()
    deliver(bronze, "2.json", webhook("1"), webhook("3"), webhook("4", kind=YOUTUBE))
    second = run()
    october_8, october_10 = ("2025-10-08", "facebook_paid_ads"), ("2025-10-10", "facebook_paid_ads")
    assert {k: v[0] for k, v in second.items()} == {october_8: 2, october_10: 1, ("2025-10-08", "youtube_paid_ads"): 1}
    assert second[october_10] == first[october_10] and second[october_8][1] > first[october_8][1]
    full = gold_bookings.booking_trends(silver_bookings.bookings(read_bronze_bookings(spark, str(bronze), layout="lines")))
    trends = read_table(spark, f"{gold}/booking_trends", "parquet")
    assert {(str(r.booking_date), r.booked_call_count) for r in trends.collect()} == {(str(r[0]), r[1]) for r in full.collect()}


def test_refresh_of_several_days(spark, tmp_path):
    bronze, facts, gold = tmp_path / "bronze", str(tmp_path / "facts"), str(tmp_path / "gold")
    deliver(bronze, "1.json", *(webhook(str(n), created_at=f"2025-07-{n:02}T10:00:00Z") for n in range(1, 5)))
    finished(streams.gold_refresh_stream(spark, str(bronze), facts, gold, str(tmp_path / "c"), fmt="parquet"))
    assert read_table(spark, f"{gold}/booking_trends", "parquet").count() == 4


def test_days_are_counted_once_closed(spark, tmp_path):
    bronze, target = tmp_path / "bronze", str(tmp_path / "days")

    def run():
        finished(streams.closed_days_stream(spark, str(bronze), target, str(tmp_path / "c"), lateness="1 day", fmt="parquet"))
        return {(str(r.booking_date), r.channel): r.booked_call_count for r in read_table(spark, target, "parquet").collect()}

    deliver(bronze, "1.json", webhook("1"), webhook("2"), webhook("1"))
    assert run() == {}
    deliver(bronze, "2.json", webhook("3"), webhook("4", created_at="2025-10-11T10:00:00Z"))
    assert run() == {("2025-10-08", "facebook_paid_ads"): 3}


def test_command_line(spark, tmp_path):
    source, root = tmp_path / "requests", str(tmp_path)
    source.mkdir()
    bodies = [json.dumps(webhook("1")), json.dumps(webhook("2")), "{broken"]
    (source / "1.json").write_text("\n".join(json.dumps({"body": body}) for body in bodies))

    def run(stream, source, target, *more):
        streams.main([stream, "--source", f"{root}/{source}", "--target", f"{root}/{target}", "--checkpoint", f"{root}/c-{stream}", *more])

    run("intake", "requests", "bronze", "--rejects", f"{root}/rejects")
    run("silver", "bronze", "silver", "--files-per-batch", "1")
    run("gold", "bronze", "gold", "--facts", f"{root}/facts")
    run("closed-days", "bronze", "days", "--lateness", "1 hour")
    assert read_table(spark, f"{root}/silver", "parquet").count() == 2
    calls = read_table(spark, f"{root}/gold/booking_trends", "parquet")
    assert [r.booked_call_count for r in calls.collect()] == [2]
