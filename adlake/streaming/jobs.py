"""Streaming counterparts of the batch jobs, over file sources.

All default to ``availableNow``: take in what is there, then stop, so a scheduler can run them
like batch jobs. ``every`` turns them into standing queries; ``files_per_batch`` bounds how much
one micro-batch of a backlog takes on.

Run ``python -m adlake.streaming.jobs --help`` for the command line.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from adlake.fixed_values import CHANNEL_BY_EVENT_TYPE
from adlake.functions import columns as c
from adlake.operators import gold_bookings, silver_bookings
from adlake.operators.bitmaps import added_bookings, daily_counts
from adlake.operators.quality import rejected_rows, valid_rows
from adlake.plans.jobs import GOLD_STAMP, SILVER_STAMP
from adlake.session import build_session, staged, table_format
from adlake.sources.intake import BOOKING_ENVELOPE, BOOKING_PARTITIONS, read_requests, webhook_intake
from adlake.sources.readers import read_bronze_bookings, read_table
from adlake.sources.sinks import stamped, write_table
from adlake.sources.versions import compacted, current, marks, write_run
from adlake.streaming.settled import settled_stream

FACTS_PARTITION = "booking_date"
#: Columns of silver, beside the required ones, that booking tables count by.
OPTIONAL = ["utm_campaign", "employee_id", "employee_name", "employee_email"]


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (
        writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    ).start()


def intake_stream(
    spark: SparkSession,
    requests: str,
    target: str,
    checkpoint: str,
    *,
    rejects: str | None = None,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    ingested_at: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Webhook requests to bronze JSON lines, exactly once. Rejects, when wanted, are a second
    query with a checkpoint of its own."""
    received = read_requests(spark, requests, streaming=True, files_per_batch=files_per_batch)
    checked = webhook_intake(received, channels=channels, ingested_at=ingested_at)
    good = valid_rows(checked).select(*BOOKING_ENVELOPE, *BOOKING_PARTITIONS)
    sink = good.writeStream.format("json").option("path", target).partitionBy(*BOOKING_PARTITIONS)
    queries = [_started(sink, f"{checkpoint}/bronze", every)]
    if rejects:
        bad = rejected_rows(checked).drop("raw_event", *BOOKING_PARTITIONS)
        sink = bad.writeStream.format("json").option("path", rejects)
        queries.append(_started(sink, f"{checkpoint}/rejects", every))
    return queries


def silver_stream(
    spark: SparkSession,
    bronze: str,
    target: str,
    checkpoint: str,
    *,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    once_within: str | None = None,
    fmt: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bronze to silver with the batch job's own transformation.

    ``once_within`` drops redeliveries that follow within that time. It is off by default:
    every count is a distinct count, and Spark drops rows that arrive later than the bound.
    """
    events = read_bronze_bookings(
        spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch
    )
    silver = silver_bookings.bookings(events, channels)
    if once_within:
        silver = first_deliveries(silver, once_within).drop("delivered_at")
    sink = (
        stamped(silver, SILVER_STAMP)
        .writeStream.format(fmt or table_format(spark))
        .option("path", target)
        .partitionBy(silver_bookings.PARTITION)
    )
    return _started(sink, checkpoint, every)


#: Runs of a streamed table beyond which the small ones are merged.
MOST_RUNS = 8


def silver_version_stream(
    spark: SparkSession,
    bronze: str,
    target: str,
    checkpoint: str,
    *,
    name: str = "silver",
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    most_runs: int = MOST_RUNS,
    fmt: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bronze to silver as a table with versions, kept compact while the stream goes on.

    A batch is one run, committed together with its number under the stream's ``name``: a batch that
    is replayed is told by that and left out. Readers see whole batches. Small runs are merged as
    they add up, so a date ends in a few files; the stream's own log knows nothing of files and stays valid.
    """
    events = read_bronze_bookings(spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch)
    silver = silver_bookings.bookings(events, channels)
    by, mark = [silver_bookings.PARTITION], f"batch of {name}"

    def add(batch: DataFrame, number: int) -> None:
        known = marks(spark, target)
        if known.get(mark, -1) >= number:
            return
        now = current(spark, target)
        # staged by the batch's session, which runs without AQE; the caller's does the rest
        with staged(batch) as rows:
            own = stamped(spark.read.schema(rows.schema).parquet(*rows.inputFiles()), SILVER_STAMP)
            write_run(
                own, target, onto=now.runs if now else (), partition_by=by, fmt=fmt, noted=known | {mark: number}
            ).commit()
        compacted(spark, target, most=most_runs, partition_by=by, fmt=fmt)

    return _started(silver.writeStream.foreachBatch(add), checkpoint, every)


def first_deliveries(silver: DataFrame, within: str) -> DataFrame:
    """One row per booking id among rows taken in ``within`` of each other.

    Time is that of intake, which hardly ever runs backwards, so no row is late merely because
    its booking is old. Rows without it count as taken in now.
    """
    taken_in = F.coalesce(c.instant(F.col("bronze_ingestion_timestamp")), F.current_timestamp())
    return (
        silver.withColumn("delivered_at", taken_in)
        .withWatermark("delivered_at", within)
        .dropDuplicatesWithinWatermark(["booking_id"])
    )


def closed_day_counts(silver: DataFrame, lateness: str) -> DataFrame:
    """Bookings per day and channel, each booking once, each day once: when ``lateness`` has
    passed since its end. Later rows of a closed day are not counted."""
    booked = (
        silver.withColumn("booked_at", c.instant(F.col("booking_created_at")))
        .where(F.col("booked_at").isNotNull())
        .withWatermark("booked_at", lateness)
        .dropDuplicatesWithinWatermark(["booking_id"])
    )
    days = booked.groupBy(F.window("booked_at", "1 day"), "channel").agg(
        F.count("*").alias(gold_bookings.CALLS)
    )
    return days.select(
        F.to_date("window.start").alias("booking_date"), "channel", gold_bookings.CALLS
    )


def closed_days_stream(
    spark: SparkSession,
    bronze: str,
    target: str,
    checkpoint: str,
    *,
    lateness: str = "1 day",
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    fmt: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    events = read_bronze_bookings(
        spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch
    )
    days = closed_day_counts(silver_bookings.bookings(events, channels), lateness)
    sink = days.writeStream.format(fmt or table_format(spark)).option("path", target)
    return _started(sink.outputMode("append"), checkpoint, every)


def gold_refresh_stream(
    spark: SparkSession,
    bronze: str,
    facts: str,
    gold: str,
    checkpoint: str,
    *,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    fmt: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Keep the per-day booking tables current by recomputing only the days a batch touches.

    ``facts`` is a slim copy of silver (the columns gold counts) laid out by booking date, so a
    refresh reads the touched days alone; silver itself is laid out by meeting date. A batch
    that is replayed after a failure appends its facts twice, which distinct counts absorb.
    """
    events = read_bronze_bookings(
        spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch
    )
    silver = silver_bookings.bookings(events, channels)

    def refresh(batch: DataFrame, _: int) -> None:
        rows = gold_bookings.valid_bookings(batch).persist()
        try:
            if rows.isEmpty():
                return
            write_table(
                rows, facts, mode="append", partition_by=[FACTS_PARTITION], fmt=fmt, rebalance=False
            )
            # the caller's session recomputes: the one of the batch runs without AQE
            with staged(rows.select(FACTS_PARTITION).distinct()) as days:
                touched = spark.read.schema(days.schema).parquet(*days.inputFiles())
                refresh_days(spark, facts, gold, touched, fmt=fmt)
        finally:
            rows.unpersist()

    return _started(silver.writeStream.foreachBatch(refresh), checkpoint, every)


def refresh_days(
    spark: SparkSession, facts: str, gold: str, touched: DataFrame, *, fmt: str | None = None
) -> None:
    """Recompute the per-day booking tables for the dates in ``touched``, however many.

    The dates are staged in the shared folder and prune the partitions of the facts by a
    semi-join. Without dates nothing is replaced.
    """
    with staged(touched.distinct()) as days:
        rows = read_table(spark, facts, fmt).join(days, FACTS_PARTITION, "left_semi")
        tables = {
            "daily_calls_by_source": gold_bookings.daily_calls_by_source(rows),
            "booking_trends": gold_bookings.booking_trends(rows),
        }
        for name, table in tables.items():
            write_table(
                stamped(table, GOLD_STAMP),
                f"{gold}/{name}",
                mode="replace_partitions",
                partition_by=gold_bookings.PARTITIONS[name],
                fmt=fmt,
            )


def take_in_bookings(spark: SparkSession, silver: DataFrame, bitmaps: str, gold: str, *, fmt: str | None = None) -> None:
    """Add a batch of silver bookings to the bitmaps and bring the per-day tables of the dates it
    touches up to date. Neither earlier bookings nor earlier facts are read."""
    with added_bookings(silver, bitmaps) as days:
        for name, table in daily_counts(spark, bitmaps, days).items():
            write_table(
                stamped(table, GOLD_STAMP),
                f"{gold}/{name}",
                mode="replace_partitions",
                partition_by=gold_bookings.PARTITIONS[name],
                fmt=fmt,
            )


def bitmap_stream(
    spark: SparkSession,
    bronze: str,
    bitmaps: str,
    gold: str,
    checkpoint: str,
    *,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    fmt: str | None = None,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """The per-day booking tables kept current by merging bitmaps (see ``operators.bitmaps``).

    Unlike ``gold_refresh_stream`` it keeps no copy of the facts and reads none again, and the
    other booking tables can be cut from the same bitmaps at any time. A batch that is replayed
    changes nothing.
    """
    events = read_bronze_bookings(spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch)
    silver = silver_bookings.bookings(events, channels)

    def take_in(batch: DataFrame, _: int) -> None:
        # staged by the batch's session, which runs without AQE; the caller's does the rest
        with staged(batch.select(*gold_bookings.REQUIRED, *OPTIONAL)) as rows:
            own = spark.read.schema(rows.schema).parquet(*rows.inputFiles()) if rows.inputFiles() else None
            if own is not None and not own.isEmpty():
                take_in_bookings(spark, own, bitmaps, gold, fmt=fmt)

    return _started(silver.writeStream.foreachBatch(take_in), checkpoint, every)


def _parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--source", required=True)
    shared.add_argument("--target", required=True)
    shared.add_argument("--checkpoint", required=True)
    shared.add_argument("--channels", help="JSON object of event type URI to channel")
    shared.add_argument("--every", help="keep running, with this interval; else take in what is there")
    shared.add_argument("--files-per-batch", type=int)
    shared.add_argument("--shuffle-partitions", type=int)
    of_bronze = argparse.ArgumentParser(add_help=False)
    of_bronze.add_argument("--layout", default="lines", help="lines, as our own intake writes, or documents")
    of_bronze.add_argument("--format", dest="fmt", default="parquet")

    parser = argparse.ArgumentParser(prog="adlake streams")
    streams = parser.add_subparsers(dest="stream", required=True)
    streams.add_parser("intake", parents=[shared]).add_argument("--rejects")
    silver = streams.add_parser("silver", parents=[shared, of_bronze])
    silver.add_argument("--once-within")
    silver.add_argument("--versions", action="store_true", help="a table with versions, kept compact")
    streams.add_parser("closed-days", parents=[shared, of_bronze]).add_argument("--lateness", default="1 day")
    settled = streams.add_parser("settled", parents=[shared, of_bronze], help="closed days, late and repeated rows reported")
    settled.add_argument("--lateness", default="1 day")
    gold = streams.add_parser("gold", parents=[shared, of_bronze], help="--target is the root of the gold tables")
    gold.add_argument("--facts", required=True)
    merging = streams.add_parser("bitmaps", parents=[shared, of_bronze], help="--target is the root of the gold tables")
    merging.add_argument("--bitmaps", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"adlake {args.stream} stream", shuffle_partitions=args.shuffle_partitions)
    common = {
        "channels": json.loads(args.channels) if args.channels else CHANNEL_BY_EVENT_TYPE,
        "every": args.every,
        "files_per_batch": args.files_per_batch,
    }
    if args.stream == "intake":
        queries = intake_stream(spark, args.source, args.target, args.checkpoint, rejects=args.rejects, **common)
    else:
        common |= {"layout": args.layout, "fmt": args.fmt}
        where = (spark, args.source, args.target, args.checkpoint)
        if args.stream == "silver" and args.versions:
            if args.once_within:
                raise SystemExit("--once-within is for the stream without versions")
            queries = [silver_version_stream(*where, **common)]
        elif args.stream == "silver":
            queries = [silver_stream(*where, once_within=args.once_within, **common)]
        elif args.stream == "closed-days":
            queries = [closed_days_stream(*where, lateness=args.lateness, **common)]
        elif args.stream == "settled":
            options = {key: value for key, value in common.items() if key != "fmt"}
            queries = [settled_stream(*where, lateness=args.lateness, **options)]
        elif args.stream == "bitmaps":
            queries = [bitmap_stream(spark, args.source, args.bitmaps, args.target, args.checkpoint, **common)]
        else:
            queries = [gold_refresh_stream(spark, args.source, args.facts, args.target, args.checkpoint, **common)]
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
