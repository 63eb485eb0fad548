"""Closed days with nothing lost: late and repeated deliveries come out as rows of their own.

Beside the checkpoint's own folders, ``deliveries`` keeps how often each batch brought a booking id:
a table with versions, so that a batch numbers its deliveries by one join instead of a call per id.
Every delivery gets its number; none is dropped for being late or repeated. A batch reads the ids
and counts of all batches before, and nothing else of them. Each micro-batch then writes, under its
own number,

* ``increments``: first deliveries per booking date and channel,
* ``progress``: the latest booking time it has seen, which closes the days before,
* ``reported``: repeated deliveries, and first ones that came after their day was closed,

and brings ``closed_days`` up to date: the days it closes, and those its late rows belong to. All of
it is replaced when a batch is replayed. However a backlog is cut into batches, ``closed_days`` ends
the same; only which rows count as late depends on the cut.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlake.fixed_values import CHANNEL_BY_EVENT_TYPE
from adlake.functions import columns as c
from adlake.operators import gold_bookings, silver_bookings
from adlake.session import staged
from adlake.sources.readers import read_bronze_bookings
from adlake.sources.sinks import write_table
from adlake.sources.versions import compacted, current, marks, read_version, write_run

CALLS = gold_bookings.CALLS
#: Runs of ``deliveries`` beyond which the small ones are merged.
MOST_RUNS = 8

COLUMNS = ["booking_id", "channel", "booking_date", "booked_at", "delivered_at", "raw_s3_key"]
INCREMENT = f"channel string, {CALLS} long, booking_date date, batch long"
PROGRESS = "latest timestamp, batch long"


def booked_deliveries(silver: DataFrame) -> DataFrame:
    """The streamed bookings that have a time, with what settling needs of them."""
    return silver.select(
        "booking_id", "channel", "booking_date", c.instant(F.col("booking_created_at")).alias("booked_at"),
        F.col("bronze_ingestion_timestamp").alias("delivered_at"), F.col("bronze_raw_s3_key").alias("raw_s3_key"),
    ).where(F.col("booked_at").isNotNull())


def numbered_deliveries(spark: SparkSession, rows: DataFrame, batch: int, kept: str) -> DataFrame:
    """The rows of a batch, each with the number of its delivery, from 1, over the whole life of
    the stream. Replayed, a batch counts on from the same: only those before it are read."""
    known = current(spark, kept)
    order = [F.coalesce(name, F.lit("")) for name in ("delivered_at", "raw_s3_key", "channel")]
    here = F.row_number().over(Window.partitionBy("booking_id").orderBy(*order)).cast("long")
    if known is None:
        return rows.withColumn("delivery", here)
    before = read_version(spark, kept, known, "parquet").where(F.col("batch") < batch)
    before = before.join(rows.select("booking_id").distinct(), "booking_id", "left_semi")
    counted = before.groupBy("booking_id").agg(F.sum("n").alias("_before"))
    joined = rows.withColumn("delivery", here).join(counted, "booking_id", "left")
    return joined.withColumn("delivery", F.col("delivery") + F.coalesce("_before", F.lit(0))).drop("_before").select(*COLUMNS, "delivery")


def _keep_counts(spark: SparkSession, rows: DataFrame, batch: int, kept: str) -> None:
    """Add how often a batch brought each id; nothing where it has been added before."""
    if marks(spark, kept).get("batch", -1) >= batch:
        return
    now = current(spark, kept)
    counts = rows.groupBy("booking_id").agg(F.count("*").alias("n")).withColumn("batch", F.lit(batch).cast("long"))
    write_run(counts, kept, onto=now.runs if now else (), fmt="parquet", noted={"batch": batch}).commit()
    compacted(spark, kept, most=MOST_RUNS, fmt="parquet")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def closed_before(spark: SparkSession, root: str, batches: Column, lateness: str):
    """The date before which all days are closed, by what some batches have seen; None for none."""
    latest = _read(spark, f"{root}/progress", PROGRESS).where(batches).agg(F.max("latest").alias("t"))
    return latest.select(F.to_date(F.col("t") - F.expr(f"INTERVAL '{lateness}'"))).first()[0]


def settle(spark: SparkSession, rows: DataFrame, batch: int, root: str, lateness: str) -> None:
    """What one batch of numbered deliveries changes under ``root``. Replayed, it replaces itself."""
    number = F.lit(batch).cast("long").alias("batch")
    before = closed_before(spark, root, F.col("batch") < batch, lateness)
    latest = rows.agg(F.max("booked_at").alias("latest")).select("latest", number)
    write_table(latest, f"{root}/progress", mode="replace_partitions", partition_by=["batch"], fmt="parquet", rebalance=False)

    first = F.col("delivery") == 1
    late = first & (F.col("booking_date") < F.lit(before)) if before else F.lit(False)
    kind = F.when(~first, F.lit("repeated")).when(late, F.lit("late"))
    reported = rows.withColumn("kind", kind).where(F.col("kind").isNotNull()).withColumn("batch", number)
    write_table(reported, f"{root}/reported", mode="replace_partitions", partition_by=["batch"], fmt="parquet", rebalance=False)

    counts = rows.where(first).groupBy("booking_date", "channel").agg(F.count("*").alias(CALLS)).withColumn("batch", number)
    by = ["booking_date", "batch"]
    write_table(counts, f"{root}/increments", mode="replace_partitions", partition_by=by, fmt="parquet")

    now = closed_before(spark, root, F.col("batch") <= batch, lateness)
    if now is None:
        return
    closing = F.col("booking_date") < F.lit(now)
    if before is not None:
        closing &= (F.col("booking_date") >= F.lit(before)) | F.col("booking_date").isin(_late_days(reported))
    days = _read(spark, f"{root}/increments", INCREMENT).where(closing & (F.col("batch") <= batch))
    settled = days.groupBy("booking_date", "channel").agg(F.sum(CALLS).alias(CALLS))
    write_table(settled, f"{root}/closed_days", mode="replace_partitions", partition_by=["booking_date"], fmt="parquet")


def _late_days(reported: DataFrame) -> list:
    # dates only: as many as late rows of one batch fall on
    return [row[0] for row in reported.where("kind = 'late'").select("booking_date").distinct().collect()]


def settled_stream(
    spark: SparkSession,
    bronze: str,
    root: str,
    checkpoint: str,
    *,
    lateness: str = "1 day",
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    layout: str = "lines",
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bookings per closed day and channel under ``root/closed_days``, each booking once, and every
    late or repeated delivery under ``root/reported``.

    A day is closed when a booking ``lateness`` past its end has been seen. Later rows of the day are
    reported, and its counts replaced by ones that hold them. Where deliveries of one id differ in
    day or channel, the first counts: of those in one batch the one taken in first.
    """
    events = read_bronze_bookings(spark, bronze, layout=layout, streaming=True, files_per_batch=files_per_batch)
    booked, kept = booked_deliveries(silver_bookings.bookings(events, channels)), f"{checkpoint.rstrip('/')}/deliveries"

    def take(batch: DataFrame, number: int) -> None:
        # staged by the batch's session, which runs without AQE; the caller's does the rest
        with staged(batch) as rows:
            own = spark.read.schema(rows.schema).parquet(*rows.inputFiles())
            if own.isEmpty():
                return
            with staged(numbered_deliveries(spark, own, number, kept)) as numbered:
                settle(spark, numbered, number, root, lateness)
                _keep_counts(spark, numbered, number, kept)

    writer = booked.writeStream.outputMode("append").foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
