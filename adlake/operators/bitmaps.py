"""Exact distinct counts that can be merged: booking numbers and bitmaps of them.

Every booking id gets a number once and for all, dense from 1, from a dictionary that only grows.
A delivery then is one bitmap per key of a grain and block of 32,768 numbers. Bitmaps are merged
by OR, which a booking delivered twice, late, or in a batch that is run again does not change, so
new ones are simply added to the old: no earlier fact is read again. Counts are those of set
bits, and a coarser grain is the OR of a finer one.

Numbers follow the order of first delivery, so the bookings of a day lie in few blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.gold_bookings import CALLS, CUBE, valid_bookings
from adlake.operators.grains import GRAIN, at_grains, grain_columns
from adlake.operators.places import placed
from adlake.session import staged
from adlake.sources.versions import compacted, current, read_version, write_run

ID, NUMBER = "booking_id", "number"

#: Grains of which bitmaps are kept; the two others are merged from the first.
DAILY = "daily_calls_by_source"
KEPT = {name: keys for name, keys in CUBE.items() if name not in ("booking_trends", "everything")}
LAYOUT = [GRAIN, "booking_date"]
#: Runs of a table beyond which the small ones are merged.
MOST_RUNS = 16


def _added(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    spark, by = df.sparkSession, partition_by or []
    now = current(spark, path)
    write_run(df, path, onto=now.runs if now else (), partition_by=by, fmt="parquet").commit()
    compacted(spark, path, most=MOST_RUNS, partition_by=by, fmt="parquet")


def booking_numbers(ids: DataFrame, path: str) -> DataFrame:
    """The dictionary (booking_id, number) at ``path`` after the new ones of ``ids`` have got a
    number. Numbers never change, and a job that dies in between has given none."""
    spark = ids.sparkSession
    now = current(spark, path)
    known = read_version(spark, path, now, "parquet") if now else None
    once = ids.select(ID).where(F.col(ID).isNotNull()).distinct()
    with staged(once if known is None else once.join(known, ID, "left_anti")) as new:
        if not new.isEmpty() or known is None:
            taken = 0 if known is None else known.count()
            with placed(new, F.col(ID)) as rows:
                _added(rows.select(ID, (F.col("place") + taken).alias(NUMBER)), path)
    return read_version(spark, path, current(spark, path), "parquet")


def batch_bitmaps(rows: DataFrame) -> DataFrame:
    """grain, its keys, block and bitmap of rows that hold a booking number and the keys."""
    once = rows.select(NUMBER, *grain_columns(KEPT)).distinct()
    each = at_grains(once, KEPT, NUMBER)
    block, bit = F.bitmap_bucket_number(NUMBER).alias("block"), F.bitmap_bit_position(NUMBER)
    return each.groupBy(GRAIN, *grain_columns(KEPT), block).agg(F.bitmap_construct_agg(bit).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy(GRAIN, *grain_columns(KEPT), "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def cube_of(bitmaps: DataFrame) -> DataFrame:
    """The distinct bookings per key of all grains of ``booking_cube``, from bitmaps alone."""
    columns = grain_columns(KEPT)
    whole = merged_bitmaps(bitmaps)

    def coarser(finer: DataFrame, name: str, keys: list[str]) -> DataFrame:
        ored = finer.groupBy(*keys, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        types = dict(bitmaps.dtypes)
        shown = [F.col(c) if c in keys else F.lit(None).cast(types[c]).alias(c) for c in columns]
        return ored.select(F.lit(name).alias(GRAIN), *shown, "block", "bitmap")

    trends = coarser(whole.where(F.col(GRAIN) == DAILY), "booking_trends", ["booking_date"])
    everything = coarser(trends, "everything", [])
    counted = whole.unionByName(trends).unionByName(everything)
    return counted.groupBy(GRAIN, *columns).agg(F.sum(F.bitmap_count("bitmap")).alias(CALLS))


@contextmanager
def added_bookings(silver: DataFrame, root: str) -> Iterator[DataFrame]:
    """Takes a batch of silver bookings into the bitmaps under ``root``; within, the booking dates
    it touches. Run again with the same rows, it changes no count."""
    with staged(valid_bookings(silver).select(ID, *grain_columns(KEPT)).distinct()) as rows:
        numbers = booking_numbers(rows, f"{root}/numbers")
        _added(batch_bitmaps(rows.join(numbers, ID)), f"{root}/bitmaps", LAYOUT)
        yield rows.select("booking_date").distinct()


def kept_bitmaps(spark: SparkSession, root: str) -> DataFrame:
    """All bitmaps under ``root``, several per key and block where batches overlap."""
    return read_version(spark, f"{root}/bitmaps", current(spark, f"{root}/bitmaps"), "parquet")


def daily_counts(spark: SparkSession, root: str, days: DataFrame) -> dict[str, DataFrame]:
    """The two per-day booking tables of the given dates, read from the bitmaps of those dates."""
    of_days = kept_bitmaps(spark, root).where(F.col(GRAIN) == DAILY).join(days, "booking_date", "left_semi")
    by_channel = of_days.groupBy("booking_date", "channel", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    by_day = by_channel.groupBy("booking_date", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    count = F.sum(F.bitmap_count("bitmap")).alias(CALLS)
    return {
        DAILY: by_channel.groupBy("booking_date", "channel").agg(count),
        "booking_trends": by_day.groupBy("booking_date").agg(count),
    }
