"""Places in a total order, without a window over all rows in one task."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.session import checkpointed, staged

#: ``monotonically_increasing_id`` has the partition above this bit and the row within it below.
_ROW_BITS = 33


def _numbered(rows: DataFrame, before: DataFrame) -> DataFrame:
    index = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    known = rows.withColumn("_part", F.shiftright("_at", _ROW_BITS)).join(before, "_part")
    return known.withColumn("place", F.col("_before") + index + 1).drop("_at", "_part", "_before")


def _sorted(df: DataFrame, order: tuple[Column, ...]) -> DataFrame:
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.withColumn("_at", F.monotonically_increasing_id())


def _offsets(rows: DataFrame) -> DataFrame:
    sizes = rows.groupBy(F.shiftright("_at", _ROW_BITS).alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def with_places(df: DataFrame, *order: Column) -> DataFrame:
    """The rows with ``place``: 1, 2, 3 and so on along ``order``, which must tell rows apart
    where it matters which of them comes first.

    Rows are dealt out by range and sorted, and staged with the number of their partition and
    their index in it, so that a repeated task cannot number them differently. A place is that
    index plus the sizes of the partitions before: only one count per partition meets in one task.
    """
    rows = checkpointed(_sorted(df, order))
    return _numbered(rows, checkpointed(_offsets(rows)))


@contextmanager
def placed(df: DataFrame, *order: Column) -> Iterator[DataFrame]:
    """As ``with_places``, for use within; what it stages is deleted afterwards."""
    with staged(_sorted(df, order)) as rows, staged(_offsets(rows)) as before:
        yield _numbered(rows, before)


def ranked(numbered: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``place``, where those equal in ``keys`` share the first place among them."""
    first = numbered.groupBy(*keys).agg(F.min("place").alias("_first"))
    shared = first.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [numbered[key].eqNullSafe(shared[f"_{key}"]) for key in keys]
    return numbered.join(shared, same).withColumn("place", F.col("_first")).drop("_first", *(f"_{key}" for key in keys))
