"""What several operators share: words, portable hashes, and tables staged in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import staging_path

#: A word is a run of anything but ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    found = F.split(text, r"[\x20\x09-\x0D]+")
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words, without building them; 0 for NULL.

    Words start where white space, or the start of the text, is followed by something else.
    """
    squeezed = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    gaps = F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(squeezed == "", 0).otherwise(gaps + 1), F.lit(0)).cast("long")


def hash52(*parts: Column) -> Column:
    """A whole number below 2**52 from the first 13 hex digits of an MD5.

    Portable across engines, unlike ``xxhash64``, so that SQL elsewhere can follow it. NULL
    parts count as empty.
    """
    joined = F.concat_ws(":", *(F.coalesce(part.cast("string"), F.lit("")) for part in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def hash52_sql(*parts: str) -> str:
    """``hash52`` for DuckDB."""
    joined = " || ':' || ".join(f"COALESCE(CAST({part} AS VARCHAR), '')" for part in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 13) AS BIGINT)"


def scanned(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running combination of an array's elements: each with all before it, in order.

    By doubling: after step p every element holds the last 2**p ones. That is n log n, where a
    fold that appends to its result copies it each time and is quadratic.
    """
    last = F.size(values) - 1
    steps = F.when(last > 0, F.sequence(F.lit(0), F.floor(F.log2(last.cast("double"))).cast("int"))).otherwise(F.array().cast("array<int>"))

    def doubled(found: Column, p: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), p)
        return F.transform(found, lambda x, i: F.when(i >= back, combine(F.get(found, i - back), x)).otherwise(x))

    return F.aggregate(steps, values, doubled)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def column(name: str) -> Column:
    """A column by its plain name, whatever is in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no name of an operator can clash with them."""
    return F.struct(*(column(name) for name in docs.columns)).alias("row")


def out_of_row(names: Sequence[str], renewed: Mapping[str, Column] | None = None) -> list[Column]:
    """The columns of a struct ``row`` again, those in ``renewed`` replaced."""
    return [(renewed or {}).get(name, F.col("row")[name]).alias(name) for name in names]


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, Spark deletes the shuffle files of each query when it ends.

    Jobs that stage one table after another then need the disk of the largest step, not of all.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


#: Folders staged within the open ``staging_deleted`` blocks, innermost last.
_open_blocks: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging_deleted(spark: SparkSession):
    """At its end, deletes all tables that operators have staged within.

    For a caller who has written what they returned: a frame that is still to be computed reads
    those tables.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path in _open_blocks.pop():
            _delete(spark, path)


class Staging:
    """Tables of one run in the folder that the cluster shares, so that no lost executor takes
    them along and no later step repeats the work behind them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = staging_path(spark, name)
        self.count = 0
        if _open_blocks:
            _open_blocks[-1].append(self.root)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a frame and read it back."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for frame in frames:
            for file in frame.inputFiles()[:1]:
                _delete(self.spark, file.rpartition("/")[0])
