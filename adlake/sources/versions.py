"""Tables whose changes appear at once: runs are written aside, then one small file commits them.

Under a table's path, each write makes a folder ``_runs/_run=<id>``, which no reader knows of yet.
A commit is a file ``_commits/<number>`` that lists the runs the table consists of; it comes into
being by one rename. Readers take the highest number. So a job that dies anywhere leaves them on
the version before, and that version's files stay, for queries under way and for going back.

Beside its rows a run can hold the list of the input files they came from. As that is committed
with the rows, an append that is run again finds which inputs are in the table already.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adlake.session import table_format
from adlake.sources.files import Folder

RUN = "_run"
#: File in a run's folder that tells its columns.
SHAPE = "_shape"
#: Commits whose runs are kept when older ones are cleared away.
KEEP = 2
#: The input files of a run: where, how large, last changed when.
INPUT_FILES = ["path", "length", "modificationTime"]


@dataclass(frozen=True)
class Version:
    """A committed state of a table: its number and the runs it consists of."""

    number: int
    runs: tuple[str, ...]


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Every committed version that is kept, oldest first; none for a path written in place."""
    folder = Folder(spark, path)
    numbers = [name for name in folder.names("_commits") if name.isdigit()]
    return [Version(int(name), tuple(json.loads(folder.text(f"_commits/{name}")))) for name in numbers]


def current(spark: SparkSession, path: str) -> Version | None:
    folder = Folder(spark, path)
    numbers = [name for name in folder.names("_commits") if name.isdigit()]
    return Version(int(numbers[-1]), tuple(json.loads(folder.text(f"_commits/{numbers[-1]}")))) if numbers else None


def run_folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_runs/{RUN}={run}"


@dataclass(frozen=True)
class Shape:
    """The columns of a run and those it is laid out by, which come last, and what its writer
    noted about the table as of this run."""

    schema: StructType
    partition_by: tuple[str, ...]
    marks: Mapping[str, str | int]


def shape_of(spark: SparkSession, path: str, run: str) -> Shape:
    known = json.loads(Folder(spark, path).text(f"_runs/{RUN}={run}/{SHAPE}"))
    return Shape(StructType.fromJson(known["schema"]), tuple(known["partition_by"]), known["marks"])


def marks(spark: SparkSession, path: str) -> dict[str, str | int]:
    """What has been noted about the current version; empty without one."""
    now = current(spark, path)
    return dict(shape_of(spark, path, now.runs[-1]).marks) if now else {}


def read_version(spark: SparkSession, path: str, version: Version, fmt: str | None = None) -> DataFrame:
    """The rows of a version, with the columns of its last run. Types are those that were written,
    also of the columns that the files do not hold, and of a run without rows."""
    shape = shape_of(spark, path, version.runs[-1])
    schema = StructType([*shape.schema.fields, StructField(RUN, StringType())])
    reader = spark.read.format(fmt or table_format(spark)).schema(schema).option("basePath", f"{path.rstrip('/')}/_runs")
    return reader.load([run_folder(path, run) for run in version.runs]).drop(RUN)


@dataclass(frozen=True)
class Pending:
    """Runs that are written and not yet committed, on top of version ``base``."""

    spark: SparkSession
    path: str
    base: int
    runs: tuple[str, ...]

    def commit(self, keep: int = KEEP) -> Version:
        """Make them the table. Fails, changing nothing, if another writer has committed since.

        Runs of versions before the last ``keep`` are deleted, and those that never were committed
        with them: a table has one writer at a time.
        """
        number = self.base + 1
        Folder(self.spark, self.path).put(f"_commits/{number:010d}", json.dumps(self.runs))
        _clear(self.spark, self.path, keep)
        return Version(number, self.runs)


def _clear(spark: SparkSession, path: str, keep: int) -> None:
    folder = Folder(spark, path)
    kept = versions(spark, path)[-keep:]
    used = {f"{RUN}={run}" for version in kept for run in version.runs}
    for name in folder.names("_commits"):
        if name.isdigit() and int(name) < kept[0].number:
            folder.delete(f"_commits/{name}")
    for name in folder.names("_runs"):
        if name not in used:
            folder.delete(f"_runs/{name}")


def write_run(
    df: DataFrame,
    path: str,
    *,
    onto: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    fmt: str | None = None,
    inputs: DataFrame | None = None,
    noted: Mapping[str, str | int] | None = None,
) -> Pending:
    """Write a frame aside. Committed, the table consists of it and of the runs in ``onto``.

    ``inputs`` (path, length, modificationTime) are the files it was made from; ``noted`` are
    marks of the version it makes, committed with it. A partitioned write is rebalanced as by
    ``write_table``.
    """
    spark = df.sparkSession
    now = current(spark, path)
    run = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    target = run_folder(path, run)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt or table_format(spark))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
    fields = sorted(df.schema.fields, key=lambda field: field.name in partition_by)
    fields = [StructField(field.name, field.dataType, True) for field in fields]
    shape = {"schema": StructType(fields).jsonValue(), "partition_by": list(partition_by), "marks": dict(noted or {})}
    Folder(spark, path).put(f"_runs/{RUN}={run}/{SHAPE}", json.dumps(shape))
    if inputs is not None:
        inputs.select(*INPUT_FILES).write.parquet(f"{target}/_inputs")
    return Pending(spark, path, now.number if now else 0, (*onto, run))


def publish(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    fmt: str | None = None,
    noted: Mapping[str, str | int] | None = None,
) -> Pending:
    """A new version that replaces all there is, still to be committed."""
    return write_run(df, path, partition_by=partition_by, fmt=fmt, noted=noted)


def publish_partitions(df: DataFrame, path: str, *, partition_by: Sequence[str], fmt: str | None = None) -> Pending:
    """A new version in which ``df`` replaces the partitions it has rows of. The others are copied,
    so this reads and writes the whole table: the price of the change appearing at once."""
    spark = df.sparkSession
    now = current(spark, path)
    if now is None:
        return publish(df, path, partition_by=partition_by, fmt=fmt)
    old = read_version(spark, path, now, fmt)
    touched = df.select(*partition_by).distinct()
    same = [old[name].eqNullSafe(touched[name]) for name in partition_by]
    others = old.join(touched, same, "left_anti")
    return publish(others.unionByName(df), path, partition_by=partition_by, fmt=fmt)


def roll_back(spark: SparkSession, path: str) -> Version:
    """Commit the version before the current one again."""
    known = versions(spark, path)
    if len(known) < 2:
        raise ValueError(f"{path} has no version to go back to")
    return Pending(spark, path, known[-1].number, known[-2].runs).commit()


def input_files(spark: SparkSession, source: str | Iterable[str]) -> DataFrame:
    """The files under a path at any depth, as (path, length, modificationTime). Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.load(source if isinstance(source, str) else list(source)).select(*INPUT_FILES)


def taken_in(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame | None:
    """The input files of the given committed runs, or all; None where none is recorded."""
    now, folder = current(spark, path), Folder(spark, path)
    asked = runs if runs is not None else now.runs if now else ()
    recorded = [run for run in asked if folder.names(f"_runs/{RUN}={run}/_inputs")]
    return spark.read.parquet(*(f"{run_folder(path, run)}/_inputs" for run in recorded)) if recorded else None


def new_inputs(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The files under ``source`` that the table at ``path`` does not hold yet. A file that has
    changed in size or time counts as new."""
    found, known = input_files(spark, source), taken_in(spark, path)
    return found if known is None else found.join(known, INPUT_FILES, "left_anti")


def fingerprint(spark: SparkSession, source: str) -> str:
    """What the files under a path, or the version there, amount to: changes when one of them does."""
    now = current(spark, source)
    if now is not None:
        return f"runs {','.join(sorted(now.runs))}"
    each = F.xxhash64(*INPUT_FILES).cast("decimal(38,0)")
    row = input_files(spark, source).agg(F.count("*").alias("n"), F.sum(each).alias("digest"), F.sum("length").alias("bytes")).first()
    return f"files {row['n']} {row['digest']} {row['bytes']}"


def append(
    df: DataFrame, path: str, *, inputs: DataFrame, partition_by: Sequence[str] = (), fmt: str | None = None
) -> Pending:
    """One run more, made from ``inputs``; a first one makes the table. Nothing is copied."""
    now = current(df.sparkSession, path)
    return write_run(df, path, onto=now.runs if now else (), partition_by=partition_by, fmt=fmt, inputs=inputs)


def location(spark: SparkSession, path: str) -> str:
    """The one folder that holds the current version, for readers that know no versions."""
    now = current(spark, path)
    if now is None:
        return path
    if len(now.runs) != 1:
        raise ValueError(f"{path} consists of {len(now.runs)} runs; publish it as one before giving it a name")
    return run_folder(path, now.runs[0])


def is_written_in_place(spark: SparkSession, path: str) -> bool:
    """Whether a path holds files but no version."""
    return current(spark, path) is None and any(not name.startswith(("_", ".")) for name in Folder(spark, path).names(""))


def merged(
    spark: SparkSession, path: str, *, runs: Sequence[str] | None = None, partition_by: Sequence[str] = (), fmt: str | None = None
) -> Pending:
    """The given runs of a table, or all, as one, which keeps the record of their inputs."""
    now = current(spark, path)
    if now is None:
        raise ValueError(f"{path} has no version")
    chosen = [run for run in now.runs if runs is None or run in runs]
    last = shape_of(spark, path, now.runs[-1])
    rows = read_version(spark, path, Version(now.number, tuple(chosen)), fmt)
    others = [run for run in now.runs if run not in chosen]
    inputs = taken_in(spark, path, chosen)
    return write_run(rows, path, onto=others, partition_by=partition_by, fmt=fmt, inputs=inputs, noted=last.marks)


def compacted(
    spark: SparkSession, path: str, *, most: int, partition_by: Sequence[str] = (), fmt: str | None = None
) -> Version | None:
    """Where a table has more than ``most`` runs, makes one of all but the largest ``most // 2``.

    Small runs are merged often and large ones seldom, so that a row is rewritten a number of
    times that grows with the logarithm of the table, and a date has a few files per run left.
    """
    now = current(spark, path)
    if now is None or len(now.runs) <= most:
        return None
    folder = Folder(spark, path)
    by_size = sorted(now.runs, key=lambda run: (folder.size(f"_runs/{RUN}={run}"), run))
    small = by_size[: len(by_size) - most // 2]
    return merged(spark, path, runs=small, partition_by=partition_by, fmt=fmt).commit()
