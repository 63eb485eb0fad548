"""Table writers, exports and registration."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from contextlib import ExitStack, contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import staged, staging_path, table_format
from adlake.sources.files import Folder, delete_file, replace_file
from adlake.sources.versions import (
    Pending,
    current,
    is_written_in_place,
    location,
    publish,
    publish_partitions,
    shape_of,
)

MODES = ("overwrite", "append", "replace_partitions", "publish", "publish_partitions")


def stamped(df: DataFrame, column: str) -> DataFrame:
    """Processing time, added only when a table is written so that metrics stay reproducible."""
    return df.withColumn(column, F.current_timestamp())


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str | None = None,
    rebalance: bool = True,
    most_rows: int | None = None,
    codec: str | None = None,
) -> None:
    """Write a table.

    ``overwrite`` rebuilds it, ``replace_partitions`` replaces only the partitions present in
    ``df``, ``append`` adds rows (and doubles them when a job is run again, so it is for bronze
    or for input known to be new). These three write in place, so that a job which dies leaves
    the table half done. ``publish`` and ``publish_partitions`` do the first two as a version
    that readers see at once, when it is complete (see ``versions``).

    A partitioned write is rebalanced by its partition columns first: a date goes to few
    files instead of one per task, while AQE splits a date too big for one task. Turn that off
    where AQE is (inside a stream), as a big date would then go to a single task.
    ``most_rows`` bounds the rows of a file written in place, ``codec`` is what packs its files.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    fmt = fmt or table_format(df.sparkSession)
    if mode.startswith("publish"):
        pending_table(df, path, mode=mode, partition_by=partition_by, fmt=fmt).commit()
        return
    if current(df.sparkSession, path) is not None:
        raise ValueError(f"{path} has versions: {mode} in place would bypass them")
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("append" if mode == "append" else "overwrite")
    if mode == "replace_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        # whatever the session says: an overwrite leaves no old partition behind
        writer = writer.option("partitionOverwriteMode", "static")
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if most_rows:
        writer = writer.option("maxRecordsPerFile", most_rows)
    if codec:
        writer = writer.option("compression", codec)
    writer.save(path)


def pending_table(
    df: DataFrame,
    path: str,
    *,
    mode: str,
    partition_by: Sequence[str] = (),
    fmt: str | None = None,
    noted: Mapping[str, str | int] | None = None,
) -> Pending:
    """A version by ``publish`` or ``publish_partitions`` that is written and not yet committed;
    a published one with the marks in ``noted``."""
    if is_written_in_place(df.sparkSession, path):
        raise ValueError(f"{path} was written in place: publish to another path, or delete it first")
    if mode == "publish_partitions" and partition_by:
        return publish_partitions(df, path, partition_by=partition_by, fmt=fmt)
    return publish(df, path, partition_by=partition_by, fmt=fmt, noted=noted)


#: So many files of a task are open at once; only rows of more folders are sorted first.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Rows of a bronze file at most, as a rewritten one passes through one task.
BRONZE_ROWS = 100_000
#: Ends of the names of plain and of packed bronze files, and what writes them.
PLAIN_FILE, PACKED_FILE = (".json", "none"), (".json.gz", "gzip")


def write_bronze(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    mode: str = "replace_keys",
    key: str = "raw_s3_key",
    rebalance: bool = False,
    repeatable: bool = False,
    packed: bool = False,
) -> None:
    """Bronze envelopes as JSON lines in ``key=value`` folders.

    ``replace_keys`` makes intake rerunnable: rows stored earlier go where ``df`` has rows of
    their key in the same folder, as an object store keeps one object per key. Rows of ``df``
    itself all stay, even where files of different folders share a name and so a key.

    Only the folders that ``df`` touches are read, and in them only files that hold a replaced
    key are rewritten, each under its own name by one rename. Every other line, readable or not,
    stays as it is, byte for byte. New rows are written first, so that a job which dies loses
    nothing; run again, it replaces what it had written. A rewritten file passes through one
    task, so files hold ``BRONZE_ROWS`` rows at most.

    An intake has rows of few folders, so each task writes its own files, without sorting its rows
    by folder; ``rebalance`` brings the rows of a folder together first, for rows of many. Where nothing is stored yet, rows are
    written as they come. Otherwise they are staged, unless ``repeatable`` says that ``df`` is
    cheap to read several times and gives the same rows each time, as one staged already is.

    ``packed`` writes files of gzip, some tenth of the size of plain lines, and takes the place of
    keys in such files as well; plain ones that are there stay plain. Old and new rows are on disk
    together for a while, so a large intake taken in again asks for it.
    """
    spark = df.sparkSession
    kinds = (PLAIN_FILE, PACKED_FILE) if packed else (PLAIN_FILE,)

    def write(rows: DataFrame, mode: str) -> None:
        with nullcontext() if rebalance else _setting(spark, OPEN_FILES, "8"):
            write_table(
                rows, path, mode=mode, partition_by=partition_by, fmt="json", rebalance=rebalance, most_rows=BRONZE_ROWS,
                codec=kinds[-1][1] if packed else None,
            )

    if mode != "replace_keys":
        write(df, mode)
        return
    if not Folder(spark, path).names(""):
        write(df, "append")
        return
    with nullcontext(df) if repeatable else staged(df) as new:
        keys = new.select(*partition_by, key).distinct()
        with ExitStack() as kept:
            rest = _lines_that_stay(spark, path, keys, partition_by, key, kinds, kept)
            write(new, "append")
            for old, content in rest.items():
                if content is None:
                    delete_file(spark, old)
                else:
                    replace_file(spark, old, content)


def _lines_that_stay(
    spark: SparkSession,
    path: str,
    keys: DataFrame,
    partition_by: Sequence[str],
    key: str,
    kinds: Sequence[tuple[str, str]],
    kept: ExitStack,
) -> dict[str, str | None]:
    """Per file that holds one of the keys, a staged file with its other lines (None without any)."""
    columns = ", ".join(f"`{name}` string" for name in partition_by)
    try:
        # no line end but this: a carriage return belongs to its line
        lines = spark.read.schema(f"value string, {columns}").option("lineSep", "\n").text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    of_line = F.get_json_object("value", f"$.{key}").alias(key)
    named = lines.select(*partition_by, "value", of_line, F.col("_metadata.file_path").alias("file"))
    # broadcast whatever is estimated: dealt out by folder, all lines of one would land in one task
    touched = F.broadcast(keys.select(*partition_by).distinct())
    named = named.join(touched, list(partition_by), "left_semi")
    marked = named.drop("value").join(keys.withColumn("_new", F.lit(1)), [*partition_by, key], "left")
    stays = (F.count("*") > F.count("_new")).alias("stays")
    hit = kept.enter_context(staged(marked.groupBy("file").agg(stays, F.count("_new").alias("_new")).where("_new > 0")))
    # names of the files to rewrite, which the driver renames one by one
    files = {row["file"]: row["stays"] for row in hit.collect()}
    other = [name for name in files if not name.endswith(tuple(end for end, _ in kinds))]
    if other:
        ends = " or ".join(end for end, _ in kinds)
        raise ValueError(f"{other[0]} and {len(other) - 1} others hold keys to replace and are not plain {ends} files")
    content: dict[str, str | None] = dict.fromkeys(files)
    if not any(files.values()):
        return content
    # whole lines are dealt out only of files of which a part stays
    partly = F.broadcast(hit.where("stays"))
    others = named.join(partly, "file", "left_semi").join(keys, [*partition_by, key], "left_anti")
    folder = staging_path(spark, "bronze-lines")
    kept.callback(Folder(spark, folder).delete, "")
    staged_files = Folder(spark, folder)
    for end, codec in kinds:
        names = [name for name, stays in files.items() if stays and name.endswith(end)]
        if not names:
            continue
        by_file = others.where(F.endswith("file", F.lit(end))).select("value", F.sha2("file", 256).alias("of")).repartition("of")
        writer = by_file.write.mode("append").option("lineSep", "\n").option("compression", codec)
        writer.partitionBy("of").text(folder)
        for name in names:
            inside = f"of={hashlib.sha256(name.encode()).hexdigest()}"
            (part,) = (part for part in staged_files.names(inside) if part.startswith("part-"))
            content[name] = f"{folder}/{inside}/{part}"
    return content


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


#: Off, a table finds its partitions in its folder, so that a new location brings them along.
TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def register_table(spark: SparkSession, name: str, path: str, fmt: str | None = None) -> None:
    """Make the table at ``path``, its committed version if it has any, known to SQL readers.

    A name that is known already is moved to the new location by one statement: readers see the
    old files or the new ones, and never no table. Only a change of columns (or a table whose
    partitions the catalog has tracked) needs the name to be dropped and made again.
    """
    fmt = fmt or table_format(spark)
    folder, version = location(spark, path), current(spark, path)
    shape = shape_of(spark, path, version.runs[0]) if version else None
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table, and dropping it would delete its data")
        schema = shape.schema if shape else spark.read.format(fmt).load(folder).schema
        known = [(field.name, field.dataType) for field in spark.table(name).schema.fields]
        same = fmt != "delta" and known == [(field.name, field.dataType) for field in schema.fields]
        if same and not _tracked(spark, name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    with _setting(spark, TRACKED, "false"):
        if shape is None:
            spark.catalog.createTable(name, path=folder, source=fmt)
            return
        by = ", ".join(f"`{column}`" for column in shape.partition_by)
        layout = f"PARTITIONED BY ({by}) " if by else ""
        spark.sql(f"CREATE TABLE {name} ({shape.schema.toDDL()}) USING {fmt} {layout}LOCATION '{_quoted(folder)}'")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _tracked(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Partition Provider'").collect()
    return any(row["data_type"] == "Catalog" for row in rows)
