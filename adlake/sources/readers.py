"""Table and bronze readers. Each bronze reader also works on a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed_values import BOOKING_SOURCE_SYSTEM, WANTED_WEBHOOK_EVENT
from adlake.functions.columns import json_starts_with, settled
from adlake.schemas import BARE_EVENT, BRONZE_BOOKING, BRONZE_SPEND, SILVER_BOOKING, SILVER_SPEND
from adlake.session import table_format
from adlake.sources.versions import current, read_version

LAYOUTS = ("lines", "documents")


def _bronze(spark, path, schema, layout, glob, streaming, files_per_batch) -> DataFrame:
    """``lines``: one object per line, as our own intake writes, which Spark can split.
    ``documents``: one JSON value per file, possibly pretty-printed, read whole by one task: an
    object, or an array whose elements are rows. A file with anything after its first value is
    kept as text in ``_corrupt_record``, so either layout reports what it cannot read."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    reader = (spark.readStream if streaming else spark.read).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    origin = F.col("_metadata.file_path").alias("source_file_path")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    if layout == "lines":
        return reader.schema(schema).options(**options).json(path).select("*", origin)
    texts = reader.text(path, wholetext=True).select("value", origin)
    struct = f"struct<{schema}>"
    value = F.col("value")
    # the reader takes NaN and infinities, which counting does not
    numeric = F.regexp_replace(value, r":\s*[+-]?(NaN|Infinity|INF)\b", ":0")
    single = F.json_array_length(F.concat(F.lit("["), numeric, F.lit("]"))) == 1
    # each step computed once a file: beside a generator, expressions run once for every row it makes
    files = settled(texts.select("value", "source_file_path", F.coalesce(single, F.lit(False)).alias("single")))
    listed = json_starts_with(value, "[")
    elements = F.when(listed, F.from_json(value, f"array<{struct}>", options)).otherwise(
        F.array(F.from_json(value, struct, options))
    )
    found = settled(
        files.select(
            "source_file_path",
            F.when(~F.col("single"), value).alias("_unread"),
            F.when(F.col("single"), elements).alias("elements"),
        )
    )
    rows = found.select("source_file_path", "_unread", F.explode_outer("elements").alias("row"))
    names = [field.name for field in rows.schema["row"].dataType.fields]
    return rows.select(
        *(F.col(f"row.{name}").alias(name) for name in names if name != "_corrupt_record"),
        F.coalesce("_unread", "row._corrupt_record").alias("_corrupt_record"),
        "source_file_path",
    )


def read_bronze_bookings(
    spark: SparkSession,
    path: str | list[str],
    *,
    layout: str = "lines",
    glob: str | None = None,
    streaming: bool = False,
    files_per_batch: int | None = None,
    bare: bool = False,
) -> DataFrame:
    """Webhook events under ``path`` at any depth. Unreadable ones keep their text in
    ``_corrupt_record`` and end up among the rejects. ``bare`` also takes wanted events that
    were stored without an envelope."""
    if not bare:
        return _bronze(spark, path, BRONZE_BOOKING, layout, glob, streaming, files_per_batch)
    schema = f"{BRONZE_BOOKING}, {BARE_EVENT}"
    return with_bare_events(
        _bronze(spark, path, schema, layout, glob, streaming, files_per_batch)
    )


def with_bare_events(bronze: DataFrame) -> DataFrame:
    """Move bare events into ``raw_event``, where enveloped ones are."""
    names = ["event", "created_at", "created_by", "payload"]
    wanted = (F.col("event") == WANTED_WEBHOOK_EVENT) & F.col("payload").isNotNull()
    moved = F.coalesce("raw_event", F.when(wanted, F.struct(*names)))
    system = F.coalesce("source_system", F.when(wanted, F.lit(BOOKING_SOURCE_SYSTEM)))
    return bronze.withColumns({"raw_event": moved, "source_system": system}).drop(*names)


def read_bronze_spend(
    spark: SparkSession,
    path: str | list[str],
    *,
    layout: str = "lines",
    glob: str | None = None,
    streaming: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Spend files under ``path`` at any depth, one row per file."""
    return _bronze(spark, path, BRONZE_SPEND, layout, glob, streaming, files_per_batch)


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A silver or gold table: its committed version, or the files of one written in place."""
    version = current(spark, path)
    if version is not None:
        return read_version(spark, path, version, fmt)
    return spark.read.format(fmt or table_format(spark)).load(path)


def _read_silver(spark: SparkSession, path: str, schema: str, fmt: str | None) -> DataFrame:
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        # a partitioned Parquet table without rows has no file to take a schema from
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.format(fmt or table_format(spark)).schema(schema).load(path)


def read_silver_bookings(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return _read_silver(spark, path, SILVER_BOOKING, fmt)


def read_silver_spend(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return _read_silver(spark, path, SILVER_SPEND, fmt)
