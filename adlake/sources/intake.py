"""Raw input to bronze: webhook request bodies and spend files, each wrapped in an envelope
with its lineage. The payload is kept as VARIANT, so fields no schema knows survive."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed_values import (
    BOOKING_KEY_PREFIX,
    BOOKING_SOURCE_SYSTEM,
    CHANNEL_BY_EVENT_TYPE,
    SPEND_KEY_PREFIX,
    SPEND_SOURCE_SYSTEM,
    UNKNOWN_WEBHOOK_EVENT,
    WANTED_WEBHOOK_EVENT,
)
from adlake.functions import columns as c
from adlake.operators.quality import Rule, with_reasons

REQUESTS = "body string, isBase64Encoded boolean"

BOOKING_ENVELOPE = [
    "source_system", "ingestion_timestamp", "webhook_event", "booking_id",
    "event_type_uri", "channel", "raw_s3_key", "raw_event",
]

SPEND_ENVELOPE = [
    "source_system", "ingestion_timestamp", "source_url", "source_file_name",
    "raw_s3_key", "raw_payload",
]

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"

#: Far below the limit of a VARIANT, so that records of uneven size stay below it too.
SPLIT_BYTES = 16 << 20

BOOKING_PARTITIONS = ["event_type", "ingest_date"]
SPEND_PARTITIONS = ["ingest_date"]


def ingestion_time(at: str | None) -> Column:
    """The given ISO timestamp, or the time of the run (of the micro-batch, on a stream)."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return now if at is None else F.lit(at)


def decoded_body(requests: DataFrame) -> Column:
    """Body text; NULL when it is absent or not base64 of UTF-8 where it claims to be."""
    if "isBase64Encoded" not in requests.columns:
        return F.col("body")
    raw = F.try_to_binary(F.col("body"), F.lit("base64")).cast("string")
    return F.when(F.col("isBase64Encoded"), F.try_validate_utf8(raw)).otherwise(F.col("body"))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def read_requests(
    spark: SparkSession, path: str, *, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Logged webhook requests, one JSON object per line with ``body`` and ``isBase64Encoded``."""
    reader = (spark.readStream if streaming else spark.read).schema(REQUESTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def webhook_rules() -> list[Rule]:
    text, parsed = F.col("_text"), F.col("raw_event")

    def filled(path: str) -> Column:
        kind = _kind(F.try_variant_get(parsed, path, "variant"))
        return kind.startswith("OBJECT") & (kind != "OBJECT<>")

    # a field found inside proves an object filled; only otherwise is it looked at as a whole
    meeting = F.col("event_type_uri").isNotNull() | filled("$.payload.scheduled_event")
    payload = meeting | F.col("booking_id").isNotNull() | filled("$.payload")
    return [
        Rule("missing_body", F.col("body").isNotNull()),
        Rule("invalid_encoding", F.col("body").isNull() | text.isNotNull()),
        Rule("invalid_json", text.isNull() | parsed.isNotNull()),
        Rule("not_an_object", parsed.isNull() | c.json_starts_with(text, "{")),
        Rule("unsupported_event", F.col("webhook_event") == WANTED_WEBHOOK_EVENT),
        Rule("missing_payload", payload),
        Rule("missing_scheduled_event", meeting),
    ]


def webhook_intake(
    requests: DataFrame,
    *,
    ingested_at: str | None = None,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    source_system: str = BOOKING_SOURCE_SYSTEM,
) -> DataFrame:
    """Request bodies as bronze rows with reject reasons, their partition columns included.

    Of a key that a JSON object repeats, the last value counts, as most parsers have it; the
    session is set so. An event without a booking id is keyed by a digest of its body, so that a retried task
    names it the same again.
    """
    requests.sparkSession.conf.set(REPEATED_KEYS, "true")
    decoded = c.settled(requests.select("body", decoded_body(requests).alias("_text")))
    parsed = c.settled(decoded.withColumn("raw_event", F.try_parse_json("_text")))

    def field(path: str) -> Column:
        return F.try_variant_get("raw_event", f"$.{path}", "string")

    event_type = field("payload.scheduled_event.event_type")
    named = parsed.select(
        "body",
        "_text",
        "raw_event",
        F.lit(source_system).alias("source_system"),
        ingestion_time(ingested_at).alias("ingestion_timestamp"),
        field("event").alias("webhook_event"),
        c.last_segment(field("payload.uri")).alias("booking_id"),
        event_type.alias("event_type_uri"),
        c.lookup(event_type, channels).alias("channel"),
        c.label(field("event"), UNKNOWN_WEBHOOK_EVENT).alias("event_type"),
        F.left(ingestion_time(ingested_at), F.lit(10)).alias("ingest_date"),
    )
    name = F.coalesce("booking_id", F.sha2(F.coalesce("_text", F.lit("")), 256))
    key = F.format_string(
        f"{BOOKING_KEY_PREFIX}/event_type=%s/ingest_date=%s/%s.json",
        "event_type",
        "ingest_date",
        name,
    )
    keyed = named.withColumn("raw_s3_key", key)
    checked = with_reasons(keyed, webhook_rules())
    return checked.select("body", *BOOKING_ENVELOPE, *BOOKING_PARTITIONS, "reject_reasons")


def _pieces(files: DataFrame, split_bytes: int) -> DataFrame:
    """Rows (piece, and all columns but ``value``): the text in ``value``, or, where that is a
    longer array, several arrays in JSON that together hold its records."""
    size = F.octet_length("value").cast("long")
    large = (size > split_bytes) & c.json_starts_with(F.col("value"), "[")
    records = F.when(large, F.from_json("value", "array<string>"))
    # parsed once, not once per piece
    listed = c.settled(files.withColumns({"_size": size, "_records": records}))
    found = F.size("_records")
    each = F.greatest(F.lit(1), F.floor(found.cast("long") * split_bytes / F.col("_size"))).cast("int")

    def part(start: Column) -> Column:
        # a record that is JSON null reads as NULL
        return F.concat(F.lit("["), F.array_join(F.slice("_records", start, each), ",", "null"), F.lit("]"))

    parts = F.when(found > 1, F.transform(F.sequence(F.lit(1), found, each), part))
    whole = F.array("value")
    return listed.select(
        F.explode(F.coalesce(parts, whole)).alias("piece"),
        *(name for name in files.columns if name != "value"),
    )


def spend_intake(
    spark: SparkSession,
    path: str | list[str],
    *,
    ingested_at: str | None = None,
    source_base_url: str | None = None,
    source_system: str = SPEND_SOURCE_SYSTEM,
    glob: str | None = "spend_data_*.json",
    file_names: Collection[str] | DataFrame | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Raw spend files, one bronze row per file; only those in ``file_names`` when given, a list
    (then no others are opened) or a frame with a ``file_name`` column, as ``select_names`` gives.

    An array of more than ``split_bytes`` becomes several rows of the same key, each with some of
    its records, as a VARIANT has a size limit. ``record_count`` is that of the row, and NULL for
    a file that holds no array.
    """
    found = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    spark.conf.set(REPEATED_KEYS, "true")
    if isinstance(file_names, DataFrame):
        found = found.select("value", "_metadata").join(
            file_names.select("file_name").distinct(), F.col("_metadata.file_name") == F.col("file_name"), "left_semi"
        )
    elif file_names is not None:
        found = found.where(F.col("_metadata.file_name").isin(*file_names))
    texts = found.select(
        "value",
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_name").alias("source_file_name"),
    )
    files = _pieces(texts, split_bytes).select(
        F.try_parse_json("piece").alias("raw_payload"), "source_file_path", "source_file_name"
    )
    return spend_envelopes(
        files,
        ingested_at=ingested_at,
        source_base_url=source_base_url,
        source_system=source_system,
    )


def spend_envelopes(
    files: DataFrame,
    *,
    ingested_at: str | None = None,
    source_base_url: str | None = None,
    source_system: str = SPEND_SOURCE_SYSTEM,
) -> DataFrame:
    """Envelope for frames with ``source_file_name`` and a VARIANT ``raw_payload``."""
    url = (
        F.concat(F.lit(source_base_url.rstrip("/") + "/"), "source_file_name")
        if source_base_url
        else c.safe_col(files, "source_file_path")
    )
    items = F.try_variant_get("raw_payload", "$", "array<variant>")
    stamped = files.withColumns(
        {
            "source_system": F.lit(source_system),
            "ingestion_timestamp": ingestion_time(ingested_at),
            "source_url": url,
            "record_count": F.when(items.isNotNull(), F.size(items)),
        }
    ).withColumn("ingest_date", F.left("ingestion_timestamp", F.lit(10)))
    key = F.format_string(
        f"{SPEND_KEY_PREFIX}/ingest_date=%s/%s", "ingest_date", "source_file_name"
    )
    return stamped.withColumn("raw_s3_key", key).select(
        *SPEND_ENVELOPE, *SPEND_PARTITIONS, "record_count"
    )
