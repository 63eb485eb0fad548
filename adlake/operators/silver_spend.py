"""Bronze spend files to silver spend: one row per date and channel record of a file."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.fixed_values import SPEND_CHANNELS
from adlake.functions import columns as c
from adlake.operators.quality import Rule, keep_valid, valid_rows, with_reasons
from adlake.schemas import SPEND_RECORDS

PARTITION = "spend_date"

COLUMNS = [
    "spend_date", "channel", "spend_usd", "source_file",
    "bronze_source_system", "bronze_ingestion_timestamp", "bronze_source_url",
    "bronze_raw_s3_key", "bronze_source_file_path",
]


def rules(channels: Collection[str] = SPEND_CHANNELS) -> list[Rule]:
    given_date = c.blank_to_null(F.col("_date"))
    given_channel = c.blank_to_null(F.col("channel"))
    spend = F.col("spend_usd")
    return [
        Rule("corrupt_record", F.col("_corrupt_record").isNull()),
        Rule("no_records", F.col("_has_record")),
        Rule("missing_date", given_date.isNotNull() | ~F.col("_has_record")),
        Rule("invalid_date", given_date.isNull() | F.col("spend_date").isNotNull()),
        Rule("missing_channel", given_channel.isNotNull() | ~F.col("_has_record")),
        Rule("unsupported_channel", given_channel.isNull() | F.col("channel").isin(*channels)),
        Rule("missing_spend", F.col("_spend").isNotNull() | ~F.col("_has_record")),
        Rule("invalid_spend", F.col("_spend").isNull() | (spend.isNotNull() & ~F.isnan(spend))),
        Rule("negative_spend", spend.isNull() | F.isnan(spend) | (spend >= 0)),
    ]


def explode_records(bronze: DataFrame) -> DataFrame:
    """All records of all files with their file's lineage. A file without records keeps one
    row, so that it can be reported instead of vanishing."""
    payload = c.safe_col(bronze, "raw_payload", dtype=SPEND_RECORDS)
    if dict(bronze.dtypes).get("raw_payload") == "variant":
        is_list = F.try_variant_get(payload, "$", "array<variant>").isNotNull()
        payload = F.when(is_list, F.from_json(payload.cast("string"), SPEND_RECORDS))
    records = bronze.select(
        F.explode_outer(payload).alias("record"),
        c.safe_col(bronze, "source_file_name").cast("string").alias("source_file"),
        c.safe_col(bronze, "source_system").cast("string").alias("bronze_source_system"),
        c.safe_col(bronze, "ingestion_timestamp").cast("string").alias("bronze_ingestion_timestamp"),
        c.safe_col(bronze, "source_url").cast("string").alias("bronze_source_url"),
        c.safe_col(bronze, "raw_s3_key").cast("string").alias("bronze_raw_s3_key"),
        c.safe_col(bronze, "source_file_path").cast("string").alias("bronze_source_file_path"),
        c.safe_col(bronze, "_corrupt_record").alias("_corrupt_record"),
    )
    return records.withColumns(
        {
            "spend_date": c.plain_date(F.col("record.date").cast("string")),
            "channel": F.col("record.channel").cast("string"),
            "spend_usd": c.cents(F.col("record.spend").try_cast("double")),
            "_date": F.col("record.date").cast("string"),
            "_spend": F.col("record.spend").cast("string"),
            "_has_record": F.col("record").isNotNull(),
        }
    ).drop("record")


def spend(bronze: DataFrame, channels: Collection[str] = SPEND_CHANNELS) -> DataFrame:
    """Valid silver spend rows."""
    return keep_valid(explode_records(bronze), rules(channels)).select(COLUMNS)


def checked_spend(bronze: DataFrame, channels: Collection[str] = SPEND_CHANNELS) -> DataFrame:
    """Every record with its reject reasons, its date and amount also as they were written."""
    checked = with_reasons(explode_records(bronze), rules(channels))
    return checked.select(
        *COLUMNS,
        F.col("_date").alias("written_date"),
        F.col("_spend").alias("written_spend"),
        "_corrupt_record",
        "reject_reasons",
    )


def accepted(checked: DataFrame) -> DataFrame:
    return valid_rows(checked).select(COLUMNS)
