"""Which spend files to ingest: names out of a manifest, then a selection among them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed_values import MANIFEST_LIST_KEYS, MANIFEST_NAME_KEYS, SPEND_FILE_PATTERN
from adlake.functions import columns as c


def _nonempty_list(manifest: Column, path: str) -> Column:
    found = F.try_variant_get(manifest, path, "array<variant>")
    return F.when(F.size(found) > 0, found)


def _name_of(item: Column) -> Column:
    kind = F.schema_of_variant(item)
    by_key = [c.blank_to_null(F.try_variant_get(item, f"$.{k}", "string")) for k in MANIFEST_NAME_KEYS]
    plain = F.when(kind == "STRING", c.blank_to_null(F.try_variant_get(item, "$", "string")))
    return F.coalesce(plain, F.when(kind.startswith("OBJECT"), F.coalesce(*by_key)))


def spend_file_names(paths: DataFrame, column: str = "path") -> DataFrame:
    """Distinct spend file names among paths or keys."""
    name = c.last_segment(F.col(column)).alias("file_name")
    return paths.select(name).where(F.col("file_name").rlike(SPEND_FILE_PATTERN)).distinct()


def read_manifests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest files, one row per file."""
    return spark.read.text(path, wholetext=True)


def manifest_names(manifests: DataFrame, column: str = "value") -> DataFrame:
    """Distinct spend file names listed by JSON manifests (one per row).

    A manifest is a list, or an object holding one under a known key; an item is a name, or an
    object naming its file under a known key.
    """
    manifest = F.try_parse_json(column)
    listed = F.coalesce(
        _nonempty_list(manifest, "$"),
        *(_nonempty_list(manifest, f"$.{key}") for key in MANIFEST_LIST_KEYS),
    )
    items = manifests.select(F.explode(listed).alias("item"))
    return spend_file_names(items.select(_name_of(F.col("item")).alias("path")))


def require_names(names: DataFrame) -> DataFrame:
    """Fail when nothing was listed."""
    if names.isEmpty():
        raise ValueError("the manifest lists no spend files")
    return names


def select_names(
    names: DataFrame,
    *,
    file_name: str | None = None,
    file_names: Collection[str] | None = None,
    newest: int | None = None,
    cap: int | None = None,
) -> DataFrame:
    """One name, some names, or the newest few, in that precedence; ``cap`` then keeps the
    newest of what was selected. Names sort by the date in them."""
    if cap is not None and cap <= 0:
        raise ValueError(f"cap must be a positive integer, not {cap}")
    if file_name is not None:
        names = names.where(F.col("file_name") == file_name)
    elif file_names is not None:
        names = names.where(F.col("file_name").isin(*file_names)) if file_names else names.limit(0)
    elif newest is not None and newest > 0:
        names = names.orderBy(F.desc("file_name")).limit(newest)
    return names if cap is None else names.orderBy(F.desc("file_name")).limit(cap)
