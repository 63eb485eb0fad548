"""Payloads against the declared schema, day by day: fields that appeared, vanished or changed type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType

#: Levels of a payload that are looked into; what lies deeper counts as part of its parent.
DEPTH = 6
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def declared_fields(schema: DataType, path: str = "") -> dict[str, tuple[str, ...]]:
    """Dotted path -> the kinds of value that fit it; elements of an array are at ``path[]``."""
    if isinstance(schema, StructType):
        own = {path: ("OBJECT",)} if path else {}
        for field in schema.fields:
            own |= declared_fields(field.dataType, f"{path}.{field.name}" if path else field.name)
        return own
    if isinstance(schema, ArrayType):
        return {path: ("ARRAY",)} | declared_fields(schema.elementType, f"{path}[]")
    if isinstance(schema, NumericType):
        return {path: NUMBERS}
    return {path: ("BOOLEAN",) if isinstance(schema, BooleanType) else ("STRING",)}


def _below(at: Column) -> Column:
    """The fields or elements of a value with their paths; none of a plain one."""
    fields = F.map_entries(F.try_variant_get(at["value"], "$", "map<string,variant>"))
    elements = F.try_variant_get(at["value"], "$", "array<variant>")
    named = F.transform(
        fields,
        lambda e: F.struct(
            F.when(at["path"] == "", e["key"]).otherwise(F.concat(at["path"], F.lit("."), e["key"])).alias("path"), e["value"].alias("value")
        ),
    )
    listed = F.transform(elements, lambda v: F.struct(F.concat(at["path"], F.lit("[]")).alias("path"), v.alias("value")))
    nothing = F.array().cast("array<struct<path:string,value:variant>>")
    return F.coalesce(named, listed, nothing)


def fields_seen(events: DataFrame, *, day: str, payload: str, depth: int = DEPTH) -> DataFrame:
    """day, path, kind and events: in how many events of a day a field (``''``: the payload itself)
    had a kind of value. Every event is looked at once; only counts are shuffled. A payload that
    is NULL counts nothing."""
    level = F.array(F.struct(F.lit("").alias("path"), F.col(payload).alias("value")))
    rows = events.where(F.col(payload).isNotNull()).select(F.col(day).alias("day"), level.alias("l0"))
    for n in range(depth):
        rows = rows.withColumn(f"l{n + 1}", F.flatten(F.transform(f"l{n}", _below)))
    every = F.concat(*(f"l{n}" for n in range(depth + 1)))
    kind = lambda at: F.regexp_extract(F.schema_of_variant(at["value"]), "^[A-Z]+", 0)
    # of an array with many elements each path and kind counts once an event
    once = F.array_distinct(F.transform(every, lambda at: F.struct(at["path"].alias("path"), kind(at).alias("kind"))))
    found = rows.select("day", F.inline(once))
    return found.groupBy("day", "path", "kind").agg(F.count("*").alias("events"))


def drift(seen: DataFrame, schema: StructType) -> DataFrame:
    """day, path, change, kind and events, from ``fields_seen`` and the declared schema.

    ``unlisted``: the field is not declared (reported at the topmost such field); ``type``: its
    value is of a kind that does not fit; ``absent``: no event of the day had the field, though
    its parent was there in so many. NULL values fit any field.
    """
    known = declared_fields(schema)
    pairs = [(path, kinds) for path, kinds in known.items()]
    parent = F.regexp_replace("path", r"(\.[^.\[]*|\[\]|^[^.\[]*)$", "")
    rows = seen.where(F.col("path") != "").withColumn("parent", parent)
    listed = seen.sparkSession.createDataFrame([(p, list(k)) for p, k in pairs], "path string, fits array<string>")
    # a few dozen declared fields, whatever the data
    against = rows.join(F.broadcast(listed), "path", "left")
    within = F.broadcast(listed.select(F.col("path").alias("parent")).unionByName(seen.sparkSession.createDataFrame([("",)], "parent string")))
    unlisted = against.where(F.col("fits").isNull()).join(within, "parent", "left_semi")
    wrong = against.where(F.col("fits").isNotNull() & (F.col("kind") != "VOID") & ~F.array_contains("fits", F.col("kind")))
    shown = ["day", "path", "change", "kind", "events"]
    found = unlisted.withColumn("change", F.lit("unlisted")).unionByName(wrong.withColumn("change", F.lit("type"))).select(*shown)

    inside = seen.where(F.col("kind").isin("OBJECT", "ARRAY")).select("day", F.col("path").alias("parent"), "events", F.col("kind").alias("of"))
    parents = listed.select("path").withColumn("parent", parent)
    # an empty array has no elements to lack
    expected = inside.where(F.col("of") == "OBJECT").join(F.broadcast(parents.where(~F.col("path").endswith("[]"))), "parent")
    absent = expected.join(rows.select("day", "path").distinct(), ["day", "path"], "left_anti")
    absent = absent.select("day", "path", F.lit("absent").alias("change"), F.lit(None).cast("string").alias("kind"), "events")
    return found.unionByName(absent)
