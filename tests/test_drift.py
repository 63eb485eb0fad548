"""Fields of payloads that appeared, vanished or changed type."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlake.operators import drift

SCHEMA = "a string, n int, b boolean, o struct<x: string, l: array<struct<q: string>>>"


def found(spark, payloads):
    df = spark.createDataFrame([(d, p) for d, p in payloads], "day string, text string").select("day", F.try_parse_json("text").alias("v"))
    rows = drift.drift(drift.fields_seen(df, day="day", payload="v"), StructType.fromDDL(SCHEMA)).collect()
    return {(r.day, r.path, r.change, r.kind, r.events) for r in rows}


def test_changes_of_each_kind(spark):
    whole = '{"a":"s","n":1,"b":true,"o":{"x":"y","l":[{"q":"1"},{"q":null}]}}'
    assert found(spark, [("d1", whole), ("d1", whole), ("d1", None), ("d1", "{broken")]) == set()
    other = '{"a":{"deep":1},"n":1.5,"b":null,"o":{"x":"y","l":[{"q":2,"new":3},{"new":[]}]},"top":{"u":{"v":1}}}'
    assert found(spark, [("d2", other), ("d2", whole)]) == {
        ("d2", "a", "type", "OBJECT", 1),
        ("d2", "a.deep", "unlisted", "BIGINT", 1),
        ("d2", "o.l[].q", "type", "BIGINT", 1),
        ("d2", "o.l[].new", "unlisted", "BIGINT", 1),
        ("d2", "o.l[].new", "unlisted", "ARRAY", 1),
        ("d2", "top", "unlisted", "OBJECT", 1),
    }
    gone = '{"a":"s","n":null,"o":{"l":[]}}'
    assert found(spark, [("d3", gone), ("d3", gone)]) == {("d3", "b", "absent", None, 2), ("d3", "o.x", "absent", None, 2)}
    assert found(spark, [("d4", "[1]"), ("d4", '"text"')]) == {("d4", "[]", "unlisted", "BIGINT", 1)}


def test_no_events(spark):
    assert found(spark, []) == set()
