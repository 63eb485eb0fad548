"""Spans and redaction of texts with many matches, and of columns of any name."""

import re
import time

import pytest
from pyspark.sql import functions as F

from adlake.llm import secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def many(n):
    return " ".join(f"é token=abcdef{i:06d} {i:024x}" for i in range(n // 2))


def test_work_grows_with_the_matches(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, many(n), "en", "s", None)], DOCS)
        start = time.time()
        (row,) = secrets.without_secrets(df).collect()
        took = time.time() - start
        assert row.text == " ".join(["é [assign] [hex]"] * (n // 2))
        return took

    seconds(1000)
    small, large = seconds(50_000), seconds(200_000)
    assert large < 40 and large < 10 * small


def test_tokens_outside_of_spans(spark):
    spans = "array<struct<kind:string,start:int,end:int,value:string>>"
    tokens = [("t", 0, 5, "a"), ("t", 6, 9, "b"), ("t", 12, 20, "c"), ("t", 25, 30, "d")]
    base = [("b", 5, 6, ""), ("b", 8, 11, ""), ("b", 2, 2, ""), ("b", 19, 40, ""), ("b", 1, 3, ""), ("b", 9, 12, "")]
    rows = [(0, tokens, []), (1, tokens, base), (2, [], base), (3, tokens, [("b", 0, 100, "")]), (4, tokens, base[:1])]
    df = spark.createDataFrame(rows, f"id int, tokens {spans}, base {spans}")
    got = {row.id: "".join(t.value for t in row.free) for row in df.select("id", secrets.outside(F.col("tokens"), F.col("base")).alias("free")).collect()}
    free = lambda t, bs: not any(a < t[2] and t[1] < e for _, a, e, _ in bs)
    assert got == {i: "".join(t[3] for t in ts if free(t, bs)) for i, ts, bs in rows}


def test_redaction_of_overlapping_spans(spark):
    text = "\ufeffab\U0001f600defghij\ufeffk"
    spans = [("hex", 3, 6, ""), ("assign", 2, 5, ""), ("access", 2, 4, ""), ("live", 6, 7, ""), ("hex", 9, 11, ""), ("hex", 10, 10, "")]
    kind = "array<struct<kind:string,start:int,end:int,value:string>>"
    df = spark.createDataFrame([(text, spans), (text, []), (text, [("hex", 0, 12, "")])], f"text string, spans {kind}")
    got = [row.r for row in df.select(secrets.redacted(F.col("text"), F.col("spans")).alias("r")).collect()]
    assert got == [text[:2] + "[assign][live]" + text[7:9] + "[hex]" + text[11:], text, "[hex]k"]


INNER = sorted(
    {"row", "id", "key", "spans", "new", "of_id", "of_key", "doc_key", "owner", "repository", "tokens", "candidates", "live", "hash"}
    | {"_id", "_key", "_spans", "_doc_key", "_new", "assign", "access", "hex", "d", "l", "a.b", "x`y", "owners", "repositories"}
)


def test_columns_of_any_name_stay(spark):
    rows = [(1, f"token=abcdefgh {i}", "en", f"s{i}", None) for i in range(2)] + [(None, "password: hunter22", None, None, 3), (4, None, "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for i, name in enumerate(INNER):
        df = df.withColumn(name, F.lit(i))
    clean = secrets.without_secrets(df)
    assert clean.columns == df.columns
    for row in clean.collect():
        assert [row[name] for name in INNER] == list(range(len(INNER)))
        assert not re.search("abcdefgh|hunter", row.text or "")
    assert secrets.secret_scan(df).count() == len(rows)


@pytest.mark.parametrize("text", ["", "token=abcdef", "x token=abcdef", "token=abcdef x", "token=abcdef,token=ghijkl"])
def test_ends_of_texts(spark, text):
    df = spark.createDataFrame([(1, text, "en", "s", None)], DOCS)
    want = re.sub("token=[a-z]{6}", "[assign]", text)
    assert secrets.without_secrets(df).first().text == want
