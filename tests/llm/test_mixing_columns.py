"""The mix keeps every column, whatever its name, and repeated rows whole."""

import collections

import pytest
from pyspark.sql import functions as F

from adlake.llm import mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
INNER = ["_size", "_bucket", "_rank", "_copy", "_source", "_spread", "_class", "_copies", "_target", "_source_size", "_before"]
INNER += ["row", "key", "of", "copies", "rows", "nth", "times", "copy", "size", "digest", "bucket", "class", "rank", "target", "n", "a.b"]


def documents(spark):
    rows = [(i, "w " * (i % 30 + 1), "en", f"s{i % 3}" if i % 5 else None, i) for i in range(400)]
    rows += [(7, "same text", "en", "s1", k) for k in range(30)] + [(None, "no id", "en", None, None), (900, None, None, "s1", None)]
    return spark.createDataFrame(rows, DOCS)


def test_columns_of_any_name_stay(spark):
    docs = documents(spark)
    named = docs
    for i, name in enumerate(INNER):
        named = named.withColumn(name, F.lit(i))
    mix = mixing.mixed(named)
    assert mix.columns == named.columns
    got = mix.collect()
    assert got and all([row[name] for name in INNER] == list(range(len(INNER))) for row in got)
    key = lambda row: (row.doc_id, row.text, row.source)
    assert collections.Counter(map(key, got)) == collections.Counter(map(key, mixing.mixed(docs).collect()))


def test_the_mix_is_that_of_the_copies(spark):
    docs = documents(spark)
    want = collections.Counter()
    for row in mixing.copies_in_mix(mixing.narrow(docs)).collect():
        want[row.doc_id, row.source, row.digest] += row.copies
    got = collections.Counter((row.doc_id, row.source, row.digest) for row in mixing.narrow(mixing.mixed(docs)).collect())
    assert got == +want
    # rows that share an identity are taken nearly alike
    times = collections.Counter(row.n_chars for row in mixing.mixed(docs).where("text = 'same text'").collect())
    assert max(times.values()) - min([*times.values(), 2]) <= 1


def test_added_names_must_be_free(spark):
    docs = documents(spark).withColumn("_target", F.lit(1))
    with pytest.raises(ValueError, match="_target"):
        mixing.sampled_copies(docs, size=F.lit(1), identity=[F.col("doc_id")])


def test_copies_against_prefix_sums(spark):
    """Systematic sampling by the definition: expected copies summed along the order, one offset."""
    import math

    docs = documents(spark)
    by_source = collections.defaultdict(list)
    rows = mixing.narrow(docs).select(
        "*", mixing.hash52(F.col("doc_id"), F.col("digest")).alias("spread"), mixing.size_class(F.col("size")).alias("class"),
        mixing.source_key(F.col("source")).alias("of"), (F.pmod(mixing.hash52(F.lit(mixing.SEED), mixing.source_key(F.col("source"))), F.lit(2**20 - 1)) + 1).alias("drawn"),
    ).collect()
    targets = {row.source: (row.source_size, row.target) for row in mixing.source_targets(mixing.narrow(docs).select(mixing.source_key(F.col("source")).alias("source"), "size")).collect()}
    for row in rows:
        by_source[row.of].append(row)
    want = collections.Counter()
    for of, members in by_source.items():
        size, target = targets[of]
        total, upto = members[0].drawn / 2**20, 0.0
        members.sort(key=lambda r: (r["class"], r.spread % mixing.BUCKETS, r.spread, r.doc_id is not None, r.doc_id or 0, r.digest))
        for place, row in enumerate(members, 1):
            crossed = math.floor(total + place * (target / size)) - math.floor(total + (place - 1) * (target / size))
            want[row.doc_id, row.digest] += crossed
            upto += crossed
    got = collections.Counter()
    for row in mixing.copies_in_mix(mixing.narrow(docs)).collect():
        got[row.doc_id, row.digest] += row.copies
    assert +got == +want
