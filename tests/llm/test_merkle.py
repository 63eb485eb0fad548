"""The Merkle manifest against a plain version that builds whole trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from adlake.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    each = (None if row[name] is None else str(row[name]) for name in FIELDS)
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in each))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 2]) for i in range(0, len(found[-1]), 2)])
    return found


def path(tree, at):
    for nodes in tree[:-1]:
        run = at - at % 2
        yield [nodes[i] for i in range(run, min(run + 2, len(nodes))) if i != at], at % 2
        at //= 2


def plain_manifest(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row), row))
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in langs}
    over = levels([trees[lang][-1][0] for lang in langs])
    found = []
    for number, lang in enumerate(langs):
        for at, (_, _, leaf, row) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            steps = [*path(trees[lang], at), *path(over, number)]
            node = leaf
            if row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0:
                node = plain_leaf(row | {"n_chars": row["n_chars"] + 1})
            for others, right in steps:
                node = sha(*([*others, node] if right else [node, *others]))
            root = over[-1][0]
            proof = sha(*(x for others, _ in steps for x in others))
            found.append((row["doc_id"], leaf, trees[lang][-1][0], root, proof, node, node == root))
    return found


def awkward():
    langs = [None, "", "en", "de", "zz", "ü"]
    rows = [(i * 3, f"text {i} ü", langs[(i % 7) % 6 if i % 5 else 2], f"s{i % 3}" if i % 4 else None, i if i % 6 else None) for i in range(150)]
    rows += [(7, "one id", "en", "a", 1), (7, "two texts", "en", "a", 2), (7, "two texts", "en", "a", 2)]
    rows += [(None, None, None, None, None), (None, "", "en", "", 2**63 - 1), (2**60 + 1, "x " * 5000, "en", None, 2**63 - 1), (35, "", "solo", "s", 0)]
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), row, strict=True)) for row in rows]


@pytest.mark.parametrize("bits", [1, 3, merkle.BITS])
def test_manifest_against_whole_trees(spark, bits):
    rows = awkward()
    clashing = {name: F.lit(7) for name in ("tree", "index", "hash", "n", "place", "block", "path", "tampered", "_copy", "_at", "_part")}
    docs = spark.createDataFrame([tuple(row.values()) for row in rows], DOCS).repartition(5).withColumns(clashing)
    got = sorted((tuple(row) for row in merkle.manifest(docs, bits=bits).collect()), key=str)
    assert got == sorted(plain_manifest(rows), key=str)
    assert {row[-1] for row in got} == {True, False}


def test_manifest_of_few_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert merkle.manifest(docs).count() == 0
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha()
    assert row.verified == (zlib.crc32(b"1") % 7 != 0)


def test_a_third_of_all_rows_equal(spark):
    """Equal rows are dealt out, so no partition of the sort holds them all."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    rows = [row.asDict() for row in docs.collect()]
    got = sorted((tuple(row) for row in merkle.manifest(docs, bits=6).collect()), key=str)
    assert got == sorted(plain_manifest(rows), key=str)
