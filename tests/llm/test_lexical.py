"""Ranked search against a plain version that scores every document on every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    bags = [(doc_id, plain_terms(text)) for doc_id, text in docs]
    bags = [(doc_id, Counter(words), len(words)) for doc_id, words in bags if words]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    found = []
    for item, asked in wanted.items():
        scores = []
        for doc_id, bag, n in bags:
            m = 10 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in asked
                if t in bag
            )
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        found += [(item, rank + 1, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(found, key=str)


def corpus():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "x1", "日本語", "A", "b" * 80, "b" * 79 + "c"]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 40)))) for i in range(300)]
    docs += [(1000 - i, "w1 w2 W3-w4, nowhere") for i in range(40)]  # one class, ids descending
    docs += [(2000 + i, f"w1 w2 w3 w4 other{i}") for i in range(15)]  # one class of different texts
    docs += [(5, "w1 again"), (5, "w1 again"), (None, "w1 w2 w3"), (3000, None), (3001, ""), (3002, "-- !!"), (3003, "w7 " * 30_000)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 9)))) for i in range(25)]
    items += [(100, "w1 W2 w3 w4"), (101, None), (102, "absent"), (7, "w5 extra"), (None, "w1 日本語"), (None, "A"), (103, "b" * 80)]
    return docs, items


@pytest.mark.parametrize(("k", "block_pairs"), [(10, lexical.BLOCK_PAIRS), (3, 20)])
def test_search_against_brute_force(spark, k, block_pairs):
    docs, items = corpus()
    clashing = {name: F.lit(7) for name in ("bag", "m", "ids", "hash", "place", "score", "rank", "term", "df")}
    d = spark.createDataFrame(docs, DOCS).repartition(6).withColumns(clashing)
    i = spark.createDataFrame(items, ITEMS).withColumns(clashing)
    got = lexical.search(d, i, k=k, block_pairs=block_pairs).collect()
    assert sorted((tuple(row) for row in got), key=str) == plain_search(docs, items, k)


def test_best_of_classes_by_score_and_smallest_id():
    best = lexical.Best(1, 2)

    def put(score, ids):
        members = np.empty(1, object)
        members[:] = [ids]
        best.add(np.array([0]), np.array([score]), np.array([ids[0]]), members)

    for score, ids in [(5, [9, 10]), (7, [8]), (5, [1, 12]), (7, [2, 3])]:
        put(score, ids)
    assert best.rows() == [(0, 2, 7), (0, 3, 7)] and best.least[0] == 7


def test_search_of_empty_tables(spark):
    none_d, none_i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some_d, some_i = spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert lexical.search(none_d, some_i).count() == lexical.search(some_d, none_i).count() == 0
    assert [(r.item_id, r.rank, r.doc_id) for r in lexical.search(some_d, some_i).collect()] == [(1, 1, 1)]


def test_vectors_of_one_hash_stay_apart(spark):
    """Classes are verified by the vector: where all hashes agree they are still told apart."""
    rows = [(i, 1, bytes([i % 3 + 1, 0, 0, 0, 1, 0, 0, 0])) for i in range(30)]
    bags = spark.createDataFrame(rows, "doc_id long, n long, bag binary")
    before = F.xxhash64
    try:
        F.xxhash64 = lambda *columns: F.lit(1).cast("long")
        got = lexical.classes(bags, F.lit(10).cast("long"), 4).collect()
    finally:
        F.xxhash64 = before
    assert sorted(list(row.ids) for row in got) == [[0, 3, 6, 9], [1, 4, 7, 10], [2, 5, 8, 11]]
